"""FM-index over integer symbols: backward search on wavelet-matrix ranks, sampled suffix positions.

Symbol 0 separates runs of text; patterns hold no 0. All operations take arrays
and answer for every pattern or row at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only ranks that still tie are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    ordered = text[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if n else np.empty(0, np.int64)
    group = np.repeat(starts, np.diff(np.r_[starts, n]))
    rank[order] = group
    width = 1
    while True:
        tied = np.flatnonzero(np.r_[group[1:] == group[:-1], False] | np.r_[False, group[1:] == group[:-1]]) if n > 1 else np.empty(0, np.int64)
        if not len(tied):
            return order
        rows = order[tied]
        ahead = rows + width
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        sort = np.lexsort((follow, group[tied]))
        rows, follow, own = rows[sort], follow[sort], group[tied][sort]
        order[tied] = rows
        new = np.r_[True, (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])]
        first = tied[new]
        group[tied] = np.repeat(first, np.diff(np.r_[np.flatnonzero(new), len(tied)]))
        rank[rows] = group[tied]
        width *= 2


class _Bits:
    """A bit string with constant-time rank: packed words and counts before each."""

    def __init__(self, bits: np.ndarray) -> None:
        words = np.zeros((len(bits) + 64) // 64 * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        words[: len(packed)] = packed
        self.words = words.view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words))].astype(np.int64)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[np.minimum(word, len(self.words) - 1)] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one bit string per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.levels = []
        current = symbols.astype(np.int64)
        for bit in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            on = (current >> bit) & 1 == 1
            self.levels.append((bit, _Bits(on), int((~on).sum())))
            current = np.concatenate([current[~on], current[on]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros_like(at), at.copy()
        for bit, bits, zeros in self.levels:
            on = (symbol >> bit) & 1 == 1
            low_ones, high_ones = bits.ones(low), bits.ones(high)
            low = np.where(on, zeros + low_ones, low - low_ones)
            high = np.where(on, zeros + high_ones, high - high_ones)
        return high - low


class FMIndex:
    def __init__(self, text: np.ndarray, largest: int) -> None:
        """``text`` ends with a 0; ``largest`` is the largest symbol there may be."""
        order = suffix_order(text)
        self.size = len(text)
        self.last = text[order - 1]  # the symbol before each suffix; the first is preceded by the final 0
        self.wavelet = WaveletMatrix(self.last, largest)
        self.smaller = np.r_[0, np.cumsum(np.bincount(text, minlength=largest + 1))].astype(np.int64)
        # A walk backwards meets a sampled position before it leaves its run.
        kept = (order % SAMPLE == 0) | (self.last == 0)
        self.sampled = _Bits(kept)
        self.positions = order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of equally long patterns, one per row of the array."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, column].astype(np.int64)
            low[alive] = self.smaller[symbol] + self.wavelet.rank(symbol, low[alive])
            high[alive] = self.smaller[symbol] + self.wavelet.rank(symbol, high[alive])
            alive = alive[high[alive] > low[alive]]
        found = np.zeros(len(patterns), bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by stepping back to the nearest sampled one."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            here = at[open_]
            rank = self.sampled.ones(here)
            known = self.sampled.ones(here + 1) > rank
            done = open_[known]
            out[done] = self.positions[rank[known]] + steps[done]
            open_, here = open_[~known], here[~known]
            symbol = self.last[here].astype(np.int64)
            at[open_] = self.smaller[symbol] + self.wavelet.rank(symbol, here)
            steps[open_] += 1
        return out
