"""Byte-pair merges of many words at once.

All words lie end to end in one array of symbols. A round looks up the rank of
every neighbouring pair, finds each word's best one and joins it wherever it
stands in the word; words without a pair left are done. A merge's pieces are
always older than the merge, so this gives the same symbols as joining one
pair at a time. The vocabulary file stays where it is; only its merges are read.
"""

from __future__ import annotations

import json

import numpy as np

END = "</w>"
_NONE = np.int32(2**31 - 1)
_SLOTS = 18  # bits of the table that holds the pairs
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself where it is one, else the next unused code."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class WordMerges:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.uint32)
        self.last = np.array([vocab[c + END] for c in letters], np.uint32)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.uint64)
        made = np.array([vocab[a + b] for a, b in merges], np.uint32)
        self.keys = np.zeros(1 << _SLOTS, np.uint64)  # 0 stands for an empty slot; the first symbol never pairs with itself at rank 0
        self.ranks, self.made = np.full(1 << _SLOTS, _NONE), np.zeros(1 << _SLOTS, np.uint32)
        self.probes, left, at = 0, np.arange(len(keys)), self._slot(keys)
        while len(left):
            # One pair a free slot; the others try the next slot.
            free = self.ranks[at] == _NONE
            _, first = np.unique(at, return_index=True)
            takes = np.zeros(len(left), bool)
            takes[first] = True
            takes &= free
            self.keys[at[takes]], self.ranks[at[takes]], self.made[at[takes]] = keys[left[takes]], left[takes].astype(np.int32), made[left[takes]]
            left, at = left[~takes], (at[~takes] + 1) & ((1 << _SLOTS) - 1)
            self.probes += 1

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * _FACTOR) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def _lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``_NONE``: no merge) and slot of each pair."""
        slot = self._slot(keys)
        rank, same = self.ranks[slot], self.keys[slot] == keys
        open_ = np.flatnonzero(~same & (rank != _NONE))
        rank[open_] = _NONE
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << _SLOTS) - 1)
            hit = self.keys[slot[open_]] == keys[open_]
            rank[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (self.ranks[slot[open_]] != _NONE)]
        return rank, slot

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian bytes. A word holds at least one letter and no line feed."""
        if not words:
            return []
        data = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
        ends = np.flatnonzero(data == 10)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        symbols = np.delete(symbols, ends)
        sizes = np.diff(ends, prepend=-1) - 1
        owner, done = np.arange(len(words)), []
        while len(owner):
            starts = np.cumsum(sizes) - sizes
            keys = np.zeros(len(symbols), np.uint64)
            keys[:-1] = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
            rank, slot = self._lookup(keys)
            rank[starts + sizes - 1] = _NONE
            best = np.minimum.reduceat(rank, starts)
            going = best != _NONE
            each = np.repeat(going, sizes)
            done.append((owner[~going], sizes[~going], symbols[~each]))
            owner, sizes, best = owner[going], sizes[going], best[going]
            symbols, rank, slot = symbols[each], rank[each], slot[each]
            if not len(owner):
                break
            joins = rank == np.repeat(best, sizes)
            pairs = np.flatnonzero(joins)
            close = np.flatnonzero(np.diff(pairs) == 1)
            if len(close):
                # The same pair overlapping itself: every other one of a run joins.
                breaks = np.r_[0, np.flatnonzero(np.diff(pairs) != 1) + 1]
                place = np.arange(len(pairs)) - np.repeat(breaks, np.diff(np.r_[breaks, len(pairs)]))
                pairs = pairs[place % 2 == 0]
            symbols[pairs] = self.made[slot[pairs]]
            gone = np.zeros(len(symbols), np.int64)
            gone[pairs + 1] = 1
            starts = np.cumsum(sizes) - sizes
            sizes = sizes - np.add.reduceat(gone, starts)
            symbols = symbols[gone == 0]
        owner = np.concatenate([d[0] for d in done])
        sizes = np.concatenate([d[1] for d in done])
        bytes_ = np.concatenate([d[2] for d in done]).astype("<u4").tobytes()
        out: list[bytes] = [b""] * len(words)
        at = 0
        for word, size in zip(owner.tolist(), (4 * sizes).tolist(), strict=True):
            out[word] = bytes_[at : at + size]
            at += size
        return out
