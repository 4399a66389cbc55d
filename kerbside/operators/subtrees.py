"""Work on trees inside a task: a subtree over few rows, and rows that walk down a piece of a tree.

Both sides are bounded by ``trees``: Spark cuts and shuffles, these functions
see at most ``LOCAL_ROWS`` rows or ``PIECE`` nodes at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from kerbside.functions import digests

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_GAIN = 1e-9
MOST_BINS = 1 << 30  # above every bin
FEW_NODES = 40  # of which fewer are drawn for one by one


def _purity(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    return (p * p + (n - p) * (n - p)) / n


def drawn_tries(tree: int, node: str, width: int, tries: int | None) -> list[int]:
    """Features looked at in a node, as ``trees._tries`` draws them, in their own order."""
    if tries is None or tries >= width:
        return list(range(width))
    start = f"tries|{tree}|{node}|".encode()
    draws = [md5(start + b"%d" % f).digest()[:4] for f in range(width)]
    return sorted(sorted(range(width), key=draws.__getitem__)[:tries])


def matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """Lists of one length as an array with a row for each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _looker(tree: int, width: int, tries: int | None) -> Callable[[np.ndarray], np.ndarray]:
    """Function from the paths of a level's nodes, a row of characters each, to the features looked at in each node.

    The texts of a level have one length for a feature, so their draws are one MD5 over whole arrays.
    """
    start = f"tries|{tree}|".encode()

    def look(paths: np.ndarray) -> np.ndarray:
        nodes, depth = paths.shape
        if tries is None or tries >= width:
            return np.broadcast_to(np.arange(width), (nodes, width))
        head = len(start) + depth + 1
        if nodes < FEW_NODES or head + len(str(width)) > digests.BLOCK_TEXT:
            return np.array([drawn_tries(tree, bytes(path).decode(), width, tries) for path in paths])
        own = np.zeros((nodes, 64), np.uint8)
        own[:, : len(start)], own[:, len(start) : head - 1], own[:, head - 1] = np.frombuffer(start, np.uint8), paths, ord("|")
        ends = np.zeros((width, 64), np.uint8)
        for f in range(width):
            text = b"%d\x80" % f
            ends[f, head : head + len(text)] = np.frombuffer(text, np.uint8)
            ends[f, 56:] = np.frombuffer((8 * (head + len(text) - 1)).to_bytes(8, "little"), np.uint8)
        words = own.view("<u4").T[:, :, None] | ends.view("<u4").T[:, None, :]
        words = words.reshape(16, -1)
        draws = np.concatenate([digests.first_words(words[:, i : i + digests.AT_ONCE]) for i in range(0, words.shape[1], digests.AT_ONCE)])
        least = np.sort(draws.reshape(nodes, width) << 16 | np.arange(width), axis=1)[:, :tries] & 0xFFFF
        return np.sort(least, axis=1)

    return look


class Grower:
    """Grows the subtree below a node over some lines of ``bins``, level by level.

    A level is one histogram: counts per (node, feature, bin), of which only
    those that have rows go on; running sums give the counts below every cut.
    More than ``AT_ONCE`` rows are split by node as soon as there are several,
    so that what a level goes through lies in the processor's cache.
    """

    AT_ONCE, STEP = 131_072, 32_768

    def __init__(self, bins: np.ndarray, look: Callable, max_depth: int, min_split: int, min_leaf: int, widths: np.ndarray | None = None):
        self.bins, self.look, self.max_depth, self.min_split, self.min_leaf = bins, look, max_depth, min_split, min_leaf
        self.widths = bins.max(axis=0).astype(np.int64) + 1 if widths is None else widths

    def below(self, rows: np.ndarray, n: np.ndarray, p: np.ndarray, known: np.ndarray | None, node: str) -> tuple[list, ...]:
        """All nodes below ``node`` in levels: paths, n, p, whether a label is known, f, bin (-1 at a leaf) and gain."""
        all_n, all_p = n.sum(), p.sum()
        weights = [n + p * float(1 << 26)] if all_n < 1 << 26 and all_p < 1 << 26 else [n.astype(np.float64), p.astype(np.float64)]
        if known is not None:
            known = known.astype(np.float64)
        path = np.frombuffer(node.encode(), np.uint8).reshape(1, -1)
        places = rows.astype(np.int64) * self.bins.shape[1]
        return self._levels(places, weights, known, np.zeros(len(rows), np.int64), path, np.array([all_n]), np.array([all_p]))

    def _levels(self, rows: np.ndarray, weights: list[np.ndarray], known: np.ndarray | None, at: np.ndarray, paths: np.ndarray, n: np.ndarray, p: np.ndarray) -> list[tuple]:
        width, out, flat, own, left = self.bins.shape[1], [], self.bins.ravel(), False, False
        while True:
            told = None if known is None else np.bincount(at[at >= 0], known[at >= 0], len(n)) > 0
            # A pure node has nothing to gain.
            open_ = (n >= self.min_split) & (p > 0) & (p < n) & (paths.shape[1] < self.max_depth)
            f, last, gain = np.full(len(n), -1), np.full(len(n), -1), np.zeros(len(n))
            out.append((paths, n, p, told, f, last, gain))
            if not open_.any():
                return out
            if left or not open_.all():
                inside = np.append(open_, False)[at]  # a row of -1 is in no node
                at = np.append(np.cumsum(open_) - 1, 0)[at[inside]]
                rows, weights, known = rows[inside], [w[inside] for w in weights], None if known is None else known[inside]
            if not own and len(at) <= self.AT_ONCE:
                flat, rows, own = self.bins[rows // width].ravel(), np.arange(len(rows), dtype=np.int64) * width, True
            looked = self.look(paths[open_])
            score, feature, bin_, low_n, low_p = self._best_cuts(flat, rows, weights, known, at, looked, n[open_], p[open_])
            won = score - _purity(n[open_].astype(np.float64), p[open_].astype(np.float64))
            good = (score >= 0) & (won > LEAST_GAIN)
            cut = np.flatnonzero(open_)[good]
            f[cut], last[cut], gain[cut] = feature[good], bin_[good], won[good]
            if not good.any():
                return out
            key = feature.take(at, mode="clip")
            key += rows
            # In a node that is not cut no bin is above, so its rows stay at -1.
            above = flat.take(key, mode="clip") > np.where(good, bin_, MOST_BINS).take(at, mode="clip")
            at = np.where(good, 2 * (np.cumsum(good) - 1), -1).take(at, mode="clip")
            at += above
            sides = np.tile(np.frombuffer(b"01", np.uint8), len(cut))
            paths = np.concatenate([np.repeat(paths[cut], 2, axis=0), sides[:, None]], axis=1)
            n, p = (np.stack([low[good], whole[cut] - low[good]], axis=1).ravel() for low, whole in ((low_n, n), (low_p, p)))
            left = not good.all()
            if not own and len(at) > self.AT_ONCE:
                return out + self._apart(rows, weights, known, at, paths, n, p)

    def _apart(self, rows: np.ndarray, weights: list[np.ndarray], known: np.ndarray | None, at: np.ndarray, paths: np.ndarray, n: np.ndarray, p: np.ndarray) -> list[tuple]:
        """The levels of these nodes, a few nodes of at most ``AT_ONCE`` rows or one node at a time."""
        order = np.argsort((at + 1).astype(np.uint16) if len(n) < 1 << 16 else at, kind="stable")
        ends = np.cumsum(np.bincount(at + 1, minlength=len(n) + 1))
        parts, first = [], 0
        while first < len(n):
            behind = max(first + 1, int(np.searchsorted(ends, ends[first] + self.AT_ONCE, side="right")) - 1)
            own, nodes = order[ends[first] : ends[behind]], slice(first, behind)
            parts.append(self._levels(rows[own], [w[own] for w in weights], None if known is None else known[own], at[own] - first, paths[nodes], n[nodes], p[nodes]))
            first = behind
        deepest = max(map(len, parts))
        return [tuple(None if c[0] is None else np.concatenate(c) for c in zip(*[part[d] for part in parts if d < len(part)], strict=True)) for d in range(deepest)]

    def _best_cuts(self, flat: np.ndarray, rows: np.ndarray, weights: list[np.ndarray], known: np.ndarray | None, at: np.ndarray, looked: np.ndarray, all_n: np.ndarray, all_p: np.ndarray) -> tuple[np.ndarray, ...]:
        """Score, feature, last lower bin and lower counts of the best cut of every node; the first of equal ones by feature, then bin.

        As in a level over all tasks, no cut lies after a bin whose rows all miss their label.
        """
        nodes, tries = looked.shape
        keys, added = np.empty(len(at), np.int64), weights if known is None else [*weights, known]
        widths, found, lines = self.widths[looked.T], [], []
        bases = np.cumsum(widths, axis=1) - widths
        for j in range(tries):
            feature = np.ascontiguousarray(looked[:, j])
            for start in range(0, len(at), self.STEP):
                here = slice(start, start + self.STEP)
                key = keys[here]
                feature.take(at[here], mode="clip", out=key)
                key += rows[here]
                bin_ = flat.take(key, mode="clip")
                bases[j].take(at[here], mode="clip", out=key)
                key += bin_
            sums = [np.bincount(keys, w, bases[j, -1] + widths[j, -1]) for w in added]
            cell = np.flatnonzero(sums[0])
            found.append((cell, *[s[cell] for s in sums]))
            lines.append(np.searchsorted(cell, bases[j]))  # every node has rows, so every line has cells
        ahead = np.append(0, np.cumsum([len(cell) for cell, *_ in found]))
        cell, *sums = (np.concatenate(c) for c in zip(*found, strict=True))
        line = np.concatenate([own + a for own, a in zip(lines, ahead, strict=False)])
        cells = np.diff(np.append(line, len(cell)))
        if len(weights) == 1:
            both = sums[0].astype(np.int64)
            cell_n, cell_p = both & ((1 << 26) - 1), both >> 26
        else:
            cell_n, cell_p = (s.astype(np.int64) for s in sums[:2])
        nl, pl = (so_far - np.repeat(np.append(0, so_far)[line], cells) for so_far in (np.cumsum(cell_n), np.cumsum(cell_p)))
        nr, pr = np.repeat(np.tile(all_n, tries), cells) - nl, np.repeat(np.tile(all_p, tries), cells) - pl
        fits = (nl >= self.min_leaf) & (nr >= max(self.min_leaf, 1))
        if known is not None:
            blank = np.cumsum(sums[-1] == 0)
            fits &= blank == np.repeat(np.append(0, blank)[line], cells)
        fl, gl, fr, gr = (v.astype(np.float64) for v in (nl, pl, np.maximum(nr, 1), pr))
        score = np.where(fits, _purity(fl, gl) + _purity(fr, gr), -1.0)
        best = np.maximum.reduceat(score, line)
        hit = np.flatnonzero(score == np.repeat(best, cells))
        first = hit[np.searchsorted(hit, line)].reshape(tries, nodes)
        won, node = best.reshape(tries, nodes).argmax(axis=0), np.arange(nodes)
        first = first[won, node]
        return score[first], looked[node, won].astype(np.int64), cell[first] - bases[won, node], nl[first], pl[first]


def _whole(levels: list[tuple]) -> dict[str, np.ndarray]:
    """All levels of a tree as one array a column, in which the children of the j-th node that is cut are 2j + 1 and 2j + 2."""
    names = ["n", "p", "told", "f", "bin", "gain"]
    return {c: np.concatenate(parts) for c, *parts in zip(names, *[level[1:] for level in levels], strict=True) if parts[0] is not None}


def _paths(levels: list[np.ndarray]) -> pa.Array:
    """Rows of characters as texts."""
    sizes = np.concatenate([np.full(len(level), level.shape[1], np.int32) for level in levels])
    ends = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(level.tobytes() for level in levels))])


def _node_columns(paths: list[np.ndarray], whole: dict[str, np.ndarray]) -> list[pa.Array]:
    """Columns node, depth, n, p, f, bin and gain of a node table."""
    leaf = whole["f"] < 0
    unknown = ~whole["told"] if "told" in whole else None
    depth = np.concatenate([np.full(len(level), level.shape[1], np.int32) for level in paths])
    return [
        _paths(paths).cast(pa.string()), pa.array(depth), pa.array(whole["n"], pa.int64()), pa.array(whole["p"], pa.int64(), mask=unknown),
        pa.array(whole["f"], pa.int32(), mask=leaf), pa.array(whole["bin"], pa.int32(), mask=leaf), pa.array(whole["gain"], pa.float64(), mask=leaf),
    ]


def finisher(kind: pa.DataType, width: int, max_depth: int, min_split: int, tries: int | None):
    """Function for ``applyInArrow`` over rows ``(tree, node, bins, n, p, least)`` of one subtree; a null ``p`` counts in ``n`` alone."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        tree, node = key[0].as_py(), key[1].as_py()
        known = rows["p"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        n, p = (rows[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "p"))
        grower = Grower(matrix(rows["bins"], np.uint16), _looker(tree, width, tries), max_depth, min_split, rows["least"][0].as_py())
        levels = grower.below(np.arange(len(n)), n, p, None if known.all() else known, node)
        columns = _node_columns([level[0] for level in levels], _whole(levels))
        return pa.table([pa.array([tree] * len(columns[0]), kind), *columns], ["tree", "node", "depth", "n", "p", "f", "bin", "gain"])

    return run


class Bag:
    """Rows of a training table by the texts of their ids, and how often each is drawn by a tree.

    The message of a row differs between trees by its head alone, which is put into words made once.
    """

    def __init__(self, texts: pa.Array, marks: list[int]):
        self.texts, self.marks = texts, marks
        self.none = texts.is_null().to_numpy(zero_copy_only=False)
        self.head, self.parts = -1, []

    def _words(self, head: int) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Per run of rows the words that are not 0 behind a head of NULs; None where a text is long."""
        if head != self.head:
            blank, self.head, self.parts = pa.scalar("\0" * head), head, []
            for i in range(0, len(self.texts), digests.AT_ONCE):
                words = digests.words_of(pc.binary_join_element_wise(blank, self.texts.slice(i, digests.AT_ONCE).fill_null(""), ""))
                used = None if words is None else np.flatnonzero(words.any(axis=1))
                self.parts.append(None if words is None else (used, words[used]))
        return self.parts

    def drawn(self, tree: int) -> np.ndarray:
        """Number of draws of every row, as ``trees._times`` counts them; a NULL id is left out of the text as there."""
        head = f"bag|{tree}|".encode()
        start, found = np.frombuffer(head.ljust(64, b"\0"), "<u4"), []
        for i, part in enumerate(self._words(len(head))):
            if part is None:
                found.append(digests.draws(f"bag|{tree}", self.texts.slice(i * digests.AT_ONCE, digests.AT_ONCE)))
                continue
            words = np.zeros((16, part[1].shape[1]), np.uint32)
            words[part[0]] = part[1]
            filled = -(-len(head) // 4)
            words[:filled] |= start[:filled, None]
            found.append(digests.first_words(words))
        draws = np.concatenate(found).astype(np.uint32)
        if self.none.any():
            draws[self.none] = int.from_bytes(md5(f"bag|{tree}".encode()).digest()[:4], "big")
        n = np.zeros(len(draws), np.uint8)
        for mark in self.marks:
            n += draws >= np.uint32(mark)
        return n


def blocks_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows ``(text, bins, p, fold)`` as blocks of bytes."""
    for batch in batches:
        if batch.num_rows:
            bins = matrix(batch.column("bins"), np.uint16)
            lines = pa.Array.from_buffers(pa.binary(2 * bins.shape[1]), len(bins), [None, pa.py_buffer(bins.tobytes())])
            held = pa.RecordBatch.from_arrays([batch.column("text"), lines, batch.column("p"), batch.column("fold")], ["text", "bins", "p", "fold"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held.schema) as out:
                out.write_batch(held)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["data"])


class Lines:
    """All training rows of a task, put together from its blocks in the order of their numbers."""

    def __init__(self, blocks: dict[int, bytes], marks: list[int]):
        held = pa.concat_tables([pa.ipc.open_stream(blocks.pop(b)).read_all() for b in sorted(blocks)]).combine_chunks()
        lines = held["bins"].chunk(0)
        bins = np.frombuffer(lines.buffers()[1], np.uint16, len(held) * lines.type.byte_width // 2, lines.offset * lines.type.byte_width).reshape(len(held), -1)
        self.widths = bins.max(axis=0).astype(np.int64) + 1
        self.bins = bins.astype(np.uint8) if self.widths.max() <= 256 else bins
        label = held["p"].chunk(0)
        self.known, self.p = label.is_valid().to_numpy(zero_copy_only=False), label.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.fold = held["fold"].chunk(0).fill_null(-1).to_numpy(zero_copy_only=False)
        text = held["text"].chunk(0)
        self.texts, self.bag = text, Bag(text, marks)

    def grown(self, tree: int, drawn: np.ndarray, growth: tuple, least: int) -> dict[str, np.ndarray] | None:
        """The tree over the rows that are drawn, as ``_whole`` gives it; None where none is."""
        max_depth, min_split, tries = growth
        rows = np.flatnonzero(drawn)
        if not len(rows):
            return None
        n, known = drawn[rows].astype(np.int64), self.known[rows]
        grower = Grower(self.bins, _looker(tree, self.bins.shape[1], tries), max_depth, min_split, least, self.widths)
        return _whole(grower.below(rows, n, n * self.p[rows], None if known.all() else known, ""))


def _blocks_by(batches: Iterator[pa.RecordBatch]) -> tuple[list | None, dict[int, bytes]]:
    """The key of a task, as its rows carry it, and the blocks that came to it."""
    key, blocks = None, {}
    for batch in batches:
        for row in batch.to_pylist():
            key, blocks[row["block"]] = row["key"], row["data"]
    return key, blocks


PACKED = "tree int, nodes long, f binary, bin binary, n binary, p binary, told binary, gain binary"
PACKED_TYPES = {"f": np.int16, "bin": np.int16, "n": np.int64, "p": np.int64, "told": np.bool_, "gain": np.float64}


def forest_grower(growth: tuple, least: int, marks: list[int]):
    """Function for ``mapInArrow`` over all blocks of training rows with the key ``(first, step, trees)`` of the trees that the task grows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, blocks = _blocks_by(batches)
        if not blocks:
            return
        lines = Lines(blocks, marks)
        first, step, trees = key
        for tree in range(first, trees, step):
            whole = lines.grown(tree, lines.bag.drawn(tree), growth, least)
            if whole:
                packed_columns = [pa.array([whole[c].astype(t).tobytes() if c in whole else None], pa.binary()) for c, t in PACKED_TYPES.items()]
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([len(whole["f"])], pa.int64()), *packed_columns], ["tree", "nodes", *PACKED_TYPES])

    return run


def _unpacked(row: dict) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(row[c], t) for c, t in PACKED_TYPES.items() if row.get(c) is not None}


def _level_sizes(f: np.ndarray) -> list[int]:
    """Nodes of each level, of which every node that is cut has two in the next."""
    cut, sizes, start = np.append(0, np.cumsum(f >= 0)), [1], 0
    while sizes[-1]:
        end = start + sizes[-1]
        sizes.append(int(2 * (cut[end] - cut[start])))
        start = end
    return sizes[:-1]


def unpacked_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed trees as rows of a node table."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            whole, paths, start = _unpacked(row), [np.zeros((1, 0), np.uint8)], 0
            for size in _level_sizes(whole["f"])[:-1]:
                above = np.repeat(paths[-1][whole["f"][start : start + size] >= 0], 2, axis=0)
                paths.append(np.concatenate([above, np.tile(np.frombuffer(b"01", np.uint8), len(above) // 2)[:, None]], axis=1))
                start += size
            columns = _node_columns(paths, whole)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), row["tree"], np.int32)), *columns], ["tree", "node", "depth", "n", "p", "f", "bin", "gain"])


def unpacked_gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the gains of every feature that a packed tree cuts by."""
    for batch in batches:
        for row in batch.select(["tree", "f", "gain"]).to_pylist():
            whole = _unpacked(row)
            cut = whole["f"] >= 0
            sums, used = np.bincount(whole["f"][cut], whole["gain"][cut]), np.bincount(whole["f"][cut])
            f = np.flatnonzero(used)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), row["tree"], np.int32)), pa.array(f, pa.int32()), pa.array(sums[f], pa.float64())], ["tree", "f", "gain"])


class Steps:
    """A packed tree to walk down: where a node leads, its feature and bin in one number; a leaf leads to itself."""

    CHUNK, LEAF = 16_384, 0xFFFF

    def __init__(self, whole: dict[str, np.ndarray]):
        f, bin_ = (whole[c].astype(np.int64) for c in ("f", "bin"))
        cut = f >= 0
        low = np.where(cut, 2 * np.cumsum(cut) - 1, np.arange(len(cut)))
        self.word = low << 32 | np.where(cut, f, 0) << 16 | np.where(cut, bin_, self.LEAF)
        self.sizes = _level_sizes(whole["f"])
        unknown = ~whole["told"] if "told" in whole else np.zeros(len(cut), bool)
        self.share = np.where(unknown, np.nan, whole["p"] / whole["n"])

    def leaves(self, flat: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
        """The leaf of every one of these rows of ``width`` bins each."""
        found = np.empty(len(rows), np.int64)
        for start in range(0, len(rows), self.CHUNK):
            place = rows[start : start + self.CHUNK] * width
            ends, out = np.arange(start, start + len(place)), np.zeros(len(place), np.int64)
            for depth in range(len(self.sizes) - 1):
                word = self.word.take(out, mode="clip")
                if depth % 4 == 3:
                    here = (word & self.LEAF) != self.LEAF
                    if not here.all():
                        found[ends[~here]] = out[~here]
                        ends, place, word = ends[here], place[here], word[here]
                key = word >> 16
                key &= 0xFFFF
                key += place
                bin_ = flat.take(key, mode="clip")
                out = word >> 32
                word &= self.LEAF
                out += bin_ > word
            found[ends] = out
        return found

    def stops(self, n: np.ndarray, f: np.ndarray, ends: list[tuple[int, int]]) -> np.ndarray:
        """Share of the node at which a walk ends, for every end of a walk (depth, least to split) and every node it may lead to."""
        shares, start, above = np.full((len(ends), len(n)), np.nan), 0, None
        cut = np.flatnonzero(f >= 0)
        for depth, size in enumerate(self.sizes):
            level = slice(start, start + size)
            if depth:
                parent = cut[(np.arange(start, start + size) - 1) // 2]
                shares[:, level], above = shares[:, parent], n[parent]
            for e, (deepest, least) in enumerate(ends):
                here = ((f[level] < 0) | (depth >= deepest) | (n[level] < least)) & (True if above is None else above >= least) & (depth <= deepest)
                shares[e, level] = np.where(here, self.share[level], shares[e, level])
            start += size
        return shares


def blocks_of_values(marks: list[list[float]]):
    """Function for ``mapInArrow`` over rows ``(id, vals)``: blocks of ids and of bins in bytes, for trees that cut by these marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vals = matrix(batch.column("vals"), np.float64)
                bins = np.empty((len(vals), len(marks)), np.uint16)
                for i, least in enumerate(marks):
                    # A missing value is above every number, and no number above the last mark.
                    bins[:, i] = np.where(vals[:, i] < np.inf, np.searchsorted(np.array(least), vals[:, i], side="right"), len(least) + 1)
                ids = pa.ListArray.from_arrays(pa.array([0, len(vals)], pa.int32()), batch.column("id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([bins.tobytes()], pa.binary())], ["ids", "data"])

    return run


def forest_walker(kind: pa.DataType, width: int):
    """Function for ``mapInArrow`` over some packed trees and, after them, blocks of rows: sums and numbers of the leaf shares of a block's rows.

    Only the task that is ``first`` hands the ids of a block on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = []
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("block")[i].as_py() is None:
                    trees.append(Steps(_unpacked({c: batch.column(c)[i].as_py() for c in ("f", "bin", "n", "p", "told")})))
                    continue
                flat = np.frombuffer(batch.column("data")[i].as_buffer(), np.uint16)
                rows = np.arange(len(flat) // width)
                sums, told = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
                for tree in trees:
                    share = tree.share.take(tree.leaves(flat, rows, width))
                    known = ~np.isnan(share)  # a leaf whose rows all miss their label has none
                    sums += np.where(known, share, 0.0)
                    told += known
                ids = batch.column("ids").slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(i, 1), ids.cast(pa.list_(kind)), pa.array([sums.tobytes()], pa.binary()), pa.array([told.tobytes()], pa.binary())],
                    ["block", "ids", "sums", "told"])

    return run


def added_up(kind: pa.DataType):
    """Function for ``applyInArrow`` over all sums of a block: ``(id, s0, s1)`` of its rows."""

    def run(parts: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(b, np.float64) for b in parts["sums"].to_pylist())
        told = sum(np.frombuffer(b, np.int64) for b in parts["told"].to_pylist())
        ids = parts["ids"].combine_chunks().flatten()
        return pa.table([ids.cast(kind), pa.array(sums), pa.array(told.astype(np.float64))], ["id", "s0", "s1"])

    return run


GRID_SUMS = "fold int, chunk int, segment int, texts array<string>, sums binary, told binary"


def grid_grower(growth: tuple, least: list[int], ends: list[tuple[int, int]], marks: list[int], fold_place: int, size_place: int, rows_at_once: int = 16_384):
    """Function for ``mapInArrow`` over all blocks of rows with the key ``(fold, segment, first, step, behind)``.

    The task grows its trees of the fold for every leaf size over the rows of
    the other folds, walks the fold's own rows down each at once, and gives
    the sums of their shares per leaf size and end of a walk. A tree is never stored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, blocks = _blocks_by(batches)
        if not blocks:
            return
        lines = Lines(blocks, marks)
        fold, segment, first, step, behind = key
        own, flat, width = np.flatnonzero(lines.fold == fold), lines.bins.ravel(), lines.bins.shape[1]
        away = (lines.fold != fold) & (lines.fold >= 0)
        sums, told = np.zeros((len(least), len(ends), len(own))), np.zeros((len(least), len(ends), len(own)), np.int32)
        grew = False
        for t in range(first, behind, step):
            drawn = lines.bag.drawn(fold * fold_place + t) * away
            for s, leaf in enumerate(least):
                whole = lines.grown(s * size_place + fold * fold_place + t, drawn, growth, leaf)
                if whole is None:
                    continue
                grew, steps = True, Steps(whole)
                shares, at = steps.stops(whole["n"], whole["f"], ends), steps.leaves(flat, own, width)
                for e in range(len(ends)):
                    share = shares[e].take(at, mode="clip")
                    known = ~np.isnan(share)
                    sums[s, e] += np.where(known, share, 0.0)
                    told[s, e] += known
        tells = first == 0  # one task of a fold hands on the ids
        for chunk, start in enumerate(range(0, len(own) if grew or tells else 0, rows_at_once)):
            here = slice(start, start + rows_at_once)
            texts = lines.texts.take(pa.array(own[here]))
            texts = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts) if tells else pa.nulls(1, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([fold], pa.int32()), pa.array([chunk], pa.int32()), pa.array([segment], pa.int32()), texts,
                 pa.array([sums[:, :, here].tobytes() if grew else None], pa.binary()), pa.array([told[:, :, here].tobytes() if grew else None], pa.binary())],
                ["fold", "chunk", "segment", "texts", "sums", "told"])

    return run


def grid_sums(sizes: int, ends: int, segments: int):
    """Function for ``applyInArrow`` over all sums of a chunk of rows: ``(text, size, sums)`` with the sum and number of shares up to every segment."""

    def run(parts: pa.Table) -> pa.Table:
        texts = parts["texts"].combine_chunks().flatten()
        grown = parts.select(["segment", "sums", "told"]).filter(pc.is_valid(parts["sums"])).to_pylist()
        texts = texts if grown else texts[:0]
        found = np.zeros((sizes, ends, segments, 2, len(texts)))
        for row in grown:
            found[:, :, row["segment"] :, 0] += np.frombuffer(row["sums"], np.float64).reshape(sizes, ends, 1, -1)
            found[:, :, row["segment"] :, 1] += np.frombuffer(row["told"], np.int32).reshape(sizes, ends, 1, -1)
        wide = ends * segments * 2
        flat = pa.array(np.ascontiguousarray(found.reshape(sizes, wide, -1).transpose(0, 2, 1)).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, wide), pa.int32()), flat)
        return pa.table([pa.concat_arrays([texts] * sizes), pa.array(np.repeat(np.arange(sizes, dtype=np.int32), len(texts))), lists], ["text", "size", "sums"])

    return run


def packed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows ``(keys, id, vals, above)`` as blocks: lists of ids, numbers in bytes; a block has one key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = [0]
        if keys:
            key = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
            starts += [i for i in range(1, len(key)) if key[i] != key[i - 1]]
        ends = [*starts[1:], batch.num_rows]
        numbers = matrix(batch.column("vals"), np.float64)
        above = batch.column("above").to_numpy(zero_copy_only=False).astype(np.int64)
        ids = pa.ListArray.from_arrays(pa.array([*starts, batch.num_rows], pa.int32()), batch.column("id"))
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([batch.column(k)[s].as_py() for s in starts], batch.schema.field(k).type) for k in keys], ids,
             pa.array([numbers[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
             pa.array([above[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())],
            [*keys, "ids", "vals", "above"],
        )


class Piece:
    """A piece of a tree by its nodes ``(heap, f, threshold, share, n)`` in heap order: children of h are 2h and 2h + 1."""

    def __init__(self, nodes: pa.Array):
        self.heap, self.f, self.threshold, self.share, self.n = (
            nodes.field(i).to_numpy(zero_copy_only=False) for i in range(5))
        found = np.searchsorted(self.heap, 2 * self.heap)
        there = (found < len(self.heap)) & (self.heap[np.minimum(found, len(self.heap) - 1)] == 2 * self.heap)
        self.low = np.where(there, found, -1)


def walker(kind: pa.DataType, tree_kind: pa.DataType, ends: list[tuple[int, int]], counts: list[int], depth: int):
    """Function for ``mapInArrow`` over pairs of a block of rows and a piece of a tree.

    Gives per row and group of trees the sum and number of the shares at every
    end of a walk for every number of trees, and the rows that go on below the piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sums, left = None, None, {}, []

        def told() -> Iterator[pa.RecordBatch]:
            for size, total in sums.items():
                rows = total.shape[-1]
                flat = pa.array(np.ascontiguousarray(total.reshape(-1, rows).T).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, total[..., 0].size), pa.int32()), flat)
                none = [pa.nulls(rows, t) for t in (tree_kind, pa.int32(), pa.string(), pa.list_(pa.float64()), pa.int64())]
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(rows, size, np.int32)), lists, *none], NAMES)
            yield from left
            sums.clear()
            left.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column("block")[i].as_py()
                if number != block:
                    yield from told()
                    block, ids = number, batch.column("ids")[i].values
                    given_above = np.frombuffer(batch.column("above")[i].as_buffer(), np.int64)
                    x = np.frombuffer(batch.column("vals")[i].as_buffer(), np.float64).reshape(len(ids), -1)
                tree, size, t, node = (batch.column(c)[i].as_py() for c in ("tree", "size", "t", "node"))
                piece = Piece(batch.column("piece")[i].values)
                if size not in sums:
                    sums[size] = np.zeros((len(ends), len(counts), 2, len(ids)))
                total, counted = sums[size], [j for j, c in enumerate(counts) if t < c]
                rows, at, above, at_depth = np.arange(len(ids)), np.zeros(len(ids), np.int64), given_above, depth
                while len(rows):
                    leaf, n = piece.f[at] < 0, piece.n[at]
                    for e, (deepest, least) in enumerate(ends):
                        if at_depth > deepest:
                            continue
                        stops = (leaf | (at_depth >= deepest) | (n < least)) & (above >= least)
                        share = piece.share[at[stops]]
                        told_share = ~np.isnan(share)  # a leaf whose rows all miss their label has none
                        for j in counted:
                            total[e, j, 0, rows[stops][told_share]] += share[told_share]
                            total[e, j, 1, rows[stops][told_share]] += 1
                    rows, at, above = rows[~leaf], at[~leaf], n[~leaf]
                    high = ~(x[rows, piece.f[at]] < piece.threshold[at])  # a missing value goes to 1
                    out = piece.low[at] < 0
                    if out.any():
                        paths = [node + bin(h)[3:] + ("1" if up else "0") for h, up in zip(piece.heap[at[out]].tolist(), high[out].tolist(), strict=True)]
                        going = rows[out]
                        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(going) + 1) * x.shape[1], pa.int32()), pa.array(x[going].ravel()))
                        k = len(going)
                        left.append(pa.RecordBatch.from_arrays([
                            ids.take(pa.array(going)), pa.array(np.full(k, size, np.int32)), pa.nulls(k, pa.list_(pa.float64())), pa.array([tree] * k, tree_kind),
                            pa.array(np.full(k, t, np.int32)), pa.array(paths, pa.string()), flat, pa.array(above[out])], NAMES))
                        rows, at, above, high = rows[~out], at[~out], above[~out], high[~out]
                    at, at_depth = piece.low[at] + high, at_depth + 1
        yield from told()

    return run


NAMES = ["id", "size", "sums", "tree", "t", "node", "vals", "above"]
