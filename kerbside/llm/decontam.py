"""Benchmark decontamination with one FM-index per shard of training text.

Words are runs of letters, digits and characters beyond ASCII, A-Z lowered. A
window is ``WINDOW`` consecutive words of a test item, or the whole item if it
has fewer. Each task turns its documents into shards. A shard's index holds
every stretch of words that could contain a window: words outside the test
vocabulary become separators, and stretches shorter than the shortest window
are left out, which loses no occurrence. Backward search finds each window's
suffixes, sampled positions locate them, and overlapping or touching
occurrences of a document merge into removal spans.

Test items come to the driver only up to ``BLOCK_CHARS`` at a time. A larger
benchmark is searched in several passes over the documents, one per block of
items, whose hits are merged per document.

Defined cases: null texts have no words; null item ids are left out; an id with
several texts is one item; repeated documents and null ids are answered row by
row; an empty benchmark or document table gives no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.fm_index import FMIndex
from kerbside.llm.tables import stored

WINDOW = 10
SHARD_WORDS = 1 << 20
SHARD_CHARS = 1 << 26
BLOCK_CHARS = 1 << 25
MOST_LOCATED = 1 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# A-Z lowered; ASCII outside letters and digits becomes a blank.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


@dataclass
class Windows:
    """Test windows by length, over numbered words; ``items`` of a window by its number."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    patterns: dict[int, np.ndarray] = field(default_factory=dict)
    numbers: dict[int, np.ndarray] = field(default_factory=dict)
    item_start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    item_of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    items: list[str] = field(default_factory=list)

    @property
    def shortest(self) -> int:
        return min(self.patterns, default=WINDOW)


def windows_of(rows: list[tuple[str, str | None]], window: int = WINDOW) -> Windows:
    made = Windows()
    owners: dict[tuple[int, ...], set[int]] = {}
    names: dict[str, int] = {}
    for item, text in rows:
        number = names.setdefault(item, len(names))
        ids = [made.vocabulary.setdefault(w, len(made.vocabulary) + 1) for w in words_of(text)]
        if ids:
            for at in range(max(1, len(ids) - window + 1)):
                owners.setdefault(tuple(ids[at : at + window]), set()).add(number)
    made.items = list(names)
    for number, (pattern, _) in enumerate(owners.items()):
        made.patterns.setdefault(len(pattern), []).append(pattern)
        made.numbers.setdefault(len(pattern), []).append(number)
    made.patterns = {n: np.array(p, np.int64) for n, p in made.patterns.items()}
    made.numbers = {n: np.array(p, np.int64) for n, p in made.numbers.items()}
    lists = [sorted(o) for o in owners.values()]
    made.item_start = np.cumsum([0, *map(len, lists)])
    made.item_of = np.array([i for o in lists for i in o], np.int64)
    return made


@dataclass
class Shard:
    """Stretches of documents that may hold a window, in one text with separators."""

    docs: int = 0
    chars: int = 0
    words: int = 0
    parts: list[np.ndarray] = field(default_factory=list)
    doc_of: list[np.ndarray] = field(default_factory=list)
    place_of: list[np.ndarray] = field(default_factory=list)

    def add(self, ids: np.ndarray, shortest: int) -> None:
        """Take in the next document, given as vocabulary numbers (0: another word)."""
        known = np.r_[False, ids > 0, False]
        starts, ends = np.flatnonzero(known[1:] & ~known[:-1]), np.flatnonzero(~known[1:] & known[:-1])
        for start, end in zip(starts, ends, strict=True):
            if end - start >= shortest:
                self.parts.append(np.r_[ids[start:end], 0])
                self.doc_of.append(np.full(end - start + 1, self.docs))
                self.place_of.append(np.arange(start, end + 1))
                self.words += end - start + 1
        self.docs += 1

    def hits(self, windows: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces of (document, first word, end word, window) over all occurrences."""
        if not self.parts:
            return
        text, doc, place = np.concatenate(self.parts), np.concatenate(self.doc_of), np.concatenate(self.place_of)
        index = FMIndex(text, len(windows.vocabulary))
        for length, patterns in windows.patterns.items():
            low, high = index.search(patterns)
            found = np.flatnonzero(high > low)
            cut = np.searchsorted(np.cumsum(high[found] - low[found]), np.arange(MOST_LOCATED, int((high - low).sum()) + 1, MOST_LOCATED))
            for some in np.split(found, np.unique(cut)):
                count = high[some] - low[some]
                ends = np.cumsum(count)
                rows = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(low[some], count)
                at = index.locate(rows)
                yield doc[at], place[at], place[at] + length, np.repeat(windows.numbers[length][some], count)


def _doc_results(shard: Shard, windows: Windows) -> tuple[dict[int, list[tuple[int, int]]], dict[int, list[str]]]:
    """Merged [first, end) word stretches and item ids of the documents that have any."""
    stretches, items = [], []
    for doc, first, end, window in shard.hits(windows):
        key = np.unique(np.stack([doc, first, end], 1), axis=0)
        stretches.append(key)
        count = windows.item_start[window + 1] - windows.item_start[window]
        ends = np.cumsum(count)
        entry = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(windows.item_start[window], count)
        items.append(np.unique(np.stack([np.repeat(doc, count), windows.item_of[entry]], 1), axis=0))
    merged: dict[int, list[tuple[int, int]]] = {}
    if not stretches:
        return merged, {}
    for doc, first, end in np.unique(np.concatenate(stretches), axis=0).tolist():
        runs = merged.setdefault(doc, [])
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((first, end))
    named: dict[int, list[str]] = {}
    for doc, item in np.unique(np.concatenate(items), axis=0).tolist():
        named.setdefault(doc, []).append(windows.items[item])
    return merged, named


def _char_spans(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"first": a, "last": b - 1, "start": places[a][0], "end": places[b - 1][1]} for a, b in runs]


_HITS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_HITS_SQL = "array<struct<first:int,last:int,start:int,end:int>>"


def _one_pass(docs: DataFrame, keep: list[str], windows: Windows) -> DataFrame:
    """The columns to keep plus n_words, hits and items for one block of test items."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(windows))  # bounded by BLOCK_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = Windows(**shared.value)
        number, shortest = test.vocabulary.get, test.shortest
        shard, held, counts = Shard(), [], []

        def finished() -> Iterator[pa.RecordBatch]:
            merged, named = _doc_results(shard, test)
            doc = 0
            for batch, n_words in zip(held, counts, strict=True):
                rows = range(doc, doc + batch.num_rows)
                doc += batch.num_rows
                spans = [_char_spans(batch.column(0)[i].as_py(), merged[d]) if d in merged else [] for i, d in enumerate(rows)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(n_words, pa.int64()), pa.array(spans, _HITS), pa.array([sorted(named.get(d, ())) for d in rows], pa.list_(pa.string()))],
                    [*keep, "n_words", "hits", "items"],
                )

        for batch in batches:
            n_words = []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                n_words.append(len(words))
                ids = [number(w, 0) for w in words]
                shard.add(np.fromiter(ids, np.int64, len(ids)), shortest)
            held.append(batch)
            counts.append(n_words)
            shard.chars += batch.nbytes
            if shard.words >= SHARD_WORDS or shard.chars >= SHARD_CHARS:
                yield from finished()
                shard, held, counts = Shard(), [], []
        if held:
            yield from finished()

    picked = docs.select(F.col("text").cast("string").alias("__text"), *(F.col(f"`{c}`") for c in keep))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return picked.mapInArrow(run, f"{schema + ', ' if schema else ''}n_words long, hits {_HITS_SQL}, items array<string>")


def _merged(hits):
    """Stretches of several passes in one sorted list without overlaps."""
    none = F.array().cast(_HITS_SQL)
    joined = lambda acc, x: F.concat(
        F.slice(acc, F.lit(1), F.size(acc) - 1),
        F.array(F.struct(
            F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], x["last"]).alias("last"),
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
        )),
    )
    return F.aggregate(
        F.array_sort(hits), none,
        lambda acc, x: F.when((F.size(acc) > 0) & (x["first"] <= F.element_at(acc, -1)["last"] + 1), joined(acc, x)).otherwise(F.concat(acc, F.array(x))),
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The columns to keep (all by default) plus n_words, hits (words first to last, code points start to end) and items."""
    taken = ("n_words", "hits", "items", "__row")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in taken]
    tests = benchmark.filter(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
    )
    chars = tests.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = 1 + int(chars) // block_chars
    part = F.pmod(F.xxhash64("item"), F.lit(blocks))

    def windows(block: int) -> Windows:
        rows = tests.filter(part == block) if blocks > 1 else tests
        return windows_of(sorted(((r["item"], r["text"]) for r in rows.toLocalIterator()), key=lambda r: (r[0], r[1] or "")), window)

    if blocks == 1:
        return _one_pass(docs, keep, windows(0))
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "decontam-docs")
    passes = [_one_pass(numbered, ["__row"], windows(b)) for b in range(blocks)]
    union = passes[0]
    for other in passes[1:]:
        union = union.unionByName(other)
    found = union.groupBy("__row").agg(
        F.max("n_words").alias("n_words"), _merged(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return numbered.select("__row", *(F.col(f"`{c}`") for c in keep)).join(found, "__row").drop("__row")


def without_spans(text, hits):
    """The text with the removal spans cut out, each replaced by one blank."""
    ends = F.concat(F.array(F.lit(0)), F.transform(hits, lambda h: h["end"]))
    starts = F.concat(F.transform(hits, lambda h: h["start"]), F.array(F.length(text)))
    kept = F.zip_with(ends, starts, lambda a, b: F.substr(text, a + 1, b - a))
    return F.when(F.size(hits) > 0, F.array_join(kept, " ")).otherwise(text)
