"""N-gram Jaccard join: documents whose sets of word n-grams are alike, and the groups they form.

1. One pass hashes every text's distinct shingles. Equal sets are one class
   (exact copies need no comparison), with a bitmap signature whose width grows
   with the set. The same pass sketches in how many texts each shingle occurs.
2. A second pass orders each class's shingles from rare to frequent by the
   sketch and emits the prefix in which two alike sets must share an element.
   Elements that only one class has are dropped.
3. The first links are stars: each class against a few pivots of two of its
   prefix elements. They join most copies of a text at linear cost.
4. What is left are tiles: one prefix element and one band of set sizes, so
   that alike sets lie in the same or the next band. Pairs of a tile that are
   not yet connected are held against the size and position bounds.
5. Every candidate pair passes the bit counts of its signatures, which bound the
   overlap from above, and then the exact intersection of the sorted arrays.

Nothing is capped: the sketch and the stars only change how much work is left.
Shingles are 64-bit hashes, and classes 64-bit hashes of the sorted set beside its size.

Defined cases: null or blank texts have an empty set and link to nothing; a
text with fewer words than a shingle is one shingle; rows without an id are
counted but link to nothing (null component); repeated ids are one node; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.tables import stored

MOST_CACHED = 250_000
SKETCH_PART = 4096
FLUSH = 1 << 21
PIVOTS = 8

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. Words are cut at ASCII white space, A-Z lowered."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if not len(each):
        return each
    size = min(words, len(each))
    count = len(each) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed = mixed * _FACTOR + each[k : k + count]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def class_of(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def signature(shingles: np.ndarray) -> bytes:
    """A bitmap of the next power of two at least as large as the set, 64 at least."""
    width = max(64, 1 << (len(shingles) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[shingles & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def overlap_bound(a: bytes, n_a: int, b: bytes, n_b: int) -> int:
    """At most so many common elements: each bit set on one side only is an element the other side lacks."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    width = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(v.reshape(-1, width), axis=0) for v in (x, y))
    return min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))


def _is_alike(common: int, n_a: int, n_b: int, num: int, den: int) -> bool:
    return den * common >= num * (n_a + n_b - common)


# --- passes over the texts ------------------------------------------------------------


def _set_pass(docs: DataFrame, words: int, counters: int) -> DataFrame:
    """A row (doc_id, n, cls, sig) per document, and the task's share of the sketch in rows of (part, counts)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sketch, waiting, size = _Hashes(), np.zeros(counters, np.int64), [], 0
        id_type, names = None, ["doc_id", "n", "cls", "sig", "part", "counts"]

        def flush() -> None:
            nonlocal waiting, size
            if waiting:
                np.add(sketch, np.bincount(np.concatenate(waiting), minlength=counters), out=sketch)
            waiting, size = [], 0

        for batch in batches:
            id_type = batch.schema.field(0).type
            n, cls, sig = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, words, hashes)
                n.append(len(found))
                cls.append(class_of(found) if len(found) else None)
                sig.append(signature(found) if len(found) else None)
                waiting.append((found & np.uint64(counters - 1)).astype(np.int64))
                size += len(found)
                if size >= FLUSH:
                    flush()
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(sig, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names
            )
        flush()
        if id_type is not None:
            step = min(SKETCH_PART, counters)
            parts = [zlib.compress(np.minimum(sketch[at : at + step], 2**32 - 1).astype("<u4").tobytes(), 1) for at in range(0, counters, step)]
            rows = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(rows, id_type), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), pa.array(range(rows), pa.int32()), pa.array(parts, pa.binary())], names
            )

    return docs.mapInArrow(run, f"doc_id {kind}, n long, cls long, sig binary, part int, counts binary")


def _frequency_levels(parts: DataFrame, counters: int) -> np.ndarray:
    """For each counter how often its count doubles past twice the mean; almost all are 0."""

    def add(group: pa.Table) -> pa.Table:
        sums = np.zeros(min(SKETCH_PART, counters), np.int64)
        for data in group["counts"].to_pylist():
            sums += np.frombuffer(zlib.decompress(data), "<u4")
        return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int32()), "total": [int(sums.sum())], "sums": pa.array([sums.tolist()], pa.list_(pa.int64()))})

    summed = stored(parts.groupBy("part").applyInArrow(add, "part int, total long, sums array<long>"), "sketch")
    mean = (summed.agg(F.sum("total")).first()[0] or 0) / counters
    frequent = (
        summed.select("part", F.posexplode("sums").alias("at", "n")).filter(F.col("n") >= 4 * mean).filter("n > 1")
        .select((F.col("part") * min(SKETCH_PART, counters) + F.col("at")).alias("counter"), "n")
    )
    levels = np.zeros(counters, np.uint8)
    for r in frequent.toLocalIterator():  # at most a quarter of the counters
        levels[r["counter"]] = int(np.log2(r["n"] / (2 * mean)))
    return levels


def prefix_size(n: int, num: int, den: int) -> int:
    """Two alike sets share an element among each one's so many first."""
    return n - -(-num * n // den) + 1


def index_size(n: int, num: int, den: int) -> int:
    """The same for the smaller set of a pair."""
    return n - -(-2 * num * n // (num + den)) + 1


def _prefix_pass(docs: DataFrame, words: int, levels: np.ndarray, num: int, den: int) -> DataFrame:
    """(token, cls, n, pos) of every class's prefix; a task emits each class once."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # one byte per counter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, level = _Hashes(), set(), shared.value
        for batch in batches:
            tokens, sizes, cls, ns = [], [], [], []
            for text in batch.column(0).to_pylist():
                found = shingle_set(text, words, hashes)
                key = class_of(found) if len(found) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                keep = prefix_size(len(found), num, den)
                order = np.argsort(level[found & np.uint64(len(level) - 1)], kind="stable")[:keep]
                tokens.append(found[order].astype(np.int64))
                sizes.append(len(order))
                cls.append(key)
                ns.append(len(found))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens)), pa.array(np.repeat(np.array(cls, np.int64), sizes)),
                        pa.array(np.repeat(np.array(ns, np.int32), sizes)), pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])),
                    ],
                    ["token", "cls", "n", "pos"],
                )

    return docs.select("text").mapInArrow(run, "token long, cls long, n int, pos int")


# --- links ----------------------------------------------------------------------------


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes that are alike, by bitmap bound and then exact intersection."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("sig_a", "n_a", "sig_b", "n_b")]
            keep = [_is_alike(overlap_bound(x, n, y, m), n, m, num, den) for x, n, y, m in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda s: classes.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
    signed = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "n_a", "sig_b", "n_b")
    open_ = stored(signed.mapInArrow(bounded, "a long, b long"), "alike-bound")

    ends = open_.select(F.col("a").alias("cls")).union(open_.select("b")).distinct()
    wanted = stored(ends.join(classes, "cls").select(F.col("least").alias("doc_id")).distinct(), "alike-docs")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            sets = [shingle_set(t, words, hashes) for t in batch.column(0).to_pylist()]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "shingles"]
            )

    texts = docs.join(wanted, "doc_id", "left_semi").select("text")
    exact = stored(texts.mapInArrow(arrays, "cls long, shingles binary"), "alike-sets")

    def intersected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(_is_alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), num, den))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (
        open_.join(exact.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
        .join(exact.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    return stored(both.mapInArrow(intersected, "a long, b long").distinct(), "alike")


def size_bands(num: int, den: int, most: int = 1 << 31) -> list[int]:
    """Least sizes of the bands: a set and any larger one alike to it are in the same or the next band."""
    edges = [1]
    while edges[-1] < most:
        edges.append(edges[-1] * den // num + 1)
    return edges


def _band(n, num: int, den: int):
    return F.size(F.filter(F.array(*map(F.lit, size_bands(num, den))), lambda e: e <= n))


def _pivot_pairs(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Each class against pivots of its own size that share its first element or its most shared one.

    Copies of one text differ least from the one that was changed least, which
    shares most elements with others. So the pivots of an element and size band
    are the most sharing of all classes that hold it, one from each of
    ``PIVOTS`` draws: a copy that lost the element that most others share still
    meets the least changed one under another.
    """
    placed = postings.withColumn("band", _band(F.col("n"), num, den))
    shared = placed.groupBy("token", "band").agg(F.count("*").alias("shared"))
    of_class = Window.partitionBy("cls")
    held = stored(
        placed.join(shared, ["token", "band"]).select(
            "token", "band", "cls", F.sum("shared").over(of_class).alias("weight"),
            (F.min(F.struct("pos", "token")).over(of_class)["token"] == F.col("token")).alias("rarest"),
            (F.max(F.struct("shared", "token")).over(of_class)["token"] == F.col("token")).alias("widest"),
        ), "held",
    )
    asked = held.filter("rarest OR widest").select("token", "band", "cls")
    draw = F.pmod(F.xxhash64("cls"), F.lit(PIVOTS))
    heads = held.groupBy("token", "band", draw.alias("draw")).agg(F.max_by("cls", F.struct("weight", "cls")).alias("pivot"))
    found = asked.join(heads, ["token", "band"]).filter("cls <> pivot")
    return found.select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct()


def _tile_pairs(postings: DataFrame, roots: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes that share a prefix element, may be alike by size and place, and are not connected yet."""
    rooted = stored(
        postings.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "rooted"
    )
    open_ = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token")
    rows = rooted.join(open_, "token")
    band = _band(F.col("n"), num, den)
    small = rows.filter(F.col("pos") < F.col("n") + 1 - F.ceil(F.lit(2 * num) * F.col("n") / F.lit(num + den) - 1e-9)).select(
        "token", F.explode(F.array(band, band + 1)).alias("band"), F.col("cls").alias("s"), F.col("n").alias("n_s"), F.col("pos").alias("pos_s"), F.col("root").alias("root_s")
    )
    large = rows.select("token", band.alias("band"), F.col("cls").alias("l"), F.col("n").alias("n_l"), F.col("pos").alias("pos_l"), F.col("root").alias("root_l"))
    fits = (
        (F.col("root_s") != F.col("root_l"))
        & ((F.col("n_s") < F.col("n_l")) | ((F.col("n_s") == F.col("n_l")) & (F.col("s") < F.col("l"))))
        & (F.col("n_s") * den >= F.col("n_l") * num)
        & ((num + den) * (1 + F.least(F.col("n_s") - F.col("pos_s"), F.col("n_l") - F.col("pos_l")) - 1) >= num * (F.col("n_s") + F.col("n_l")))
    )
    joined = small.join(large, ["token", "band"]).filter(fits)
    return joined.select(F.least("s", "l").alias("a"), F.greatest("s", "l").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(cls, root) of every linked class: least labels spread along links, then along the labels themselves."""
    edges = stored(links.select("a", "b").union(links.select("b", "a")), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("cls")).agg(F.least(F.col("cls"), F.min("b")).alias("root")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["cls"]).groupBy("a").agg(F.min("root").alias("near"))
        spread = labels.join(near, labels["cls"] == near["a"]).select("cls", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = labels.select(F.col("cls").alias("root"), F.col("root").alias("up"))
        jumped = stored(spread.join(up, "root").select("cls", "old", F.least("root", "up").alias("root")), "labels")
        if jumped.filter("old <> root").isEmpty():
            return labels
        labels = jumped.select("cls", "root")


def similar_groups(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id: the least id reachable over pairs with Jaccard >= num / den."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counters = 1 << min(24, max(14, (8 * docs.select("doc_id").count()).bit_length()))
    sets = stored(_set_pass(docs, words, counters), "shingle-sets")
    levels = _frequency_levels(sets.filter(F.col("part").isNotNull()).select("part", "counts"), counters)
    rows = sets.filter(F.col("part").isNull()).select("doc_id", "n", "cls", "sig")
    # A repeated id is one node, so its classes are linked whatever their texts.
    named = rows.filter(F.col("doc_id").isNotNull() & F.col("cls").isNotNull())
    classes = stored(named.groupBy("cls", "n").agg(F.min("doc_id").alias("least"), F.first("sig").alias("sig")), "classes")
    again = named.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).filter("a < b").select("doc_id", "a")
    same_id = named.join(again, "doc_id").filter("a < cls").select("a", F.col("cls").alias("b")).distinct()

    every = stored(_prefix_pass(docs.filter(F.col("doc_id").isNotNull()), words, levels, num, den), "prefixes")
    shared = every.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low < high").select("token")
    postings = stored(every.join(shared, "token").distinct(), "postings")

    stars = _verified(_pivot_pairs(postings, num, den), classes, docs, words, num, den).union(same_id)
    roots = components(stars)
    rest = _verified(_tile_pairs(postings, roots, num, den), classes, docs, words, num, den)
    final = components(stars.union(rest)) if not rest.isEmpty() else roots

    grouped = classes.join(final, "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = stored(grouped.join(least, "root").select("cls", "component_id"), "class-components")
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    return rows.join(of_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", alone)).alias("component_id")
    )
