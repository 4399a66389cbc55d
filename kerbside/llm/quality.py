"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a document are its words hashed into ``BUCKETS`` (square roots of
counts, scaled to unit length), a fixed set of statistics of its characters,
words and lines, and its length as the table states it. The score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

so all pairs interact through rank-``RANK`` factors in time linear in the
features. Weights are fitted by Adam on at most ``TRAIN_ROWS`` labelled rows, a
documented bound: those with the smallest hash of their id.

Defined cases: a null text is empty and is scored by its statistics; a null
length is the text's own; a null id is never held out; labels that are null
are left out and the largest counts if an id has several; without rows of both
classes the score is the share of good labels (0.5 without labels); repeated
rows are scored each; other columns are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import stored, unused

BUCKETS = 1 << 13
RANK = 8
TRAIN_ROWS = 10_000
EPOCHS = 8
BATCH = 128
RATE = 0.02
DECAY = 1e-4
THRESHOLD = 0.7
MOST_CACHED = 250_000

STATISTICS = (
    "upper", "digit", "mark", "symbol", "space", "wide", "distinct", "repeated", "top_word", "word_length", "long_words",
    "short_words", "marked_words", "lines", "line_length", "same_lines", "words", "stated_length", "sentences", "bias",
)

# Classes of bytes: 0 lower-case letter, 1 upper-case, 2 digit, 3 sentence mark, 4 other ASCII mark, 5 white space, 6 beyond ASCII.
_CLASS = np.full(256, 4, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 6
_CLASS[[ord(c) for c in ".,;:'\"?()-"]] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 5
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _Hashed(dict):
    """Word to bucket, computed once per word while the cache is small."""

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % BUCKETS
        if len(self) >= MOST_CACHED:
            self.clear()
        self[word] = bucket
        return bucket


def features(text: str | None, stated: int | None, hashed: _Hashed) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (words first, then ``STATISTICS``) and their values."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.translate(_LOWER).split()
    n = len(words)
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=7) / max(1, len(data))
    buckets = np.fromiter(map(hashed.__getitem__, words), np.int32, n)
    counts = np.bincount(buckets, minlength=BUCKETS)
    index = np.flatnonzero(counts)
    values = np.sqrt(counts[index])
    values = values / max(1e-9, np.sqrt((values**2).sum()))
    sizes = np.fromiter(map(len, words), np.int32, n)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ends = data.count(b".") + data.count(b"?") + data.count(b"!")
    letters = kinds[0] + kinds[1] + kinds[6]
    last = np.fromiter((w[-1] for w in words), np.uint8, n)
    per_word = 1 / max(1, n)
    stats = np.array([
        kinds[1] / max(1e-9, letters), 5 * kinds[2], 5 * kinds[3], 5 * kinds[4], 2 * kinds[5], kinds[6],
        len(index) * per_word if n < BUCKETS else len(index) / BUCKETS,
        float((buckets[1:] == buckets[:-1]).sum()) * per_word if n else 0.0,
        float(counts.max()) * per_word, min(3.0, float(sizes.mean()) / 6 if n else 0.0),
        float((sizes > 14).sum()) * per_word, float((sizes < 3).sum()) * per_word,
        float((_CLASS[last] == 4).sum()) * per_word, np.log1p(len(lines)) / 5, min(3.0, n / max(1, len(lines)) / 60),
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(n) / 10,
        np.log1p(max(0, stated if stated is not None else len(text or ""))) / 10, min(3.0, 10 * ends * per_word), 1.0,
    ])
    return np.concatenate([index, BUCKETS + np.arange(len(STATISTICS))]).astype(np.int32), np.concatenate([values, stats]).astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, index: np.ndarray, values: np.ndarray) -> float:
        summed = values @ self.factors[index]
        squares = (values**2) @ (self.factors[index] ** 2)
        z = self.bias + float(values @ self.linear[index]) + 0.5 * float((summed**2 - squares).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, seed: int = 7) -> Machine:
    """Adam on the log loss; the gradient uses the same sum-of-squares form as the score."""
    size = BUCKETS + len(STATISTICS)
    rng = np.random.default_rng(seed)
    share = (good.sum() + 0.5) / (len(good) + 1) if len(good) else 0.5
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), np.zeros((size, RANK), np.float32))
    if not len(good) or good.min() == good.max():
        return machine
    machine.factors = rng.normal(0, 0.01, (size, RANK)).astype(np.float32)
    weights = np.zeros((size, RANK + 1), np.float32)
    weights[:, 1:] = machine.factors
    first, second, bias, step = np.zeros_like(weights), np.zeros_like(weights), machine.bias, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        rate = RATE * (1 - epoch / EPOCHS) + 0.002
        for at in range(0, len(rows), BATCH):
            chosen = order[at : at + BATCH]
            index = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])[:, None]
            starts = np.cumsum([0, *(len(rows[i][0]) for i in chosen[:-1])])
            owner = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            v = weights[index]
            xv = values * v
            sums = np.add.reduceat(xv, starts)
            z = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - np.add.reduceat((xv[:, 1:] ** 2).sum(1), starts))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good[chosen]) / len(chosen)
            each = error[owner][:, None] * values
            grad_each = np.concatenate([each, each * (sums[owner, 1:] - xv[:, 1:])], axis=1)
            grad = np.stack([np.bincount(index, grad_each[:, f], size) for f in range(RANK + 1)], axis=1).astype(np.float32) + DECAY * weights
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad**2
            weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
            bias -= rate * float(error.sum())
    return Machine(float(bias), weights[:, 0].copy(), weights[:, 1:].copy())


def held_out(id_col: str = "doc_id"):
    """Rows that labels must not be learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS) -> Machine:
    """Fit on the labelled documents that are not held out, at most ``most_rows`` of them, one row of each."""
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    # Bounded: most_rows ids with their label.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("n_chars").cast("long").alias("n_chars")).join(F.broadcast(chosen), "doc_id")
    # Repeated ids are one document, so the driver gets at most most_rows rows.
    sample = sample.groupBy("doc_id").agg(F.max(F.struct("text", "n_chars", "quality")).alias("r")).select("r.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashed()
        for batch in batches:
            found = [features(t, n, hashed) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())],
                ["quality", "index", "values"],
            )

    made = stored(sample.select("text", "n_chars", F.col("quality").cast("int").alias("quality")).mapInArrow(run, "quality int, index binary, values binary"), "quality-sample")
    rows, good = [], []
    for r in made.orderBy(F.xxhash64("index", "values"), "quality").toLocalIterator():
        rows.append((np.frombuffer(r["index"], np.int32), np.frombuffer(r["values"], np.float32)))
        good.append(r["quality"])
    return fit(rows, np.array(good, np.float64))


def scored(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """The columns to keep (all by default) plus ``score``. Row by row, no shuffle; the model has a fixed size."""
    others = [c for c in (docs.columns if keep is None else keep) if c != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashed()
        for batch in batches:
            scores = [machine.score(*features(t, n, hashed)) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(scores, pa.float64())], [*others, "score"])

    text, stated = unused("__text", docs), unused("__stated", docs)
    picked = docs.select(F.col("text").cast("string").alias(text), F.col("n_chars").cast("long").alias(stated), *(F.col(f"`{c}`") for c in others))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return picked.mapInArrow(run, f"{schema}, score double")
