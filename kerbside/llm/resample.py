"""Target-distribution importance resampling: documents drawn by how much their features look like a target's.

1. One pass counts hashed word features of all documents, another those of the
   target texts; a task sends one count per bucket at most.
2. The counts become an array of gains, one per bucket. A second pass scores
   each text by looking its buckets up in that array; a draw that depends only
   on the id is added (Gumbel noise, so the best scores are a weighted sample
   without replacement).
3. A quantile sketch proposes a bracket of scores around the cutoff. Exact
   counts above and inside it validate the bracket or widen it; only the rows
   in a valid bracket are sorted, and the row where the quota ends gives the
   cutoff score.
4. The drawn rows are numbered by a range-partitioned sort: place in the
   partition plus the sizes of the partitions ahead.

Hashing works on the bytes of whole texts: all words of a block of texts
advance their CRC-32 together, one byte a step, so a feature costs no Python
object. Blocks hold about ``BLOCK_BYTES``; a longer text is a block of its own.

Defined cases: a null or wordless text has no features and weight 0; rows with
fewer than ``least_words`` words are scored and never drawn; equal scores are
drawn by smaller id, a null id last (its draw is that of an empty id); repeated
rows are rows of their own, and if they meet the cutoff as many are drawn as
the quota has room for; without any target text all gains come from the
documents alone; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import numbered_in_order, stored

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = (25, 100)
BLOCK_BYTES = 4 << 20
STEPPED = 48  # bytes of a word that advance together; longer words are hashed one by one
SKETCH_ACCURACY = 10_000
FIRST_MARGIN = 0.002  # of all rows, on either side of the cutoff's place

_LOWER = np.frombuffer(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)), np.uint8)
#: Digits, a-z (letters are lowered first) and every byte of a non-ASCII character.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> np.uint32(1)) ^ np.uint32(0xEDB88320), values >> np.uint32(1))
    return values


_CRC = _crc_table()


def _stepped(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _advanced(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, by_size: np.ndarray) -> np.ndarray:
    """The CRC register of every word after its bytes, from the register given for it."""
    state = state[by_size]
    begin, size = starts[by_size], sizes[by_size]
    long = int(np.searchsorted(-size, -STEPPED))  # sizes fall, so these lead
    for at in range(int(size[long]) if long < len(size) else 0):
        end = int(np.searchsorted(-size, -at))  # words with more than ``at`` bytes
        state[long:end] = _stepped(state[long:end], data[begin[long:end] + at])
    for i in range(long):
        word = data[begin[i] : begin[i] + size[i]].tobytes()
        state[i] = np.uint32(zlib.crc32(word, int(state[i] ^ _ONES))) ^ _ONES
    out = np.empty_like(state)
    out[by_size] = state
    return out


def block_features(data: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and owning text of every one- and two-word feature of a block.

    Text i is ``data[bounds[i]:bounds[i + 1]]`` in UTF-8.
    """
    low = _LOWER[data]
    inside = _IN_WORD[low]
    before, after = np.zeros(len(low), bool), np.zeros(len(low), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(low))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.flatnonzero(inside & ~after) + 1 - starts
    owner = np.searchsorted(bounds, starts, "right") - 1
    by_size = np.argsort(-sizes, kind="stable")
    single = _advanced(np.full(len(starts), _ONES), low, starts, sizes, by_size)
    joined = np.full(len(starts), _ONES)
    joined[1:] = _stepped(single[:-1], np.uint32(32))
    double = _advanced(joined, low, starts, sizes, by_size)
    follows = np.zeros(len(starts), bool)
    follows[1:] = owner[1:] == owner[:-1]
    found = np.concatenate([single, double[follows]]) ^ _ONES
    return (found % np.uint32(buckets)).astype(np.int64), np.concatenate([owner, owner[follows]])


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of whole texts: first and last row, their bytes and bounds. A null text is empty."""
    plain = texts.cast(pa.large_binary())
    if plain.null_count:
        plain = plain.fill_null(b"")
    bounds = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(plain):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, "right")) - 1)
        yield at, end, data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


def _text(name: str = "text") -> Column:
    return F.col(name).cast("string").alias("text")


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket. The driver gets one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, bounds in _blocks(batch.column(0)):
                total += np.bincount(block_features(data, bounds, buckets)[0], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    summed = texts.select(_text()).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in summed.collect():
        counts[bucket] = n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log(((t + 1.0) * s_all) / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def noise(id_column: Column, seed: int = 7) -> Column:
    """Gumbel noise in thousandths from a digest of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def scored(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", seed: int = 7) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight`` and ``score`` of every row. No shuffle; the array has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, counts = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for at, end, data, bounds in _blocks(batch.column(1)):
                found, owner = block_features(data, bounds, len(gains))
                counts[at:end] = np.bincount(owner, minlength=end - at)
                # Whole numbers far below 2^53, so the double sums are exact.
                sums[at:end] = np.bincount(owner, gains[found], end - at).astype(np.int64)
            weight = sums // np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), pa.array(weight)], ["doc_id", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    made = docs.select(F.col(id_col).alias("doc_id"), _text()).mapInArrow(run, f"doc_id {kind}, n_features long, weight long")
    return made.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def cutoff_score(rows: DataFrame, quota: int, total: int) -> int:
    """The ``quota``-th highest score of ``total`` rows (1 <= quota <= total).

    The sketch may be off by any amount: the bracket is only used once exact
    counts show that the place sought lies in it.
    """
    margin, place = FIRST_MARGIN, 1 - quota / total
    while True:
        low_at, high_at = max(0.0, place - margin), min(1.0, place + margin)
        low, high = rows.agg(F.percentile_approx("score", [low_at, high_at], SKETCH_ACCURACY).alias("b")).first()["b"]
        # At the ends the bracket is open, so it always becomes valid.
        over = F.col("score") > high if high_at < 1.0 else F.lit(False)
        under = F.col("score") < low if low_at > 0.0 else F.lit(False)
        above, inside = rows.agg(F.count(F.when(over, 1)), F.count(F.when(~over & ~under, 1))).first()
        if above < quota <= above + inside:
            bracket = numbered_in_order(rows.filter(~over & ~under).select("score"), [F.desc("score")], "cutoff")
            return bracket.filter(F.col("ordinal") == quota - above).first()["score"]
        margin *= 4


def resampled(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, id_col: str = "doc_id", seed: int = 7,
) -> DataFrame:
    """Every row of ``docs`` with its score, and its place in the draw if it is drawn.

    ``share`` is the fraction of the rows with at least ``least_words`` words
    to draw, as numerator and denominator, rounded down.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = stored(scored(docs, gains, id_col, seed), "resample-scores")
    # w words have 2w - 1 features.
    fit = F.col("n_features") >= max(0, 2 * least_words - 1)
    total = rows.filter(fit).count()
    quota = share[0] * total // share[1]
    if not quota:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    reached = fit & (F.col("score") >= cutoff_score(rows.filter(fit), quota, total))
    drawn = numbered_in_order(rows.filter(reached), [F.desc("score"), F.asc_nulls_last("doc_id")], "drawn")
    rank = F.when(F.col("ordinal") <= quota, F.col("ordinal"))
    return rows.filter(~reached).withColumn("rank", F.lit(None).cast("long")).unionByName(
        drawn.withColumn("rank", rank).drop("ordinal")
    )
