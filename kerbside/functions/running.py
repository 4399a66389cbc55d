"""Ordered sums and range joins that never gather one key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.session import written

BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast ``df`` when the caller knows it holds at most ``rows`` rows.

    Without a bound, or beyond the limit, the join is left to Catalyst and
    adaptive execution, which fall back to a shuffled join.
    """
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` over all shuffle partitions before rows multiply.

    Short rows are moved instead of their expansion, and windows or groupings
    that include ``keys`` need no further shuffle.  The count is given so that
    adaptive execution does not merge partitions that are about to grow.
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(wanted, *keys)


def running_total(
    df: DataFrame,
    value: Column,
    order: Sequence[Column | str],
    bucket: Column,
    by: Sequence[str] = (),
    name: str = "before",
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows ahead of this one.

    ``bucket`` must rise with ``order`` and cut every ``by`` group into pieces
    of bounded size.  Piece totals are summed first (map-side), offsets run
    over the piece totals only, and the row-level window sees one piece, so a
    group holding most of the table is spread over many tasks.
    """
    by = list(by)
    rows = df.withColumn("_bucket", bucket).withColumn("_value", value)
    pieces = rows.groupBy(*by, "_bucket").agg(F.sum("_value").alias("_piece"))
    ahead = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = pieces.select(
        *by, "_bucket", F.coalesce(F.sum("_piece").over(ahead), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.join(offsets, [*by, "_bucket"])
        .withColumn(name, F.coalesce(F.sum("_value").over(inside), F.lit(0)) + F.col("_offset"))
        .drop("_bucket", "_value", "_offset")
    )


def numbered(
    df: DataFrame,
    order: Sequence[Column | str],
    bucket: Column,
    by: Sequence[str] = (),
    name: str = "ordinal",
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in ``order`` within each ``by`` group."""
    return running_total(df, F.lit(1), order, bucket, by, name)


def in_sequence(df: DataFrame, order: Sequence[Column | str], name: str = "ordinal") -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in ``order`` over the whole table, which is sorted and stored once.

    The sort is by range and is written with each row's place inside its
    range; the sizes of the ranges ahead, one row a range, are added on
    reading.  No task holds more than one range.
    """
    place = F.monotonically_increasing_id()  # range in the upper bits, place in the lower 33
    laid = written(df.orderBy(*order).withColumn("_place", place), "sequence")
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = laid.groupBy(part.alias("_part")).agg((F.max(inside) + 1).alias("_size"))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_ahead"))
    rows = laid.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return rows.select(*df.columns, (inside + F.col("_ahead")).alias(name))


def overlap_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], width: int
) -> DataFrame:
    """Join half-open integer ranges ``[lo, hi)`` that share at least one unit.

    Both sides carry ``lo`` and ``hi``; the result has the shared part as
    ``lo``/``hi``.  Ranges are cut at multiples of ``width`` so the join is an
    equi-join on the cell, and the pair is kept only in the cell where the
    shared part starts.  A cell holds at most ``width`` non-empty ranges of
    each side when the ranges of a side do not overlap one another.
    """

    def in_cells(df: DataFrame, tag: str) -> DataFrame:
        cut = df.filter("hi > lo").withColumn(
            "_cell",
            F.explode(
                F.sequence(
                    F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width)
                )
            ),
        )
        return cut.withColumnsRenamed({"lo": f"_{tag}_lo", "hi": f"_{tag}_hi"})

    pairs = in_cells(left, "l").join(in_cells(right, "r"), [*by, "_cell"])
    return (
        pairs.withColumn("lo", F.greatest("_l_lo", "_r_lo"))
        .withColumn("hi", F.least("_l_hi", "_r_hi"))
        .filter((F.col("lo") < F.col("hi")) & (F.floor(F.col("lo") / width) == F.col("_cell")))
        .drop("_cell", "_l_lo", "_l_hi", "_r_lo", "_r_hi")
    )
