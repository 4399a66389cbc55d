"""Exact ranks and quantiles of many columns without a table-wide sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.running import running_total
from kerbside.session import written

ACCURACY = 10_000  # of the sketch: ranks are off by at most a ten-thousandth of the rows


def _ranked(counted: DataFrame, by: list[str], value: str) -> DataFrame:
    """Add ``before``: the rows of smaller values in the group, where ``n`` counts a value's rows.

    Values are dealt by range, so a crowded group or part of the range takes
    several tasks; the sums of the ranges ahead are added to those inside one.
    """
    wide = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = written(counted.repartitionByRange(wide, *by, value).withColumn("_range", F.spark_partition_id()), "ranges")
    return running_total(laid, F.col("n"), [value], F.col("_range"), by, "before").drop("_range")


def value_ranks(long: DataFrame, by: str, value: str, *sums: str) -> DataFrame:
    """Distinct values with their count ``n`` and the count of smaller values ``before``.

    Equal values are merged before any ordering, so a repeated value never
    lands in one task.  Columns named in ``sums`` are added up per value.
    """
    counted = (
        long.filter(F.col(value).isNotNull())
        .groupBy(by, value)
        .agg(F.count("*").alias("n"), *[F.sum(s).alias(s) for s in sums])
    )
    return _ranked(counted, [by], value)


def _intervals(edges: list[float], count: int) -> list[tuple[float, float]]:
    """The brackets of all quantiles as intervals without a common value."""
    found: list[tuple[float, float]] = []
    for low, high in sorted(zip(edges[:count], edges[count:], strict=True)):
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], max(high, found[-1][1]))
        else:
            found.append((low, high))
    return found


def _zone(value: Column, intervals: int) -> Column:
    """Twice the intervals passed; odd inside one."""
    steps = [(value >= F.col("_low")[i]).cast("int") + (value > F.col("_high")[i]).cast("int") for i in range(intervals)]
    return sum(steps[1:], steps[0])


def quantiles(long: DataFrame, by: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Interpolated quantiles ``(by, prob, quantile)``, equal to a full sort."""
    return quantiles_and(long, by, value, probs, [])[0]


def quantiles_and(long: DataFrame, by: str, value: str, probs: Sequence[float], sums: Sequence[Column]) -> tuple[DataFrame, list]:
    """Quantiles in two scans, and the rows ``(by, ..., sums)`` that the first scan gives besides.

    The first scan sketches a bracket around every quantile. The second counts
    the rows ahead of each bracket and keeps the values inside, a few
    ten-thousandths of all, which are ranked exactly. The counts tell whether
    a bracket holds its quantile; if one does not, all are drawn wider.
    """
    spark, number = long.sparkSession, F.col(value).cast("double")
    long = long.filter(F.col(value).isNotNull())
    margin, probs = 2 / ACCURACY, [float(p) for p in probs]
    while True:
        points = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
        # One row per group, which is a column name.
        first = long.groupBy(by).agg(F.count("*").alias("_total"), F.percentile_approx(number, points, ACCURACY).alias("_edges"), *sums).collect()
        kind = long.schema[by].dataType.simpleString()
        empty = spark.createDataFrame([], f"`{by}` {kind}, prob double, quantile double")
        if not first:
            return empty, first
        groups = {r[by]: _intervals(list(r["_edges"]), len(probs)) for r in first}
        most = max(map(len, groups.values()))
        pad = [float("inf")]
        edges = spark.createDataFrame(
            [(g, [a for a, _ in i] + pad * (most - len(i)), [b for _, b in i] + pad * (most - len(i))) for g, i in groups.items()],
            f"`{by}` {kind}, _low array<double>, _high array<double>",
        )
        zoned = long.select(by, number.alias(value)).join(F.broadcast(edges), by).withColumn("zone", _zone(F.col(value), most))
        counts = written(
            zoned.groupBy(by, "zone", F.when(F.col("zone") % 2 == 1, F.col(value)).alias(value)).agg(F.count("*").alias("n")), "zones"
        )
        sizes = {(r[by], r["zone"]): r["n"] for r in counts.groupBy(by, "zone").agg(F.sum("n").alias("n")).collect()}
        wanted, held = [], True
        for r in first:
            ahead = {z: sum(sizes.get((r[by], y), 0) for y in range(z)) for z in range(2 * most + 1)}
            for p in probs:
                place = p * (r["_total"] - 1)
                for rank in {int(place // 1), int(-(-place // 1))}:
                    zone = next((z for z in ahead if ahead[z] <= rank < ahead[z] + sizes.get((r[by], z), 0)), 0)
                    held &= zone % 2 == 1
                    wanted.append((r[by], zone, ahead[zone], p, place, rank))
        if held:
            break
        margin *= 8
    # At most two rows per group and quantile.
    sought = spark.createDataFrame(wanted, f"`{by}` {kind}, zone int, _ahead long, prob double, _place double, _rank long")
    ranks = _ranked(counts.filter("zone % 2 = 1"), [by, "zone"], value)
    low = F.col("before") + F.col("_ahead")
    hit = ranks.join(F.broadcast(sought), [by, "zone"]).filter((F.col("_rank") >= low) & (F.col("_rank") < low + F.col("n")))
    pair = hit.groupBy(by, "prob").agg(F.max("_place").alias("_place"), F.min_by(value, "_rank").alias("_a"), F.max_by(value, "_rank").alias("_b"))
    share = F.col("_place") - F.floor("_place")
    return pair.select(by, "prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * share).alias("quantile")), first
