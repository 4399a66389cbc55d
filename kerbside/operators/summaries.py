"""Column summaries and classifier metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.quantiles import quantiles, quantiles_and, value_ranks
from kerbside.operators.traffic import fit_scaler

QUARTILES = [0.25, 0.5, 0.75]


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([], list(columns), "col", "value").filter("value IS NOT NULL")


def _quartiles(wide: DataFrame) -> DataFrame:
    return wide.groupBy("col").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"p{int(p * 100)}") for p in QUARTILES]
    )


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max, one row per column; two scans."""
    moments = [F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")]
    wide, rows = quantiles_and(_long(df, columns), "col", "value", QUARTILES, moments)
    found = [(r["col"], r["count"], r["mean"], r["std"], r["min"], r["max"]) for r in rows]
    table = df.sparkSession.createDataFrame(found, "col string, count bigint, mean double, std double, min double, max double")
    return table.join(_quartiles(wide), "col")


def histograms(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """Equal-width bins ``(col, bin, n)`` from 1; the top edge belongs to the last bin.

    A constant column is given a unit-wide range around its value.
    """
    bounds = fit_scaler(df, columns).select(
        "col",
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    # one row per column name, so always small
    placed = _long(df, columns).join(F.broadcast(bounds), "col")
    share = (F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))
    return (
        placed.withColumn("bin", F.least(F.floor(share) + 1, F.lit(bins)))
        .groupBy("col", "bin")
        .agg(F.count("*").alias("n"))
    )


def box_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5 IQR fences and the number of values outside them."""
    long = _long(df, columns)
    spread = 1.5 * (F.col("p75") - F.col("p25"))
    boxes = _quartiles(quantiles(long, "col", "value", QUARTILES)).withColumns(
        {"low_fence": F.col("p25") - spread, "high_fence": F.col("p75") + spread}
    )
    outside = (F.col("value") < F.col("low_fence")) | (F.col("value") > F.col("high_fence"))
    counts = (
        long.join(F.broadcast(boxes.select("col", "low_fence", "high_fence")), "col")
        .groupBy("col")
        .agg(F.count_if(outside).alias("outliers"))
    )
    return boxes.join(counts, "col")


def confusion(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predicted.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def classification_report(counts: DataFrame) -> DataFrame:
    """Per-class and averaged precision, recall, F1 and support from confusion counts."""
    right = F.col("label") == F.col("prediction")
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("claimed"),
                    F.when(right, F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("n").alias("claimed"),
                    F.lit(0).alias("hits"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits")
    )

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    scores = sums.withColumns(
        {
            "precision": ratio(F.col("hits"), F.col("claimed")),
            "recall": ratio(F.col("hits"), F.col("support")),
            "f1": ratio(2 * F.col("hits"), F.col("claimed") + F.col("support")),
        }
    )
    columns = ["precision", "recall", "f1"]
    per_class = scores.select(F.col("class").cast("string").alias("row"), *columns, "support")
    total = F.sum("support").alias("support")
    macro = scores.agg(*[F.avg(c).alias(c) for c in columns], total).withColumn("row", F.lit("macro avg"))
    weighted = scores.agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in columns], total
    ).withColumn("row", F.lit("weighted avg"))
    share = F.sum("hits") / F.sum("support")
    accuracy = scores.agg(*[share.alias(c) for c in columns], total).withColumn("row", F.lit("accuracy"))
    return per_class.unionByName(macro).unionByName(weighted).unionByName(accuracy)


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve from average ranks; tied scores share their rank."""
    rows = scored.select(
        F.lit("all").alias("by"), F.col(score).cast("double").alias("score"),
        F.col(label).cast("bigint").alias("positives"),
    )
    ranks = value_ranks(rows, "by", "score", "positives")
    twice_rank = 2 * F.col("before") + F.col("n") + 1
    sums = ranks.agg(
        F.sum((F.col("positives") * twice_rank).cast("decimal(38,0)")).alias("twice_ranks"),
        F.sum("positives").cast("double").alias("p"),
        F.sum("n").cast("double").alias("total"),
    )
    p, n = F.col("p"), F.col("total") - F.col("p")
    return sums.select(((F.col("twice_ranks").cast("double") - p * (p + 1)) / (2 * p * n)).alias("auc"))
