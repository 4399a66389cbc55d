"""Hourly travel-time series: totals, sequences, forecasts and slot multipliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.running import numbered
from kerbside.functions.scalars import scaled, slot_label, traffic_multiplier, unscaled_all

STEPS = 24
# Planning hours lie strictly between these.
BEFORE_FIRST_HOUR, AFTER_LAST_HOUR = 9, 20


def snapshot_totals(records: DataFrame, value: str = "EstTime") -> DataFrame:
    """Total estimated time per snapshot."""
    return records.groupBy("ts").agg(F.sum(value).alias("total"))


def response_total(records: DataFrame, value: str = "EstTime") -> DataFrame:
    return records.agg(F.sum(value).alias("total"))


def in_time_order(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number the series by time from 0; days are the bounded pieces."""
    return numbered(series, ["ts"], F.to_date("ts"), by, "ordinal")


def skip_first(series: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Drop the first ``n`` snapshots of a series."""
    return in_time_order(series, by).filter(F.col("ordinal") >= n).drop("ordinal")


def sequences(series: DataFrame, value: str = "total", by: Sequence[str] = (), steps: int = STEPS) -> DataFrame:
    """Non-overlapping input and output windows ``(seq, inputs, outputs)``.

    Every reading is emitted once as an input of its block and once as an
    output of the block before, so both windows form in a single grouping and
    no table-wide window is needed.  Incomplete tails are dropped.
    """
    block = F.floor(F.col("ordinal") / steps)
    placed = in_time_order(series, by).select(
        *by,
        F.explode(
            F.array(
                F.struct(block.alias("seq"), F.lit(True).alias("is_input")),
                F.struct((block - 1).alias("seq"), F.lit(False).alias("is_input")),
            )
        ).alias("place"),
        F.struct("ordinal", F.col(value).alias("v")).alias("item"),
    )

    def window(is_input: bool):
        items = F.collect_list(F.when(F.col("place.is_input") == is_input, F.col("item")))
        return F.transform(F.sort_array(items), lambda i: i["v"])

    return (
        placed.groupBy(*by, F.col("place.seq").alias("seq"))
        .agg(window(True).alias("inputs"), window(False).alias("outputs"))
        .filter((F.size("inputs") == steps) & (F.size("outputs") == steps))
    )


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lowest and highest value per column as rows ``(col, lo, hi)``."""
    bounds = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(columns)],
    )
    return bounds.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("col"), F.col(f"lo_{i}").alias("lo"), F.col(f"hi_{i}").alias("hi"))
                    for i, c in enumerate(columns)
                ]
            )
        )
    )


def _all_bounds(scaler: DataFrame):
    """The whole scaler, one row per column, as a single scalar subquery."""
    return scaler.agg(F.map_from_entries(F.collect_list(F.struct("col", F.struct("lo", "hi"))))).scalar()


def scale_columns(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply a fitted scaler to the named columns."""
    bounds = F.col("_bounds")
    out = {c: scaled(F.col(c).cast("double"), bounds[c]["lo"], bounds[c]["hi"]) for c in columns}
    return df.withColumn("_bounds", _all_bounds(scaler)).withColumns(out).drop("_bounds")


def unscale_sequences(predictions: DataFrame, scaler: DataFrame, column: str = "total") -> DataFrame:
    """Undo the scaling of 24-wide predictions and flatten them to ``(seq, hour, value)``."""
    wide = predictions.select("seq", "prediction", _all_bounds(scaler).alias("bounds"))
    bounds = F.col("bounds")[column]
    values = unscaled_all(F.col("prediction"), bounds["lo"], bounds["hi"])
    return wide.select("seq", F.posexplode(values).alias("hour", "value"))


def same_as_yesterday(seqs: DataFrame) -> DataFrame:
    """Baseline forecast: tomorrow repeats today."""
    return seqs.withColumn("prediction", F.transform("inputs", lambda v: v.cast("double")))


def held_out(seqs: DataFrame, share: float = 0.2) -> DataFrame:
    """The last ``share`` of the sequences, split by time."""
    first = seqs.select(F.floor(F.count("*") * (1 - share)).alias("first")).scalar()
    return seqs.filter(F.col("seq") >= first)


def squared_error(predicted: DataFrame) -> DataFrame:
    """Mean squared error over all hours of all sequences."""
    errors = F.zip_with("prediction", "outputs", lambda p, y: (p - y) * (p - y))
    return predicted.select(F.explode(errors).alias("e")).agg(F.avg("e").alias("mse"))


def observed_then_predicted(series: DataFrame, predicted: DataFrame, steps: int = STEPS) -> DataFrame:
    """First observed day followed by the flattened predictions, truncated to int."""
    first_day = in_time_order(series).filter(F.col("ordinal") < steps)
    observed = first_day.select(F.col("ordinal").alias("position"), F.col("total").cast("double").alias("value"))
    later = predicted.select(
        ((F.col("seq") + 1) * steps + F.col("hour")).alias("position"), F.col("value")
    )
    return observed.unionByName(later).withColumn("value", F.col("value").cast("int"))


def planning_hours(hours: DataFrame, hour: str = "hour") -> DataFrame:
    """Hours of the first day in which trucks may leave."""
    return hours.filter((F.col(hour) > BEFORE_FIRST_HOUR) & (F.col(hour) < AFTER_LAST_HOUR))


def slot_multipliers(forecast: DataFrame, day: str) -> DataFrame:
    """Slots ``(slot, modifier)`` of one day from forecast rows ``(hour, value)``."""
    start = F.to_timestamp(F.lit(f"{day} 00:00:00"))
    return planning_hours(forecast).select(
        slot_label(start + F.make_interval(hours=F.col("hour"))).alias("slot"),
        traffic_multiplier(F.col("value")).alias("modifier"),
    )
