"""Text messages: response pages, snapshot logs and speed-band readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.scalars import local_time

# Field names and types of a speed-band message.
READING_SCHEMA = T.StructType(
    [
        T.StructField("LinkID", T.StringType()),
        T.StructField("RoadName", T.StringType()),
        T.StructField("RoadCategory", T.StringType()),
        T.StructField("SpeedBand", T.IntegerType()),
        T.StructField("MinimumSpeed", T.StringType()),
        T.StructField("MaximumSpeed", T.StringType()),
        T.StructField("StartLon", T.StringType()),
        T.StructField("StartLat", T.StringType()),
        T.StructField("EndLon", T.StringType()),
        T.StructField("EndLat", T.StringType()),
    ]
)
PAGE_SCHEMA = "struct<value:array<string>>"
SNAPSHOT_SCHEMA = "map<string,array<struct<EstTime:bigint>>>"
SERIES_SCHEMA = "map<string,bigint>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored API responses, one whole JSON document per file."""
    return spark.read.text(path, wholetext=True)


def page_messages(pages: DataFrame, body: str = "value") -> DataFrame:
    """One message per element of the response's ``value`` list, as its own JSON text.

    Elements stay text, so fields unknown to this code pass through.
    """
    kept = [F.col(c) for c in pages.columns if c != body]
    items = F.from_json(F.col(body), PAGE_SCHEMA)["value"]
    return pages.select(*kept, F.explode(items).alias("value"))


def write_messages(messages: DataFrame, path: str) -> None:
    """Landing folder of the ingest stream: one message per line."""
    messages.select("value").write.mode("append").text(path)


def structured_readings(raw: DataFrame, keep_raw: str | None = None) -> DataFrame:
    """Parse raw ``(value, timestamp, ...)`` messages into typed readings.

    With ``keep_raw`` the message text stays in a column of that name, so that
    a reject can be read.

    The message time, moved to local time, becomes ``data_collected``; text
    that is not JSON gives an all-NULL reading rather than an error.  Any other
    raw columns (such as the broker offset) are kept.
    """
    extra = [c for c in raw.columns if c not in ("value", "timestamp")]
    text = F.col("value").cast("string")
    kept = [text.alias(keep_raw)] if keep_raw else []
    parsed = raw.select(F.from_json(text, READING_SCHEMA).alias("data"), "timestamp", *extra, *kept)
    extra += [keep_raw] if keep_raw else []
    return parsed.select(
        "data.*", local_time(F.col("timestamp")).alias("data_collected"), *extra
    )


def snapshot_records(log: DataFrame, body: str = "value") -> DataFrame:
    """Rows ``(ts, EstTime)`` from log texts holding ``{time: [{EstTime}, ...]}``."""
    entries = log.select(F.explode(F.from_json(F.col(body), SNAPSHOT_SCHEMA)).alias("ts", "records"))
    return entries.select(F.to_timestamp("ts").alias("ts"), F.inline("records"))


def hourly_series(log: DataFrame, body: str = "value") -> DataFrame:
    """Rows ``(ts, total)`` from texts holding ``{time: total}``."""
    entries = log.select(F.explode(F.from_json(F.col(body), SERIES_SCHEMA)).alias("ts", "total"))
    return entries.select(F.to_timestamp("ts").alias("ts"), "total")


def _entries(spark: SparkSession, path: str, end: str, value: str, shape: str) -> DataFrame:
    """Entries of the JSON maps in the files, one row each as a map of its own.

    ``end`` closes an entry, and the text reader cuts files there, so one long
    file is read by many tasks and no row holds more than an entry. Text that
    is no entry stops the read instead of being dropped.
    """
    pieces = spark.read.option("lineSep", end).text(path)
    body = F.regexp_replace("value", r"^[\s,{}]+", "")
    found = pieces.select(body.alias("body")).filter("body <> ''")
    whole = F.concat(F.lit("{"), (F.col("body") if value else F.regexp_replace("body", r"[\s}]+$", "")), F.lit(value + "}"))
    fits = F.col("body").rlike(r'^"[^"]*"\s*:\s*' + shape)
    broken = F.raise_error(F.concat(F.lit(f"not an entry ended by {end}: "), F.substring("body", 1, 80)))
    return found.select(F.when(fits, whole).otherwise(broken).alias("value"))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot logs; an entry ends with its list, so texts in it must hold no bracket."""
    return snapshot_records(_entries(spark, path, "]", "]", r"\["))


def read_hourly_series(spark: SparkSession, path: str) -> DataFrame:
    return hourly_series(_entries(spark, path, ",", "", r"-?\d"))


def body_field(body: Column, field: str) -> Column:
    return F.get_json_object(body, f"$.{field}")
