"""Registered queries over the reading stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.scalars import slot_label
from kerbside.plans import tables as V
from kerbside.session import shared_dir
from kerbside.sources.messages import structured_readings
from kerbside.streaming import ingest as I

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

READINGS_SQL = """readings AS (
  SELECT *, json_extract_string(props, '$.k')::INT AS k,
    strftime(date_trunc('hour', ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS data_collected FROM events),
parsed AS (
  SELECT event_id AS "offset", data_collected,
    CASE WHEN k % 17 <> 0 THEN user_id::VARCHAR END AS "LinkID",
    CASE WHEN k % 17 <> 0 THEN 'Road ' || (user_id % 100)::VARCHAR END AS "RoadName",
    CASE WHEN k % 17 <> 0 THEN event_type END AS "RoadCategory",
    CASE WHEN k % 17 NOT IN (0, 1) THEN (k % 8 + 1)::INT END AS "SpeedBand",
    CASE WHEN k % 17 <> 0 THEN (k % 8 * 10)::VARCHAR END AS "MinimumSpeed",
    CASE WHEN k % 17 <> 0 THEN (k % 8 * 10 + 9)::VARCHAR END AS "MaximumSpeed"
  FROM readings)"""
FIELDS = ["LinkID", "RoadName", "RoadCategory", "SpeedBand", "MinimumSpeed", "MaximumSpeed"]
FIELD_LIST = ", ".join(f'"{f}"' for f in FIELDS)


def _visible(readings: DataFrame, *extra: str) -> DataFrame:
    return readings.select(*FIELDS, slot_label(F.col("data_collected")).alias("data_collected"), *extra)


def _first_sql(order: str) -> str:
    return f"""WITH {READINGS_SQL}, ranked AS (SELECT *, row_number() OVER (
        PARTITION BY "LinkID", data_collected ORDER BY {order}) AS rn FROM parsed WHERE "LinkID" IS NOT NULL)
      SELECT {FIELD_LIST}, data_collected, "offset" FROM ranked WHERE rn = 1"""


def structured(spark: SparkSession, sf: str) -> DataFrame:
    return _visible(structured_readings(V.readings(spark, sf)), "offset")


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Even offsets are already stored, odd ones arrive."""
    good, _ = I.split_rejects(structured_readings(V.readings(spark, sf)))
    stored = I.first_per_key(good.filter("offset % 2 = 0"), I.KEY, ["offset"])
    added = I.insert_if_absent(good.filter("offset % 2 = 1"), stored)
    return _visible(stored.unionByName(added), "offset")


def _stream_once(spark: SparkSession, sf: str, runs: int) -> DataFrame:
    """The events table as a file stream, ingested ``runs`` times into a fresh table."""
    base = f"{shared_dir(V.pin_utc(spark))}/ingest-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf}/events*.parquet")
    whole = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("LinkID"),
            F.concat(F.lit("Road "), (F.col("user_id") % 100).cast("string")).alias("RoadName"),
            F.col("event_type").alias("RoadCategory"),
            F.when(k % 17 != 1, k % 8 + 1).alias("SpeedBand"),
            (k % 8 * 10).cast("string").alias("MinimumSpeed"),
            (k % 8 * 10 + 9).cast("string").alias("MaximumSpeed"),
        )
    )
    raw = stream.select(
        F.when(k % 17 == 0, F.lit('{"LinkID":"cut')).otherwise(whole).alias("value"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_id").alias("offset"),
    )
    target = I.ReadingsTable(f"{base}/readings")
    for _ in range(runs):
        I.ingest(raw, target, f"{base}/progress")
    target.compact(spark)
    return target.read(spark)


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _visible(_stream_once(spark, sf, 1), "offset")


def stream_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A second run over the same input must add nothing."""
    stored = _stream_once(spark, sf, 2)
    return stored.groupBy(F.to_date("data_collected").cast("string").alias("day")).agg(
        F.count("*").alias("readings"), F.countDistinct("batch").alias("batches")
    )


QUERIES["s3_structured_readings"] = structured
ORACLE["s3_structured_readings"] = f'WITH {READINGS_SQL} SELECT {FIELD_LIST}, data_collected, "offset" FROM parsed'
QUERIES["s4_insert_if_absent"] = insert_if_absent
ORACLE["s4_insert_if_absent"] = _first_sql('"offset" % 2, "offset"')
QUERIES["l1_s1_stream_ingest"] = stream_ingest
ORACLE["l1_s1_stream_ingest"] = _first_sql('"offset"')
QUERIES["s6_run_to_exhaustion"] = stream_rerun
ORACLE["s6_run_to_exhaustion"] = (
    "SELECT data_collected[1:10] AS day, count(*) AS readings, 1::BIGINT AS batches FROM ("
    + _first_sql('"offset"')
    + ") GROUP BY 1"
)
