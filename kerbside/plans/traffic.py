"""Registered queries over the hourly travel-time series."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import scalars as S
from kerbside.operators import traffic as T
from kerbside.plans import tables as V
from kerbside.session import shared_dir
from kerbside.sources import fitted
from kerbside.sources import messages as M

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
H = V.HOURLY_SQL
NUMBERED_SQL = f"{H}, ordered AS (SELECT *, row_number() OVER (ORDER BY ts) - 1 AS i FROM hourly)"
SEQ_SQL = f"""{NUMBERED_SQL},
 pairs AS (SELECT a.i // 24 AS seq, a.i % 24 AS hour, a.total AS x, b.total AS y
           FROM ordered a JOIN ordered b ON b.i = a.i + 24),
 full_seqs AS (SELECT seq FROM pairs GROUP BY seq HAVING count(*) = 24),
 seqs AS (SELECT pairs.* FROM pairs JOIN full_seqs USING (seq))"""


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query(
    "s2_page_messages",
    """SELECT event_id // 500 AS page, user_id::VARCHAR AS link_id,
              (json_extract_string(props, '$.k')::INT % 8 + 1)::INT AS speed_band
       FROM events""",
)
def page_messages(spark: SparkSession, sf: str) -> DataFrame:
    k = M.body_field(F.col("props"), "k").cast("int")
    rows = V.table(spark, sf, "events").select(
        F.floor(F.col("event_id") / V.PAGE).alias("page"),
        F.struct(F.col("user_id").cast("string").alias("LinkID"), (k % 8 + 1).alias("SpeedBand")).alias("r"),
    )
    pages = rows.groupBy("page").agg(F.to_json(F.struct(F.collect_list("r").alias("value"))).alias("value"))
    return M.page_messages(pages).select(
        "page",
        M.body_field(F.col("value"), "LinkID").alias("link_id"),
        M.body_field(F.col("value"), "SpeedBand").cast("int").alias("speed_band"),
    )


@query(
    "s9_snapshot_log",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ts,
              sum(round(value * 100)::BIGINT)::BIGINT AS total, count(*) AS records
       FROM events GROUP BY 1""",
)
def snapshot_log(spark: SparkSession, sf: str) -> DataFrame:
    records = M.snapshot_records(V.snapshot_log(spark, sf))
    out = records.groupBy("ts").agg(F.sum("EstTime").alias("total"), F.count("*").alias("records"))
    return out.withColumn("ts", S.slot_label(F.col("ts")))


@query(
    "s9_snapshot_files",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ts,
              sum(round(value * 100)::BIGINT)::BIGINT AS total, count(*) AS records
       FROM events GROUP BY 1""",
)
def snapshot_files(spark: SparkSession, sf: str) -> DataFrame:
    """The log written as text and read again, cut between its entries."""
    path = f"{shared_dir(spark)}/log-{uuid.uuid4().hex}"
    V.snapshot_log(spark, sf).write.text(path)
    records = M.read_snapshots(spark, path)
    out = records.groupBy("ts").agg(F.sum("EstTime").alias("total"), F.count("*").alias("records"))
    return out.withColumn("ts", S.slot_label(F.col("ts")))


@query(
    "f16_body_fields",
    """SELECT event_id, json_extract_string(props, '$.k')::INT AS k,
              len(json_keys(props))::INT AS fields FROM events""",
)
def body_fields(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "events").select(
        "event_id",
        M.body_field(F.col("props"), "k").cast("int").alias("k"),
        F.size(F.json_object_keys("props")).alias("fields"),
    )


@query(
    "a1_snapshot_totals",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ts,
              sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY 1""",
)
def snapshot_totals(spark: SparkSession, sf: str) -> DataFrame:
    return T.snapshot_totals(V.travel_times(spark, sf)).withColumn("ts", S.slot_label(F.col("ts")))


@query("a2_response_total", "SELECT sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events")
def response_total(spark: SparkSession, sf: str) -> DataFrame:
    return T.response_total(V.travel_times(spark, sf))


@query(
    "o4_series_in_time_order",
    f"WITH {NUMBERED_SQL} SELECT i::BIGINT AS ordinal, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, total FROM ordered ORDER BY i",
)
def series_in_time_order(spark: SparkSession, sf: str) -> DataFrame:
    ordered = T.in_time_order(V.hourly(spark, sf)).orderBy("ordinal")
    return ordered.select(
        F.col("ordinal").cast("bigint").alias("ordinal"), S.slot_label(F.col("ts")).alias("ts"), "total"
    )


@query(
    "p5_skip_first_snapshots",
    f"WITH {NUMBERED_SQL} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, total FROM ordered WHERE i >= 4",
)
def skip_first(spark: SparkSession, sf: str) -> DataFrame:
    return T.skip_first(V.hourly(spark, sf), 4).select(S.slot_label(F.col("ts")).alias("ts"), "total")


@query(
    "p6_planning_hours",
    f"WITH {NUMBERED_SQL} SELECT i::BIGINT AS hour, total FROM ordered WHERE i > 9 AND i < 20",
)
def planning_hours(spark: SparkSession, sf: str) -> DataFrame:
    ordered = T.in_time_order(V.hourly(spark, sf))
    return T.planning_hours(ordered.select(F.col("ordinal").cast("bigint").alias("hour"), "total"))


@query(
    "w1_sequences",
    f"""WITH {SEQ_SQL} SELECT seq::BIGINT AS seq, string_agg(x::VARCHAR, ',' ORDER BY hour) AS inputs,
        string_agg(y::VARCHAR, ',' ORDER BY hour) AS outputs FROM seqs GROUP BY seq""",
)
def sequences(spark: SparkSession, sf: str) -> DataFrame:
    seqs = T.sequences(V.hourly(spark, sf))
    return seqs.select(
        "seq",
        F.concat_ws(",", F.col("inputs").cast("array<string>")).alias("inputs"),
        F.concat_ws(",", F.col("outputs").cast("array<string>")).alias("outputs"),
    )


@query(
    "f5_traffic_bands",
    f"""WITH {H}, valued AS (
        SELECT ts, total, CASE WHEN total % 11 = 0 THEN NULL WHEN total % 11 = 1 THEN 'nan'::DOUBLE
          ELSE total::DOUBLE END AS v FROM hourly)
      SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, total,
        CASE WHEN v IS NULL OR isnan(v) THEN 1.0 WHEN v > 350 THEN 1.5 WHEN v > 325 THEN 1.25 WHEN v > 300 THEN 1.1
          WHEN v > 275 THEN 1.05 ELSE 1.0 END::DOUBLE AS modifier FROM valued""",
)
def traffic_bands(spark: SparkSession, sf: str) -> DataFrame:
    total = F.col("total")
    value = F.when(total % 11 == 1, F.lit(float("nan"))).when(total % 11 != 0, total.cast("double"))
    return V.hourly(spark, sf).select(
        S.slot_label(F.col("ts")).alias("ts"), "total", S.traffic_multiplier(value).alias("modifier")
    )


@query(
    "f6_slot_labels",
    """SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS slot FROM events""",
)
def slot_labels(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "events").select(
        "event_id", S.slot_label(F.date_trunc("hour", "ts")).alias("slot")
    )


@query(
    "f10_local_time",
    """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local_ts FROM events""",
)
def local_time(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "events").select(
        "event_id", S.slot_label(S.local_time(F.col("ts"))).alias("local_ts")
    )


@query(
    "s14_scaler_bounds",
    f"WITH {H} SELECT 'total' AS col, min(total)::DOUBLE AS lo, max(total)::DOUBLE AS hi FROM hourly",
)
def scaler_bounds(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_dir(spark)}/scaler-{uuid.uuid4().hex}"
    fitted.save_scaler(T.fit_scaler(V.hourly(spark, sf), ["total"]), path)
    return fitted.load_scaler(spark, path)


@query(
    "a6_scaler_fit",
    """SELECT 'l_quantity' AS col, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem
       UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice) FROM lineitem
       UNION ALL SELECT 'l_discount', min(l_discount), max(l_discount) FROM lineitem""",
)
def scaler_fit(spark: SparkSession, sf: str) -> DataFrame:
    return T.fit_scaler(V.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "f11_min_max_scaled",
    f"""WITH {H}, b AS (SELECT min(total)::DOUBLE AS lo, max(total)::DOUBLE AS hi FROM hourly)
      SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
        round(CASE WHEN hi = lo THEN 0 ELSE (total - lo) / (hi - lo) END, 6)::DOUBLE AS scaled,
        0.0::DOUBLE AS flat FROM hourly, b""",
)
def min_max_scaled(spark: SparkSession, sf: str) -> DataFrame:
    series = V.hourly(spark, sf).withColumn("flat", F.lit(7.0))
    scaler = T.fit_scaler(series, ["total", "flat"])
    out = T.scale_columns(series, scaler, ["total", "flat"])
    return out.select(S.slot_label(F.col("ts")).alias("ts"), F.round("total", 6).alias("scaled"), "flat")


def _scaled_forecast(spark: SparkSession, sf: str):
    """Repeat-yesterday forecast in scaled units, with the scaler."""
    series = V.hourly(spark, sf)
    scaler = T.fit_scaler(series, ["total"])
    seqs = T.sequences(T.scale_columns(series, scaler, ["total"]))
    return series, scaler, T.same_as_yesterday(seqs)


@query(
    "f12_unscaled_forecast",
    f"WITH {SEQ_SQL} SELECT seq::BIGINT AS seq, hour::INT AS hour, round(x, 4)::DOUBLE AS value FROM seqs",
)
def unscaled_forecast(spark: SparkSession, sf: str) -> DataFrame:
    _, scaler, forecast = _scaled_forecast(spark, sf)
    flat = T.unscale_sequences(forecast, scaler)
    return flat.withColumn("value", F.round("value", 4))


@query(
    "f13_truncated",
    "SELECT l_orderkey, l_linenumber, trunc(-l_extendedprice)::INT AS value FROM lineitem",
)
def truncated(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (-F.col("l_extendedprice")).cast("int").alias("value")
    )


@query(
    "u2_observed_then_predicted",
    f"""WITH {SEQ_SQL}
      SELECT i::BIGINT AS position, total::INT AS value FROM ordered WHERE i < 24
      UNION ALL SELECT ((seq + 1) * 24 + hour)::BIGINT, x::INT FROM seqs""",
)
def observed_then_predicted(spark: SparkSession, sf: str) -> DataFrame:
    series = V.hourly(spark, sf)
    flat = T.same_as_yesterday(T.sequences(series)).select("seq", F.posexplode("prediction").alias("hour", "value"))
    return T.observed_then_predicted(series, flat).orderBy("position")


@query(
    "m11_held_out_error",
    f"""WITH {SEQ_SQL}, n AS (SELECT count(DISTINCT seq) AS n FROM seqs)
      SELECT round(avg(((x - y) * (x - y))::DOUBLE), 4)::DOUBLE AS mse FROM seqs, n WHERE seq >= floor(n * 0.8)""",
)
def held_out_error(spark: SparkSession, sf: str) -> DataFrame:
    forecast = T.same_as_yesterday(T.sequences(V.hourly(spark, sf)))
    return T.squared_error(T.held_out(forecast)).select(F.round("mse", 4).alias("mse"))


@query(
    "m12_slot_multipliers",
    f"""WITH {SEQ_SQL}
      SELECT '2024-10-26 ' || hour::VARCHAR || ':00:00' AS slot,
        CASE WHEN x > 350 THEN 1.5 WHEN x > 325 THEN 1.25 WHEN x > 300 THEN 1.1 WHEN x > 275 THEN 1.05 ELSE 1.0
        END::DOUBLE AS modifier
      FROM seqs WHERE seq = 0 AND hour > 9 AND hour < 20""",
)
def slot_multipliers(spark: SparkSession, sf: str) -> DataFrame:
    forecast = T.same_as_yesterday(T.sequences(V.hourly(spark, sf)).filter("seq = 0"))
    hours = forecast.select(F.posexplode("prediction").alias("hour", "value"))
    return T.slot_multipliers(hours, "2024-10-26")
