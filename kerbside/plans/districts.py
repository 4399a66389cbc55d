"""Registered queries over districts, waste and nearest nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators import districts as D
from kerbside.operators import geo as G
from kerbside.plans import tables as V
from kerbside.sources.files import SHEET_KG

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

SHEET_SQL = """people AS (
  SELECT CASE WHEN n_nationkey = 7 THEN 'ELSEWHERE' ELSE n_name END AS area, n_name,
    CASE WHEN n_nationkey % 6 <> 0 THEN round(c_acctbal * 100)::BIGINT ELSE 0 END AS kg, c_custkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
totals AS (SELECT area, sum(kg)::DOUBLE AS kg FROM people GROUP BY area),
joined AS (SELECT c_custkey AS ordinal, n_name AS planning_area, totals.kg FROM people LEFT JOIN totals
  ON people.n_name = totals.area)"""


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    totals = D.area_totals(V.waste_sheet(spark, sf))
    return D.with_waste(V.districts(spark, sf), totals, V.AREAS)


def area_totals(spark: SparkSession, sf: str) -> DataFrame:
    return D.area_totals(V.waste_sheet(spark, sf)).toDF("area", "kg")


def with_waste(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf).withColumnRenamed(SHEET_KG, "kg")


def not_empty(spark: SparkSession, sf: str) -> DataFrame:
    return D.not_empty(_joined(spark, sf)).withColumnRenamed(SHEET_KG, "kg")


def excluding(spark: SparkSession, sf: str) -> DataFrame:
    return D.excluding(V.districts(spark, sf), ["NATION_3", "NATION_11"])


def _snapped(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ordinal"), (F.col("c_custkey") * 7 % 613).alias("node"),
        F.concat(F.lit("Area "), (F.col("c_custkey") % 211).cast("string")).alias("planning_area"),
        V.cents("c_acctbal").alias("kg"),
    )


def node_waste(spark: SparkSession, sf: str) -> DataFrame:
    return D.node_waste(_snapped(spark, sf))


def node_waste_sum(spark: SparkSession, sf: str) -> DataFrame:
    return D.node_waste(_snapped(spark, sf), "sum")


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    out = G.with_centroid(V.district_shapes(spark, sf))
    return out.select("ordinal", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


def nearest_nodes(spark: SparkSession, sf: str) -> DataFrame:
    near = G.nearest_node(V.points(spark, sf), V.junctions(spark, sf))
    return near.withColumn("metres", F.round("metres", 3))


def _coord(seed: str, key: str, start: float) -> str:
    return f"{start}::DOUBLE + (('0x' || substr(md5('{seed}|' || {key}::VARCHAR), 1, 8))::BIGINT % 400000) / 1e6::DOUBLE"


QUERIES |= {
    "p1_area_totals": area_totals,
    "j1_district_waste": with_waste,
    "p2_not_empty": not_empty,
    "p4_excluded_areas": excluding,
    "j8_node_waste": node_waste,
    "j8_node_waste_sum": node_waste_sum,
    "g3_centroids": centroids,
    "j4_nearest_nodes": nearest_nodes,
}
ORACLE |= {
    "p1_area_totals": f"WITH {SHEET_SQL} SELECT area, kg FROM totals",
    "j1_district_waste": f"WITH {SHEET_SQL} SELECT * FROM joined",
    "p2_not_empty": f"WITH {SHEET_SQL} SELECT * FROM joined WHERE kg IS DISTINCT FROM 0.0",
    "p4_excluded_areas": """SELECT c_custkey AS ordinal, n_name AS planning_area FROM customer
        JOIN nation ON c_nationkey = n_nationkey WHERE n_name NOT IN ('NATION_3', 'NATION_11')""",
    "j8_node_waste": """WITH s AS (SELECT c_custkey AS ordinal, c_custkey * 7 % 613 AS node,
          'Area ' || (c_custkey % 211)::VARCHAR AS planning_area, round(c_acctbal * 100)::BIGINT AS kg FROM customer),
        named AS (SELECT node, arg_max(planning_area, ordinal) AS planning_area FROM s GROUP BY node),
        firsts AS (SELECT planning_area, arg_min(kg, ordinal) AS kg FROM s GROUP BY planning_area)
        SELECT node, planning_area, kg FROM named JOIN firsts USING (planning_area)""",
    "j8_node_waste_sum": """WITH s AS (SELECT c_custkey AS ordinal, c_custkey * 7 % 613 AS node,
          'Area ' || (c_custkey % 211)::VARCHAR AS planning_area, round(c_acctbal * 100)::BIGINT AS kg FROM customer)
        SELECT node, arg_max(planning_area, ordinal) AS planning_area, sum(kg)::BIGINT AS kg FROM s GROUP BY node""",
    "g3_centroids": """WITH s AS (SELECT c_custkey AS k, (c_custkey % 50)::DOUBLE AS x, (c_custkey // 50)::DOUBLE AS y,
          (1 + c_nationkey % 3)::DOUBLE AS w FROM customer),
        m AS (
          SELECT k, w * w AS a, x + w / 2 AS cx, y + w / 2 AS cy FROM s
          UNION ALL SELECT k, -w * w / 4, x + w / 8 + w / 4, y + w / 8 + w / 4 FROM s WHERE k % 2 = 0
          UNION ALL SELECT k, 1, x + 10.5, y + 0.5 FROM s WHERE k % 3 = 0)
        SELECT k AS ordinal, round(sum(a * cx) / sum(a), 6)::DOUBLE AS lon, round(sum(a * cy) / sum(a), 6)::DOUBLE AS lat
        FROM m GROUP BY k""",
    "j4_nearest_nodes": f"""WITH p AS (SELECT c_custkey AS point, {_coord('px', 'c_custkey', 103.6)} AS lon,
          {_coord('py', 'c_custkey', 1.2)} AS lat FROM customer),
        n AS (SELECT p_partkey AS node, {_coord('nx', 'p_partkey', 103.6)} AS lon,
          {_coord('ny', 'p_partkey', 1.2)} AS lat FROM part),
        d AS (SELECT point, node, 2 * 6371009 * asin(sqrt(pow(sin(radians(n.lat - p.lat) / 2), 2)
          + cos(radians(p.lat)) * cos(radians(n.lat)) * pow(sin(radians(n.lon - p.lon) / 2), 2))) AS m FROM p, n)
        SELECT point, arg_min(node, (m, node)) AS node, round(min(m), 3)::DOUBLE AS metres FROM d GROUP BY point""",
}
