"""Registered queries over the road graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.scalars import speed_limit
from kerbside.operators import roads as R
from kerbside.operators.trips import closed_legs, trips_where
from kerbside.plans import tables as V

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _locations(spark: SparkSession, sf: str) -> DataFrame:
    both = R.stacked_locations(V.collection_places(spark, sf), V.depot_places(spark, sf))
    return V.on_road(both, spark, sf)


def speed_limits(spark: SparkSession, sf: str) -> DataFrame:
    edges = V.roads(spark, sf).filter("key = 0")
    return edges.select("src", "dst", speed_limit(F.col("maxspeed")).alias("kph"))


def minutes(spark: SparkSession, sf: str) -> DataFrame:
    timed = R.timed_edges(V.roads(spark, sf))
    return timed.select("src", "dst", "length", F.round("minutes", 6).alias("minutes"))


def locations(spark: SparkSession, sf: str) -> DataFrame:
    return _locations(spark, sf).select("loc", "name", "node", "kind")


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    out = R.travel_matrix(_locations(spark, sf), R.timed_edges(V.roads(spark, sf)), "hops")
    return out.withColumn("minutes", F.round("minutes", 6))


def length_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The same pairs by shortest road length."""
    return R.costs_between(_locations(spark, sf), R.timed_edges(V.roads(spark, sf)), "length").select("a", "b", F.col("cost").alias("length"))


def minutes_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The same pairs by least travel time."""
    out = R.travel_matrix(_locations(spark, sf), R.timed_edges(V.roads(spark, sf)), "minutes")
    return out.withColumn("minutes", F.round("minutes", 6))


def slot_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return R.slot_matrix(V.travel_minutes(spark, sf), V.slots(spark, sf), "percent")


def _paths_of(spark: SparkSession, sf: str, **view) -> DataFrame:
    nodes = _locations(spark, sf).select("loc", "node")
    paths = R.shortest_paths(nodes, R.timed_edges(V.roads(spark, sf)), "hops", nodes)
    legs = closed_legs(trips_where(V.stops(spark, sf), **view))
    start = F.broadcast(nodes.select(F.col("loc").alias("a"), F.col("node").alias("na")))  # 30 locations
    end = F.broadcast(nodes.select(F.col("loc").alias("b"), F.col("node").alias("nb")))
    on_nodes = legs.join(start, "a").join(end, "b").select(
        "cand", "truck", "slot", "seq", F.col("na").alias("a"), F.col("nb").alias("b")
    )
    out = R.trip_paths(on_nodes, paths, ["cand", "truck", "slot"])
    return out.withColumn("path", F.concat_ws(" ", F.col("path").cast("array<string>")))


def trip_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Node by node path of every trip of every candidate plan."""
    return _paths_of(spark, sf)


def truck_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The paths of one truck's trips."""
    return _paths_of(spark, sf, truck=2)


def slot_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The paths of the trips that leave in one slot."""
    return _paths_of(spark, sf, slot=12)


def depot_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The paths of the trips of one depot."""
    return _paths_of(spark, sf, depot=26)


REACH_SQL = f"""{V.ROADS_SQL},
reach AS (
  SELECT node AS source, node, 0 AS hops, 0.0::DOUBLE AS minutes, NULL::BIGINT AS pred FROM chosen
  UNION
  SELECT source, dst, min(h), min(m), arg_min(p, (m, p)) FROM (
    SELECT r.source, t.dst, r.hops + 1 AS h, r.minutes + t.minutes AS m, r.node AS p
    FROM reach r JOIN timed t ON t.src = r.node
    WHERE NOT EXISTS (SELECT 1 FROM recurring.reach k WHERE k.source = r.source AND k.node = t.dst)) GROUP BY 1, 2)"""


def _recursive(rest: str, ctes: str = REACH_SQL) -> str:
    before, body = ctes.split("reach AS (", 1)
    return f"WITH RECURSIVE {before} reach(source, node, hops, minutes, pred) USING KEY (source, node) AS ({body}{rest}"


LENGTH_SQL = f"""WITH RECURSIVE {V.ROADS_SQL},
reach(source, node, length) USING KEY (source, node) AS (
  SELECT node AS source, node, 0.0::DOUBLE AS length FROM chosen
  UNION
  SELECT source, dst, min(c) FROM (
    SELECT r.source, t.dst, r.length + t.length AS c FROM reach r JOIN roads t ON t.src = r.node
      LEFT JOIN recurring.reach k ON k.source = r.source AND k.node = t.dst
    WHERE k.length IS NULL OR r.length + t.length < k.length) GROUP BY 1, 2)
SELECT source AS a, reach.node AS b, length FROM reach SEMI JOIN chosen ON chosen.node = reach.node"""

MINUTES_SQL = LENGTH_SQL.replace("FROM reach r JOIN roads t", "FROM reach r JOIN timed t").replace(
    "r.length + t.length", "r.length + t.minutes").replace("reach.node AS b, length FROM", "reach.node AS b, round(length, 6) AS minutes FROM")

PATH_SQL = _recursive(
    f""",
{V.STOPS_SQL},
leg_parts AS (SELECT cand, truck, slot, pos AS seq,
    coalesce(lag(loc) OVER w, depot) AS a, loc AS b FROM stops WINDOW w AS (PARTITION BY cand, truck, slot ORDER BY pos)
  UNION ALL SELECT cand, truck, slot, max(pos) + 1, arg_max(loc, pos), any_value(depot) FROM stops GROUP BY 1, 2, 3),
pairs AS (SELECT DISTINCT x.node AS a, y.node AS b FROM leg_parts JOIN chosen x ON x.loc = a JOIN chosen y ON y.loc = b),
walk(a, b, node, path) AS (
  SELECT a, b, b, CASE WHEN a = b THEN '' ELSE b::VARCHAR END FROM pairs
  UNION ALL
  SELECT w.a, w.b, r.pred, CASE WHEN r.pred = w.a THEN w.path ELSE r.pred::VARCHAR || ' ' || w.path END
  FROM walk w JOIN reach r ON r.source = w.a AND r.node = w.node WHERE w.node <> w.a),
done AS (SELECT a, b, path FROM walk WHERE node = a)
SELECT cand, truck, slot, coalesce(string_agg(path, ' ' ORDER BY seq) FILTER (path <> ''), '') AS path
FROM leg_parts l JOIN chosen x ON x.loc = l.a JOIN chosen y ON y.loc = l.b
  JOIN done ON done.a = x.node AND done.b = y.node GROUP BY 1, 2, 3"""
)


def _view_sql(view: str) -> str:
    return PATH_SQL.replace("WINDOW w AS", f"WHERE {view} WINDOW w AS").replace("FROM stops GROUP BY", f"FROM stops WHERE {view} GROUP BY")


QUERIES |= {
    "f8_speed_limits": speed_limits,
    "f9_edge_minutes": minutes,
    "u1_stacked_locations": locations,
    "g1_travel_matrix": matrix,
    "g1_length_matrix": length_matrix,
    "g1_minutes_matrix": minutes_matrix,
    "j3_slot_matrix": slot_matrix,
    "g2_trip_paths": trip_paths,
    "g2_truck_paths": truck_paths,
    "g2_slot_paths": slot_paths,
    "g2_depot_paths": depot_paths,
}
ORACLE |= {
    "f8_speed_limits": f"WITH {V.ROADS_SQL} SELECT src, dst, kph::INT AS kph FROM roads",
    "f9_edge_minutes": f"WITH {V.ROADS_SQL} SELECT src, dst, length, round(minutes, 6)::DOUBLE AS minutes FROM timed",
    "u1_stacked_locations": """SELECT loc::INT AS loc, name, (loc * (SELECT count(*) FROM customer) // 30)::BIGINT AS node, kind
        FROM (SELECT n_nationkey AS loc, n_name AS name, 'collection' AS kind FROM nation
        UNION ALL SELECT 25 + r_regionkey, r_name, 'depot' FROM region)""",
    "g1_travel_matrix": _recursive(
        """ SELECT source AS a, reach.node AS b, round(minutes, 6)::DOUBLE AS minutes
        FROM reach SEMI JOIN chosen ON chosen.node = reach.node"""
    ),
    "g1_length_matrix": LENGTH_SQL,
    "g1_minutes_matrix": MINUTES_SQL,
    "j3_slot_matrix": f"""WITH {V.MATRIX_SQL}, {V.SLOTS_SQL}
        SELECT a, b, slot, (minutes * percent)::BIGINT AS minutes FROM matrix, slots""",
    "g2_trip_paths": PATH_SQL,
    "g2_truck_paths": _view_sql("truck = 2"),
    "g2_slot_paths": _view_sql("slot = 12"),
    "g2_depot_paths": _view_sql("depot = 26"),
}
