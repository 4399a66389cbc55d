"""Polygon centroids and nearest-node search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.running import in_sequence, small_side, spread
from kerbside.session import written

EARTH_METRES = 6371009.0
BLOCK_BITS = 6
CURVE_BITS = 26


def _ring_moments(ring: Column) -> Column:
    """Signed area and first moments of one closed ring around its first point."""
    origin_x, origin_y = ring[0][0], ring[0][1]
    n = F.size(ring) - 1

    def side(p, q):
        px, py, qx, qy = p[0] - origin_x, p[1] - origin_y, q[0] - origin_x, q[1] - origin_y
        cross = px * qy - qx * py
        return F.struct(
            (cross / 2).alias("a"), ((px + qx) * cross / 6).alias("x"), ((py + qy) * cross / 6).alias("y")
        )

    sides = F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), side)
    return F.struct(origin_x.alias("ox"), origin_y.alias("oy"), _sum_moments(sides).alias("sum"))


def _placed_moments(m: Column, is_shell: Column) -> Column:
    """Moments back in the map's frame; holes count negative whatever their direction."""
    sign = F.when((m["sum"]["a"] < 0) == is_shell, -1.0).otherwise(1.0)
    return F.struct(
        (sign * m["sum"]["a"]).alias("a"),
        (sign * (m["sum"]["x"] + m["sum"]["a"] * m["ox"])).alias("x"),
        (sign * (m["sum"]["y"] + m["sum"]["a"] * m["oy"])).alias("y"),
    )


def _sum_moments(moments: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return F.aggregate(
        moments,
        zero,
        lambda t, m: F.struct(
            (t["a"] + m["a"]).alias("a"), (t["x"] + m["x"]).alias("x"), (t["y"] + m["y"]).alias("y")
        ),
    )


def with_centroid(shapes: DataFrame, parts: str = "parts") -> DataFrame:
    """Add ``lon`` and ``lat``, the area centroid over all parts minus their holes.

    Everything happens inside the row; no shuffle.
    """
    raw = F.transform(parts, lambda part: F.transform(part, _ring_moments))
    rings = F.flatten(
        F.transform(raw, lambda part: F.transform(part, lambda m, i: _placed_moments(m, i == 0)))
    )
    rows = shapes.withColumn("_total", _sum_moments(rings))
    return rows.withColumns(
        {"lon": F.col("_total.x") / F.col("_total.a"), "lat": F.col("_total.y") / F.col("_total.a")}
    ).drop("_total")


def _haversine(lat_a: Column, lat_b: Column, half_dlat: Column, half_dlon_sq: Column) -> Column:
    sin_lat = F.sin(half_dlat)
    return sin_lat * sin_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_dlon_sq


def metres(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Great-circle distance."""
    sin_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    h = _haversine(lat_a, lat_b, F.radians(lat_b - lat_a) / 2, sin_lon * sin_lon)
    return 2 * EARTH_METRES * F.asin(F.sqrt(h))


def _least(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Least haversine from the row's point to anywhere in a box."""
    lon, lat = F.col("lon"), F.col("lat")

    def gap(value, low, high):
        return F.greatest(low - value, value - high, F.lit(0.0))

    far_lon = F.greatest(F.abs(lon - west), F.abs(lon - east))
    sin_sq = lambda deg: F.pow(F.sin(F.radians(deg) / 2), 2)
    low_lon = F.least(sin_sq(gap(lon, west, east)), sin_sq(far_lon))
    steep = F.greatest(F.abs(south), F.abs(north))
    return _haversine(lat, steep, F.radians(gap(lat, south, north)) / 2, low_lon)


def _curve(west: float, south: float, width: float, height: float) -> Column:
    """Place on a Z-order curve over the box: the bits of both coordinates, taken in turn."""

    def apart(value: Column) -> Column:
        for step, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                           (2, 0x3333333333333333), (1, 0x5555555555555555)):
            value = value.bitwiseOR(F.shiftleft(value, step)).bitwiseAND(F.lit(mask))
        return value

    steps = float(2**CURVE_BITS - 1)
    x = F.floor((F.col("lon") - F.lit(west)) / F.lit(width) * steps)
    y = F.floor((F.col("lat") - F.lit(south)) / F.lit(height) * steps)
    return apart(x).bitwiseOR(F.shiftleft(apart(y), 1))


def _boxes(rows: DataFrame) -> DataFrame:
    """One box around ``2**BLOCK_BITS`` successive ones: its sides and where one node in it is."""
    return rows.groupBy(F.shiftright("box", BLOCK_BITS).alias("box")).agg(
        F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"),
        F.min(F.struct("at.lon", "at.lat")).alias("at"),
    )


def _slack(limit: Column) -> Column:
    """The limit and what rounding may add to it."""
    return limit * (1 + 1e-9) + 1e-18


def _without_node(points: DataFrame, nodes: DataFrame) -> DataFrame:
    node = F.lit(None).cast(nodes.schema["node"].dataType)
    return points.select("point", node.alias("node"), F.lit(None).cast("double").alias("metres"))


def nearest_node(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """Closest node ``(point, node, metres)`` for every point; ties go to the lower id.

    Nodes are sorted along a space-filling curve once and numbered; every
    ``2**BLOCK_BITS`` of them make a block, as many blocks a box, and so on, so
    a crowded place only has smaller boxes.  Points descend from the top: of
    the boxes reached a point keeps those whose least distance is within that
    of the nearest node seen so far (each box names one of its nodes), and the
    result equals a full comparison.  The depth is the logarithm of the node
    count.  Nodes without finite coordinates are nobody's neighbours; a point
    without them, or any point when there are no nodes, has a NULL node.
    """
    finite = (F.abs("lon") < float("inf")) & (F.abs("lat") < float("inf"))
    nodes = nodes.filter(finite)
    sides = nodes.agg(
        F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north")
    ).first()
    if sides["west"] is None:
        return _without_node(points, nodes)
    width, height = max(sides["east"] - sides["west"], 1e-9), max(sides["north"] - sides["south"], 1e-9)
    placed = nodes.groupBy("lon", "lat").agg(F.min("node").alias("node"))
    placed = placed.withColumn("curve", _curve(sides["west"], sides["south"], width, height))
    placed = in_sequence(placed, ["curve", "node"], "place")
    held = placed.count()

    spots = placed.select(
        F.col("place").alias("box"), F.col("lon").alias("west"), F.col("lat").alias("south"),
        F.col("lon").alias("east"), F.col("lat").alias("north"), F.struct("lon", "lat").alias("at"),
    )
    levels = []  # (boxes, number of them), the blocks of nodes first
    count = held
    while count > 2**BLOCK_BITS:
        count = -(-count >> BLOCK_BITS)
        levels.append((_boxes(levels[-1][0]) if levels else written(_boxes(spots), "boxes"), count))

    frontier = spread(points.filter(finite), "point").select(
        "point", "lon", "lat", F.lit(0).cast("bigint").alias("above"), F.lit(float("inf")).alias("limit")
    )
    for boxes, count in reversed(levels):
        children = boxes.withColumn("above", F.shiftright("box", BLOCK_BITS))
        low = _least(F.col("west"), F.col("south"), F.col("east"), F.col("north"))
        sin_lon = F.sin(F.radians(F.col("at.lon") - F.col("lon")) / 2)
        seen = _haversine(F.col("lat"), F.col("at.lat"), F.radians(F.col("at.lat") - F.col("lat")) / 2, sin_lon * sin_lon)
        reached = frontier.join(small_side(children, count), "above").select(
            "point", "lon", "lat", F.struct(low.alias("low"), F.col("box").alias("above")).alias("kept"),
            F.least(seen, F.col("limit")).alias("limit"),
        ).filter(F.col("kept.low") <= _slack(F.col("limit")))
        # a point meets at most 2**BLOCK_BITS children of each box it kept, so its list stays short
        near = reached.groupBy("point", "lon", "lat").agg(F.min("limit").alias("limit"), F.collect_list("kept").alias("kept"))
        frontier = near.select(
            "point", "lon", "lat", "limit", F.inline(F.filter("kept", lambda c: c["low"] <= _slack(F.col("limit"))))
        ).drop("low")
    members = placed.select(
        F.shiftright("place", BLOCK_BITS).alias("above"), "node", F.col("lon").alias("nlon"), F.col("lat").alias("nlat")
    )
    pairs = frontier.join(small_side(members, held), "above")
    # Only nodes within the limit go on: a point's list stays short, and nothing but it is sorted or spilled.
    sin_lon = F.sin(F.radians(F.col("nlon") - F.col("lon")) / 2)
    pairs = pairs.filter(_haversine(F.col("lat"), F.col("nlat"), F.radians(F.col("nlat") - F.col("lat")) / 2, sin_lon * sin_lon) <= _slack(F.col("limit")))
    distance = metres(F.col("lon"), F.col("lat"), F.col("nlon"), F.col("nlat"))
    best = F.min(F.struct(distance.alias("metres"), F.col("node").alias("node"))).alias("best")
    found = pairs.groupBy("point").agg(best).select("point", "best.node", "best.metres")
    return found.unionByName(_without_node(points.filter(~F.coalesce(finite, F.lit(False))), nodes))
