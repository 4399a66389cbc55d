import math
import random

import pytest

from kerbside.operators import geo
from kerbside.operators import roads as R
from kerbside.session import written


def graph(spark, rows):
    return spark.createDataFrame(rows, "src bigint, dst bigint, key int, length double, maxspeed array<string>")


def small(spark):
    """Two routes of equal hops, a parallel edge, a list limit, a zero edge and a long way round."""
    return graph(spark, [
        (1, 2, 0, 1000.0, ["60"]), (1, 2, 1, 1.0, ["60"]), (2, 4, 0, 1000.0, ["60"]),
        (1, 3, 0, 500.0, ["60", "30"]), (3, 4, 0, 500.0, ["60"]), (4, 5, 0, 0.0, None), (5, 4, 0, 0.0, None),
        (1, 6, 0, 10.0, None), (6, 7, 0, 10.0, None), (7, 4, 0, 10.0, None), (5, 1, 0, 400.0, None),
    ])


def paths(spark, mode):
    sources = spark.createDataFrame([(1,)], "node bigint")
    found = R.shortest_paths(sources, R.timed_edges(small(spark)), mode)
    return found, {r["node"]: r for r in found.collect()}


def test_fewest_hops_breaks_ties_by_minutes(spark):
    found, best = paths(spark, "hops")
    assert best[4]["hops"] == 2 and best[4]["pred"] == 3 and math.isclose(best[4]["minutes"], 1.5)
    assert best[1]["hops"] == 0 and best[5]["minutes"] == best[4]["minutes"]
    legs = spark.createDataFrame([(1, 5), (1, 1)], "a bigint, b bigint")
    walked = {r["b"]: r["path"] for r in R.leg_paths(legs, found).collect()}
    assert walked == {5: [1, 3, 4, 5], 1: [1]}


def test_shortest_length_takes_the_long_way_round(spark):
    _, best = paths(spark, "length")
    assert best[4]["cost"] == 30.0 and best[4]["hops"] == 3 and best[5]["pred"] == 4
    _, fast = paths(spark, "minutes")
    assert math.isclose(fast[4]["cost"], 30 / (40000 / 60))


def test_trip_path_drops_first_node_of_each_leg(spark):
    sources = spark.createDataFrame([(1,), (5,)], "node bigint")
    found = R.shortest_paths(sources, R.timed_edges(small(spark)), "hops")
    legs = spark.createDataFrame([(0, 1, 1, 5), (0, 2, 5, 1)], "trip int, seq int, a bigint, b bigint")
    assert R.trip_paths(legs, found, ["trip"]).first()["path"] == [3, 4, 5, 1]


def test_matrix_obeys_the_triangle_inequality(spark):
    rng = random.Random(10)
    rows = [(i, (i + s) % 20, 0, float(rng.randrange(1, 99)), None) for i in range(20) for s in (1, 3, 8)]
    places = spark.createDataFrame([(i,) for i in range(20)], "node bigint")
    out = R.travel_matrix(places, R.timed_edges(graph(spark, rows)), "minutes").collect()
    m = {(r["a"], r["b"]): r["minutes"] for r in out}
    assert len(m) == 400
    assert all(m[a, c] <= m[a, b] + m[b, c] + 1e-9 for a in range(20) for b in range(20) for c in range(20))


def test_slot_matrix_scales_every_pair(spark):
    matrix = spark.createDataFrame([(1, 2, 4.0)], "a int, b int, minutes double")
    slots = spark.createDataFrame([("x", 1.5), ("y", 1.0)], "slot string, modifier double")
    assert {r["slot"]: r["minutes"] for r in R.slot_matrix(matrix, slots).collect()} == {"x": 6.0, "y": 4.0}


def test_nearest_node_equals_brute_force_on_clustered_nodes(spark):
    rng = random.Random(11)
    nodes = [(i, 103.8 + rng.gauss(0, 1e-4), 1.3 + rng.gauss(0, 1e-4)) for i in range(400)]
    nodes += [(400 + i, rng.uniform(103, 105), rng.uniform(1, 2)) for i in range(40)]
    nodes += [(900, nodes[3][1], nodes[3][2])]  # same place, higher id
    points = [(i, rng.uniform(102, 106), rng.uniform(0, 3)) for i in range(80)]
    points += [(100 + i, 103.8 + rng.gauss(0, 1e-4), 1.3 + rng.gauss(0, 1e-4)) for i in range(40)]
    points += [(200, nodes[3][1], nodes[3][2])]

    def metres(x1, y1, x2, y2):
        h = math.sin(math.radians(y2 - y1) / 2) ** 2 + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * math.sin(
            math.radians(x2 - x1) / 2
        ) ** 2
        return 2 * geo.EARTH_METRES * math.asin(math.sqrt(h))

    out = geo.nearest_node(
        spark.createDataFrame(points, "point int, lon double, lat double"),
        spark.createDataFrame(nodes, "node int, lon double, lat double"),
    ).collect()
    got = {r["point"]: (r["node"], r["metres"]) for r in out}
    assert len(got) == len(points)
    for p, x, y in points:
        d, node = min((metres(x, y, nx, ny), n) for n, nx, ny in nodes)
        assert got[p][0] == node and abs(got[p][1] - d) < 1e-6


def test_nearest_node_over_three_levels_of_boxes_and_across_the_date_line(spark):
    rng = random.Random(5)
    nodes = [(i, rng.uniform(-180, 180), rng.uniform(-85, 85)) for i in range(3_000)]
    nodes += [(3_000 + i, 10.0 + rng.gauss(0, 1e-6), 20.0 + rng.gauss(0, 1e-6)) for i in range(3_000)]
    points = [(i, rng.choice((-179.9, 179.9, rng.uniform(-180, 180))), rng.uniform(-89, 89)) for i in range(60)]
    points += [(100 + i, 10.0 + rng.gauss(0, 1e-6), 20.0) for i in range(20)]

    def metres(x1, y1, x2, y2):
        x1, y1, x2, y2 = map(math.radians, (x1, y1, x2, y2))
        h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
        return 2 * geo.EARTH_METRES * math.asin(math.sqrt(h))

    out = geo.nearest_node(
        spark.createDataFrame(points, "point int, lon double, lat double"),
        spark.createDataFrame(nodes, "node int, lon double, lat double"),
    ).collect()
    got = {r["point"]: r["metres"] for r in out}
    assert len(got) == len(out) == len(points)
    for p, x, y in points:
        assert abs(got[p] - min(metres(x, y, nx, ny) for _, nx, ny in nodes)) < 1e-5


def test_nearest_node_without_coordinates_or_nodes(spark):
    places = "lon double, lat double"
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, None, 0.5), (3, float("nan"), 0.0)], f"point int, {places}")
    nodes = spark.createDataFrame([(7, None, 1.0), (8, 0.5, 0.5), (9, 0.5, 0.5)], f"node int, {places}")
    got = {r["point"]: (r["node"], r["metres"]) for r in geo.nearest_node(points, nodes).collect()}
    assert got == {1: (8, 0.0), 2: (None, None), 3: (None, None)}
    none = geo.nearest_node(points, nodes.filter("node = 7")).collect()
    assert {tuple(r) for r in none} == {(1, None, None), (2, None, None), (3, None, None)}


def test_centroid_of_ring_in_either_direction(spark):
    ring = [[100.0, 1.0], [104.0, 1.0], [104.0, 3.0], [100.0, 3.0], [100.0, 1.0]]
    rows = [(0, [[ring]]), (1, [[ring[::-1]]])]
    out = geo.with_centroid(spark.createDataFrame(rows, "i int, parts array<array<array<array<double>>>>")).collect()
    assert all(abs(r["lon"] - 102) < 1e-9 and abs(r["lat"] - 2) < 1e-9 for r in out)


def random_edges(seed, nodes=40, edges=70):
    rng = random.Random(seed)
    return [(rng.randrange(nodes), rng.randrange(nodes), 0, float(rng.choice([0, 0, 1, 5, 9, 40])), [str(rng.choice([20, 60]))]) for _ in range(edges)]


@pytest.mark.parametrize("mode", R.MODES)
def test_both_ends_meet_where_one_search_arrives(spark, mode):
    rows = random_edges(3) + [(100, 101, 0, 5.0, None)]
    edges = R.timed_edges(graph(spark, rows))
    chosen = spark.createDataFrame([(n,) for n in (0, 3, 7, 11, 19, 100, 101, 999, 3)], "node bigint")
    ends = {r["node"] for r in chosen.collect()}
    full = R.shortest_paths(chosen, edges, mode).collect()
    want = {(r["source"], r["node"]): (r["cost"], r["minutes"]) for r in full if r["node"] in ends}
    got = {(r["a"], r["b"]): (r["cost"], r["minutes"]) for r in R.costs_between(chosen, edges, mode).collect()}
    assert set(got) == set(want) and len(want) < len(ends) ** 2
    for pair, (cost, minutes) in want.items():
        assert math.isclose(got[pair][0], cost) and math.isclose(got[pair][1], minutes, abs_tol=1e-9), pair


@pytest.mark.parametrize("ends", [(0, 3), (0, 3, 7, 999)])
def test_search_for_targets_finds_the_same_paths_to_them(spark, ends):
    edges = R.timed_edges(graph(spark, random_edges(5, 30, 90)))
    chosen = spark.createDataFrame([(n,) for n in ends], "node bigint")
    row = lambda r: (r["source"], r["node"], r["hops"], r["minutes"], r["pred"])
    full = {row(r) for r in R.shortest_paths(chosen, edges).collect()}
    some = {row(r) for r in R.shortest_paths(chosen, edges, "hops", chosen).collect()}
    assert some <= full and {r for r in full if r[1] in ends} <= some


def test_long_legs_are_found_by_jumps(spark):
    rows = [(i, i + 1, 0, 1.0, None) for i in range(45)]
    found = R.shortest_paths(spark.createDataFrame([(0,), (20,)], "node bigint"), R.timed_edges(graph(spark, rows)))
    legs = spark.createDataFrame([(0, 45), (0, 31), (20, 20), (20, 21), (20, 5)], "a bigint, b bigint")
    walked = {(r["a"], r["b"]): r["path"] for r in R.leg_paths(legs, found).collect()}
    assert walked == {(0, 45): list(range(46)), (0, 31): list(range(32)), (20, 20): [20], (20, 21): [20, 21]}


def test_search_for_targets_walks_half_of_a_path_from_either_end(spark):
    rows = [(i, 3 * i + j, 0, 1.0, None) for i in range(1, 122) for j in (-1, 0, 1)]  # three roads out of a node, one into it
    edges = R.timed_edges(graph(spark, rows))
    source, target = (spark.createDataFrame([(n,)], "node bigint") for n in (1, 300))
    some = {r["node"]: r["pred"] for r in R.shortest_paths(source, edges, "hops", target).collect()}
    node, path = 300, [300]
    while some[node] is not None:
        node = some[node]
        path.insert(0, node)
    assert path == [1, 4, 11, 33, 100, 300] and len(some) < 60


def test_nearest_node_compares_only_nodes_within_the_limit(spark):
    rng = random.Random(12)
    nodes = [(i, rng.uniform(103, 104), rng.uniform(1, 2)) for i in range(300)]
    points = spark.createDataFrame([(i, rng.uniform(103, 104), rng.uniform(1, 2)) for i in range(20)], "point bigint, lon double, lat double")
    near = geo.nearest_node(points, spark.createDataFrame(nodes, "node bigint, lon double, lat double"))
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert any("nlat" in line and "limit" in line and "<=" in line for line in plan.splitlines() if "Join" in line or "Filter" in line)


def test_edges_are_not_shuffled_in_every_round(spark, monkeypatch):
    plans = []

    def kept(df, label="cut"):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, label)

    monkeypatch.setattr(R, "written", kept)
    line = spark.range(40).selectExpr("id AS src", "id + 1 AS dst", "CAST(id % 3 AS double) AS length", "1.0D AS minutes")
    ends = spark.createDataFrame([(0,), (40,)], "node bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {(r["a"], r["b"]): (r["cost"], r["minutes"]) for r in R.costs_between(ends, line, "length").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {(0, 0): (0.0, 0.0), (40, 40): (0.0, 0.0), (0, 40): (39.0, 40.0)}
    rounds = [plan for label, plan in plans if label == "between" and "Join" in plan]
    assert len(rounds) > 10 and not any("SortMergeJoin" in plan or "ShuffledHashJoin" in plan for plan in rounds)
