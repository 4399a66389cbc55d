"""Shortest paths over the road graph as repeated joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbside.functions.running import small_side, spread
from kerbside.functions.scalars import edge_minutes, speed_limit
from kerbside.session import written

# What a path is chosen by; minutes are always summed along the chosen path.
MODES = ("hops", "length", "minutes")
MERGE_EVERY = 8


def stacked_locations(collection: DataFrame, depots: DataFrame) -> DataFrame:
    """Collection locations and depots in one table, told apart by ``kind``."""
    return collection.withColumn("kind", F.lit("collection")).unionByName(
        depots.withColumn("kind", F.lit("depot"))
    )


def timed_edges(edges: DataFrame) -> DataFrame:
    """First edge of each parallel bundle, with its speed limit and minutes."""
    return edges.filter(F.col("key") == 0).withColumn("kph", speed_limit(F.col("maxspeed"))).select(
        "src", "dst", "length", "kph", edge_minutes(F.col("length"), F.col("kph")).alias("minutes")
    )


def shortest_paths(sources: DataFrame, edges: DataFrame, mode: str = "hops", targets: DataFrame | None = None) -> DataFrame:
    """Best path to every reachable node: ``(source, node, hops, cost, minutes, pred)``.

    With ``targets`` (column ``node``) a search by hops gives the nodes on the
    best paths to them, and whatever it passed on the way; others are missing.

    All sources advance together.  Each round joins only the rows improved by
    the round before with the edges, combines them per (source, node) before
    the shuffle, and is written to the shared folder.  Ties go to fewer
    minutes, then fewer edges, then the lower predecessor, so results do not
    depend on partitioning.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if targets is not None and mode == "hops":
        return _paths_to(sources, targets, edges)
    weight = F.lit(1.0) if mode == "hops" else F.col(mode)
    steps = edges.select(
        F.col("src").alias("at"), F.col("dst").alias("node"), weight.alias("weight"), "minutes"
    ).persist()
    key = ["source", "node"]
    start = sources.select(F.col("node").alias("source"), "node").distinct().withColumn(
        "best",
        F.struct(
            F.lit(0.0).alias("cost"), F.lit(0.0).alias("minutes"), F.lit(0).alias("hops"),
            F.lit(None).cast("bigint").alias("pred"),
        ),
    )
    frontier = written(start, "paths")
    found = [frontier]
    while True:
        at = frontier.select("source", F.col("node").alias("at"), "best")
        tried = at.join(steps, "at").select(
            "source",
            "node",
            F.struct(
                (F.col("best.cost") + F.col("weight")).alias("cost"),
                (F.col("best.minutes") + F.col("minutes")).alias("minutes"),
                (F.col("best.hops") + 1).alias("hops"),
                F.col("at").alias("pred"),
            ).alias("best"),
        )
        known = reduce(DataFrame.unionByName, found)
        if mode == "hops":
            # with equal edge weights a node never improves after it was first reached
            better = tried.groupBy(*key).agg(F.min("best").alias("best")).join(known.select(*key), key, "left_anti")
        else:
            both = tried.withColumn("new", F.lit(True)).unionByName(known.withColumn("new", F.lit(False)))
            best = both.groupBy(*key).agg(
                F.min(F.when(F.col("new"), F.col("best"))).alias("best"),
                F.min(F.when(~F.col("new"), F.col("best"))).alias("old"),
            )
            better = best.filter("best < old OR (best IS NOT NULL AND old IS NULL)").drop("old")
        improved = Observation()
        frontier = written(better.observe(improved, F.count("*").alias("rows")), "paths")
        if improved.get["rows"] == 0:
            break
        found.append(frontier)
        if mode != "hops" and len(found) > MERGE_EVERY:
            found = [written(_best_of(found, key), "paths")]
    steps.unpersist()
    whole = reduce(DataFrame.unionByName, found) if mode == "hops" else _best_of(found, key)
    return whole.select(*key, "best.hops", "best.cost", "best.minutes", "best.pred")


def _stepped(at: DataFrame, steps: DataFrame, by: list[str]) -> DataFrame:
    """Paths by hops, one edge further."""
    return at.join(steps, by).select(
        *[c for c in at.columns if c not in ("at", "best")],
        "node",
        F.struct(
            (F.col("best.cost") + 1).alias("cost"), (F.col("best.minutes") + F.col("minutes")).alias("minutes"),
            (F.col("best.hops") + 1).alias("hops"), F.col("at").alias("pred"),
        ).alias("best"),
    )


def _paths_to(sources: DataFrame, targets: DataFrame, edges: DataFrame) -> DataFrame:
    """Best paths by hops from every source to every target, as ``shortest_paths`` gives them.

    Levels grow from both ends until a pair's meet, so only half of a path is
    searched from either; an end without a pair to find, or without a further
    node, stops.  From the nodes where a pair met, its paths go on forward,
    only along nodes that the search from the target has one edge nearer.  All
    paths of fewest hops run there, so ties end as in a search of everything.
    """
    steps, key = _both_ways(edges, F.lit(1.0)).drop("weight").persist(), ["back", "end", "node"]
    start = F.struct(F.lit(0.0).alias("cost"), F.lit(0.0).alias("minutes"), F.lit(0).alias("hops"), F.lit(None).cast("bigint").alias("pred"))
    a, b = sources.select(F.col("node").alias("a")).distinct(), targets.select(F.col("node").alias("b")).distinct()
    open_pairs = written(a.crossJoin(b).filter("a <> b"), "open")
    ends = a.select(F.lit(0).alias("back"), F.col("a").alias("end")).unionByName(b.select(F.lit(1).alias("back"), F.col("b").alias("end")))
    frontier = written(ends.select("back", "end", F.col("end").alias("node"), start.alias("best")), "paths")
    found, meetings, depth = [frontier], [], 0
    while not open_pairs.isEmpty():
        depth += 1
        searching = open_pairs.select(F.inline(F.array(
            F.struct(F.lit(0).alias("back"), F.col("a").alias("end")), F.struct(F.lit(1).alias("back"), F.col("b").alias("end"))
        ))).distinct()
        at = frontier.join(searching, ["back", "end"], "left_semi").withColumnRenamed("node", "at")
        new = _stepped(at, steps, ["back", "at"]).groupBy(*key).agg(F.min("best").alias("best"))
        before, frontier = frontier, written(new.join(reduce(DataFrame.unionByName, found).select(*key), key, "left_anti"), "paths")
        found.append(frontier)
        # Of a pair still open both ends have all nodes up to this depth, so its middle is among the last two levels.
        here = frontier.filter("back = 0").select(F.col("end").alias("a"), "node", "best")
        there = before.unionByName(frontier).filter("back = 1").select(F.col("end").alias("b"), "node", F.col("best.hops").alias("left"))
        met = here.join(there, "node").join(open_pairs, ["a", "b"], "left_semi")
        nearest = met.groupBy("a", "b").agg(F.min("left").alias("left"))
        meeting = written(met.join(nearest, ["a", "b", "left"]).select("a", "b", "node", "best", "left"), "meetings")
        meetings.append(meeting)
        going = [frontier.filter(F.col("back") == n).select(F.col("end").alias(c)).distinct() for n, c in enumerate(("a", "b"))]
        left = open_pairs.join(meeting.select("a", "b").distinct(), ["a", "b"], "left_anti")
        open_pairs = written(left.join(going[0], "a", "left_semi").join(going[1], "b", "left_semi").select("a", "b"), "open")
    known = reduce(DataFrame.unionByName, found)
    nearer = known.filter("back = 1").select(F.col("end").alias("b"), "node", F.col("best.hops").alias("left"))
    onward, along = steps.filter("back = 0").drop("back"), []
    level = reduce(DataFrame.unionByName, meetings) if meetings else None
    for _ in range(depth):
        ahead = level.filter("left > 0").withColumn("left", F.col("left") - 1).withColumnRenamed("node", "at")
        further = _stepped(ahead, onward, ["at"]).join(nearer, ["b", "node", "left"], "left_semi")
        level = written(further.groupBy("a", "b", "node", "left").agg(F.min("best").alias("best")), "paths")
        along.append(level.select(F.col("a").alias("source"), "node", "best"))
    steps.unpersist()
    whole = [known.filter("back = 0").select(F.col("end").alias("source"), "node", "best"), *along]
    return _best_of(whole, ["source", "node"]).select("source", "node", "best.hops", "best.cost", "best.minutes", "best.pred")


def _both_ways(edges: DataFrame, weight: Column) -> DataFrame:
    """Every edge ``(weight, minutes, back, at, node)`` twice, from its start and from its end."""
    ways = F.inline(F.array(
        F.struct(F.lit(0).alias("back"), F.col("src").alias("at"), F.col("dst").alias("node")), F.struct(F.lit(1).alias("back"), F.col("dst").alias("at"), F.col("src").alias("node"))
    ))
    return edges.select(weight.alias("weight"), "minutes", ways)


def _best_of(found: list[DataFrame], key: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, found).groupBy(*key).agg(F.min("best").alias("best"))


def costs_between(locations: DataFrame, edges: DataFrame, mode: str = "hops") -> DataFrame:
    """Best path between every two of the chosen nodes: ``(a, b, cost, minutes)``.

    Paths grow from both ends at once, and only half of each is walked: a node
    of a best path lies within half its cost of one of the ends, so a row goes
    on only while its cost is at most half of the worst pair still known for
    its end.  Each round advances the rows improved by the round before,
    combines them before the shuffle, and meets them with the rows of the other
    direction.  It ends when nothing within half a path improves.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    chosen = written(locations.select("node").distinct(), "chosen")
    places = chosen.count()
    weight = F.lit(1.0) if mode == "hops" else F.col(mode)
    # The edges lie by node from the start, so no round shuffles or sorts them; a round's few rows go to them whole.
    steps = spread(_both_ways(edges, weight), "back", "at").sortWithinPartitions("back", "at").persist()
    key, pair = ["back", "end", "node"], ["a", "b"]
    zero = F.struct(F.lit(0.0).alias("cost"), F.lit(0.0).alias("minutes"))
    ends = chosen.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("back"), F.col("node").alias("end"), "node", zero.alias("best"))
    frontier = written(ends, "between")
    rows = 2 * places
    found, pairs = [frontier], chosen.select(F.col("node").alias("a"), F.col("node").alias("b"), zero.alias("best"))
    while True:
        # The worst known pair of an end; none as long as a pair is unknown.
        side = [pairs.groupBy(F.lit(n).alias("back"), F.col(c).alias("end")).agg(F.max("best.cost").alias("worst"), F.count("*").alias("n")) for n, c in enumerate(pair)]
        limits = side[0].unionByName(side[1]).filter(F.col("n") == places).drop("n")
        going = frontier.join(small_side(limits, 2 * places), ["back", "end"], "left").filter("worst IS NULL OR 2 * best.cost <= worst")
        tried = steps.join(small_side(going.select("back", "end", F.col("node").alias("at"), "best"), rows), ["back", "at"]).select(
            *key, F.struct((F.col("best.cost") + F.col("weight")).alias("cost"), (F.col("best.minutes") + F.col("minutes")).alias("minutes")).alias("best")
        )
        known = reduce(DataFrame.unionByName, found)
        both = tried.withColumn("new", F.lit(True)).unionByName(known.withColumn("new", F.lit(False)))
        best = both.groupBy(*key).agg(F.min(F.when(F.col("new"), F.col("best"))).alias("best"), F.min(F.when(~F.col("new"), F.col("best"))).alias("old"))
        better = best.filter("best < old OR (best IS NOT NULL AND old IS NULL)").drop("old")
        improved = Observation()
        frontier = written(better.observe(improved, F.count("*").alias("rows")), "between")
        rows = improved.get["rows"]
        if rows == 0:
            break
        found.append(frontier)
        if len(found) > MERGE_EVERY:
            found = [written(_best_of(found, key), "between")]
        pairs = written(_met(pairs, frontier, reduce(DataFrame.unionByName, found)), "pairs")
    steps.unpersist()
    return pairs.select("a", "b", "best.cost", "best.minutes")


def _met(pairs: DataFrame, frontier: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs with what the improved rows and the rows of the other direction give on a common node."""
    here = frontier.select("back", "end", "node", F.col("best").alias("x"))
    there = known.select((1 - F.col("back")).alias("back"), F.col("end").alias("far"), "node", F.col("best").alias("y"))
    summed = F.struct((F.col("x.cost") + F.col("y.cost")).alias("cost"), (F.col("x.minutes") + F.col("y.minutes")).alias("minutes"))
    a, b = (F.when(F.col("back") == n, F.col("end")).otherwise(F.col("far")) for n in (0, 1))
    met = here.join(there, ["back", "node"]).select(a.alias("a"), b.alias("b"), summed.alias("best"))
    return pairs.unionByName(met).groupBy("a", "b").agg(F.min("best").alias("best"))


def travel_matrix(locations: DataFrame, edges: DataFrame, mode: str = "hops") -> DataFrame:
    """Minutes between chosen nodes, ``(a, b, minutes)``."""
    return costs_between(locations, edges, mode).select("a", "b", "minutes")


def slot_matrix(matrix: DataFrame, slots: DataFrame, factor: str = "modifier") -> DataFrame:
    """One scaled copy of the matrix per slot; a day has at most 24 slots."""
    day = slots.agg(F.sort_array(F.collect_list(F.struct("slot", factor)))).scalar()
    copies = matrix.withColumn("_slot", F.explode(day))
    return copies.select(
        "a", "b", F.col("_slot.slot").alias("slot"), (F.col("minutes") * F.col("_slot")[factor]).alias("minutes")
    )


def leg_paths(legs: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes along each distinct leg, ``(a, b, path)``, found from its end by pointer doubling.

    The table of predecessors gives that of ancestors 2, 4, 8, ... edges back.
    A place on the path is a sum of such jumps, so from the farthest jump to
    the nearest, every place known so far gives one more: log2 of the longest
    leg in joins, whatever its number of edges.
    """
    wanted = legs.select("a", "b").distinct()
    back = paths.select(F.col("source").alias("a"), "node", "hops", F.col("pred").alias("up"))
    back = back.join(wanted.select("a").distinct(), "a", "left_semi")
    jump = written(back, "jumps")
    at = written(wanted.join(jump.select("a", F.col("node").alias("b"), F.col("hops").alias("place")), ["a", "b"]).withColumn("node", F.col("b")), "legs")
    longest = at.agg(F.max("place")).first()[0] or 0
    jumps = [jump.filter("up IS NOT NULL")]
    while 2 ** len(jumps) <= longest:
        last, step = jumps[-1].select("a", "node", "hops", "up"), 2 ** len(jumps)
        ahead = last.select("a", F.col("node").alias("up"), F.col("up").alias("far"))
        # Only nodes that far from their start have such an ancestor.
        doubled = last.filter(F.col("hops") >= step).join(ahead, ["a", "up"]).select("a", "node", "hops", F.col("far").alias("up"))
        jumps.append(written(doubled, "jumps"))
    for k in reversed(range(len(jumps))):
        further = at.join(jumps[k].select("a", "node", "up"), ["a", "node"]).select("a", "b", (F.col("place") - 2**k).alias("place"), F.col("up").alias("node"))
        at = at.unionByName(further)
        if k % 2 == 0:
            at = written(at, "legs")
    nodes = F.sort_array(F.collect_list(F.struct("place", "node")))
    return at.groupBy("a", "b").agg(F.transform(nodes, lambda n: n["node"]).alias("path"))


def trip_paths(legs: DataFrame, paths: DataFrame, trip: list[str]) -> DataFrame:
    """Full node path of every trip, without the first node of each leg."""
    along = legs.join(leg_paths(legs, paths), ["a", "b"])
    parts = F.sort_array(F.collect_list(F.struct("seq", F.expr("slice(path, 2, size(path))").alias("part"))))
    return along.groupBy(*trip).agg(F.flatten(F.transform(parts, lambda p: p["part"])).alias("path"))
