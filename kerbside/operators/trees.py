"""Decision trees and forests grown level by level as table jobs.

Features are binned once. A level of all large nodes is one histogram: counts
per (tree, node, feature, bin), which combine before the shuffle; prefix sums
over the at most ``BINS`` bins of a node and feature give the Gini gain of each
cut. A node of few rows is finished where its rows meet. The result is a node
table, so scoring, importances and checks are joins and sums over it. A node is named by its path of 0 (below the threshold) and 1.

All trees of a forest grow side by side, and so do the folds of a search: they
are only further values of the ``tree`` column. Rows are weighted by a draw
from their id, so a bootstrap sample does not depend on partitioning. Missing
values (null, NaN) lie in a bin above all others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kerbside.functions.draws import draw
from kerbside.functions.quantiles import value_ranks
from kerbside.operators import subtrees
from kerbside.operators.subtrees import LEAST_GAIN
from kerbside.session import written

BINS = 256
MOST_DEPTH = 60
SMALL_LEVEL = 50_000  # nodes of a level, of about 100 bytes each, that are broadcast
LOCAL_ROWS = 131_072  # rows of a node whose subtree one task grows: some tens of MB
PIECE = 65_536  # nodes of a tree that rows walk through at once
BLOCK, PIECE_PARTS = 8_192, 16  # rows of a block; parts the pieces of all trees are dealt to
MANY = 1 << 62
HELD_CELLS = 1 << 27  # bins of a training table that a task holds whole, of one or two bytes each
HELD_NODES = 1 << 22  # nodes of packed trees that a task walks rows down, of some tens of bytes each
TASKS_PER_CORE = 3


def poisson_marks(most: int = 9) -> list[int]:
    """Where a 32-bit draw passes the cumulated chances of a Poisson count of mean 1."""
    total, marks = 0.0, []
    for k in range(most):
        total += math.exp(-1) / math.factorial(k)
        marks.append(int(total * 2**32))
    return marks


@dataclass(frozen=True)
class Growth:
    """How far a tree grows; ``tries`` features are drawn at every node (None: all).

    ``min_leaf`` may be a column of ``tree`` where trees grown together differ in it.
    """

    max_depth: int = MOST_DEPTH
    min_split: int = 2
    min_leaf: int | Column = 1
    tries: int | None = None


# Published settings of the forest and of the single tree.
FOREST_TREES, FOREST, TREE = 400, Growth(20, 10, 1, 4), Growth()


@dataclass(frozen=True)
class Bins:
    """Least value of every bin but the first, per feature."""

    features: tuple[str, ...]
    marks: tuple[tuple[float, ...], ...]

    def of(self, rows: DataFrame, name: str = "bins") -> DataFrame:
        """Add the array of bin numbers."""
        inner = [f"_f{i}" for i in range(len(self.features))]
        given = rows.withColumns({c: F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))) for c, f in zip(inner, self.features, strict=True)})
        cut = [i for i, m in enumerate(self.marks) if m]
        if cut:
            given = Bucketizer(
                inputCols=[inner[i] for i in cut], outputCols=[f"_b{i}" for i in cut], handleInvalid="keep",
                splitsArray=[[-float("inf"), *self.marks[i], float("inf")] for i in cut],
            ).transform(given)
        numbers = [F.col(f"_b{i}").cast("int") if self.marks[i] else F.isnan(inner[i]).cast("int") for i in range(len(inner))]
        return given.select(*[F.col(f"`{c}`") for c in rows.columns], F.array(*numbers).alias(name))


def fit_bins(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> Bins:
    """Cut every feature so that a value with ``before`` smaller ones is in bin floor(bins * before / n)."""
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(features)])
    long = rows.select(F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    ranks = value_ranks(long, "f", "value")
    sizes = long.groupBy("f").agg(F.count("*").alias("total"))
    # At most ``bins`` rows a feature.
    least = ranks.join(F.broadcast(sizes), "f").groupBy("f", F.floor(F.col("before") * bins / F.col("total")).alias("bin")).agg(F.min("value").alias("value"))
    found: dict[int, list[float]] = {i: [] for i in range(len(features))}
    for f, value in least.select("f", "value").collect():
        found[f].append(value)
    return Bins(tuple(features), tuple(tuple(sorted(found[i])[1:]) for i in range(len(features))))


def _tries(growth: Growth, width: int, tree: Column, node: Column) -> Column:
    """Features looked at in a node: those with the least draws."""
    every = F.array(*[F.lit(i) for i in range(width)])
    if growth.tries is None or growth.tries >= width:
        return every
    drawn = F.transform(every, lambda f: F.struct(draw("tries", tree, node, f).alias("d"), f.alias("f")))
    return F.transform(F.slice(F.array_sort(drawn), 1, growth.tries), lambda s: s.f)


def _level(rows: DataFrame, depth: int, growth: Growth) -> DataFrame:
    """One row per node of the level: counts and, where it is cut, feature, last lower bin and gain."""
    seen = rows.select("tree", "node", F.explode("tries").alias("f"), "bins", "n", "p").select("tree", "node", "f", F.col("bins")[F.col("f")].alias("bin"), "n", "p")
    cells = seen.groupBy("tree", "node", "f", "bin").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    # At most BINS + 1 cells per node and feature meet here.
    lines = cells.groupBy("tree", "node", "f").agg(F.array_sort(F.collect_list(F.struct("bin", "n", "p"))).alias("cells"), F.sum("n").alias("all_n"), F.sum("p").alias("all_p"))
    grown = F.aggregate(
        "cells", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("p"), F.lit(-1.0).alias("score"), F.lit(-1).alias("bin")),
        lambda a, c: _better(a, c, F.col("all_n"), F.col("all_p"), growth.min_leaf),
    )
    best = lines.select("tree", "node", "f", "all_n", "all_p", grown.alias("b"))
    gain = F.col("b.score") - _purity(F.col("all_n"), F.col("all_p"))
    cut = (F.col("b.bin") >= 0) & (gain > LEAST_GAIN) & (F.col("all_n") >= growth.min_split) & F.lit(depth < growth.max_depth)
    choice = F.struct(F.col("b.score").alias("score"), (-F.col("f")).alias("f"), F.col("b.bin").alias("bin"), gain.alias("gain"))
    nodes = best.groupBy("tree", "node").agg(F.max("all_n").alias("n"), F.max("all_p").alias("p"), F.max(F.when(cut, choice)).alias("c"))
    return nodes.select("tree", "node", F.lit(depth).alias("depth"), "n", "p", (-F.col("c.f")).alias("f"), F.col("c.bin").alias("bin"), F.col("c.gain").alias("gain"))


def _purity(n: Column, p: Column) -> Column:
    """Sum of the squared class counts over the count: higher is purer."""
    n, p = n.cast("double"), p.cast("double")
    return (p * p + (n - p) * (n - p)) / n


def _better(state: Column, cell: Column, all_n: Column, all_p: Column, least: int) -> Column:
    """Counts up to this bin, and the best cut so far; the first of equal ones stays."""
    n, p = state.n + cell.n, state.p + cell.p
    fits = (n >= least) & (all_n - n >= least) & (n < all_n)
    # The division by zero after the last bin is never looked at.
    score = _purity(n, p) + _purity(F.greatest(all_n - n, F.lit(1)), all_p - p)
    better = fits & (score > state.score)
    return F.struct(
        n.alias("n"), p.alias("p"), F.when(better, score).otherwise(state.score).alias("score"), F.when(better, cell.bin).otherwise(state.bin).alias("bin")
    )


def _beside(nodes: DataFrame) -> DataFrame:
    """Broadcast a level of nodes when it is small; else the join is left to Catalyst."""
    return F.broadcast(nodes) if nodes.count() <= SMALL_LEVEL else nodes


def _finished(rows: DataFrame, bins: Bins, growth: Growth) -> DataFrame:
    """The subtrees of nodes of at most ``LOCAL_ROWS`` rows, each grown from its rows alone."""
    kind = rows.schema["tree"].dataType
    run = subtrees.finisher(to_arrow_type(kind), len(bins.features), growth.max_depth, growth.min_split, growth.tries)
    least = growth.min_leaf if isinstance(growth.min_leaf, Column) else F.lit(growth.min_leaf)
    given = rows.select("tree", "node", "bins", "n", "p", least.cast("int").alias("least"))
    # Few bytes, much work: the number of parts is given, so adaptive execution merges none.
    wide = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return given.repartition(wide, "tree", "node").groupBy("tree", "node").applyInArrow(
        run, f"tree {kind.simpleString()}, node string, depth int, n long, p long, f int, bin int, gain double"
    )


def grow(rows: DataFrame, bins: Bins, growth: Growth, most: int | None = None) -> DataFrame:
    """Node table of every tree in ``rows(tree, bins, n, p)``.

    ``n`` is a row's weight and ``p`` its positive part. Gives tree, node,
    depth, n, p, feature, threshold (smaller values go to 0) and gain; the
    last three are null at a leaf. No tree has more than ``most`` rows, where given.

    A node of more than ``LOCAL_ROWS`` rows is cut by a histogram over all
    tasks. One of fewer is bounded: its rows meet once and its whole subtree
    is grown there, by the same draws, scores and ties.
    """
    width = len(bins.features)
    at = rows.select("tree", F.lit("").alias("node"), "bins", "n", "p")
    levels, depth = [], 0
    while True:
        small = not depth and most is not None and most <= LOCAL_ROWS
        if not small:
            sizes = at.groupBy("tree", "node").agg(F.count("*").alias("rows")).filter(F.col("rows") > LOCAL_ROWS)
            large = written(sizes.select("tree", "node"), "tree-large")
        if small or large.isEmpty():
            levels.append(written(_finished(at, bins, growth), "tree-level"))
            break
        if not depth:
            at = written(at, "tree-rows")
        large = _beside(large)
        levels.append(written(_finished(at.join(large, ["tree", "node"], "left_anti"), bins, growth), "tree-level"))
        at = at.join(large, ["tree", "node"], "left_semi")
        nodes = written(_level(at.withColumn("tries", _tries(growth, width, F.col("tree"), F.col("node"))), depth, growth), "tree-level")
        levels.append(nodes)
        cut = nodes.filter("f IS NOT NULL").select("tree", "node", "f", F.col("bin").alias("last"))
        if cut.isEmpty():
            break
        low = F.col("bins")[F.col("f")] <= F.col("last")
        moved = at.join(_beside(cut), ["tree", "node"])
        at = written(moved.select("tree", F.concat("node", F.when(low, "0").otherwise("1")).alias("node"), "bins", "n", "p"), "tree-rows")
        depth += 1
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return _named(found, bins)


def _named(found: DataFrame, bins: Bins) -> DataFrame:
    """Nodes with the name of their feature and the threshold of their cut."""
    names = F.array(*[F.lit(f) for f in bins.features])
    # A cut after the last bin with a mark separates the missing values.
    marks = F.array(*[F.array(*[F.lit(m) for m in [*ms, float("inf")]]) for ms in bins.marks])
    return found.select(
        "tree", "node", "depth", "n", "p", F.get(names, F.col("f")).alias("feature"), F.get(F.get(marks, F.col("f")), F.col("bin")).alias("threshold"), "gain"
    )


def grow_tree(train: DataFrame, features: Sequence[str], growth: Growth = TREE, label: str = "label", bins: int = BINS) -> DataFrame:
    """One tree over all rows."""
    cuts = fit_bins(train, features, bins)
    one = F.lit(1).cast("bigint")
    rows = cuts.of(train).select(F.lit(0).alias("tree"), "bins", one.alias("n"), F.col(label).cast("bigint").alias("p"))
    return grow(rows, cuts, growth)


def _times(trees: Column, number: Callable[[Column], Column], row_id: Column) -> Column:
    """How often a row is drawn by each tree that draws it, as structs ``(t, n)``; one digest a row and tree.

    Eight hexadecimal digits compare as the numbers they stand for.
    """
    digest = F.transform(trees, lambda t: F.struct(t.alias("t"), F.substring(F.md5(F.concat_ws("|", F.lit("bag"), number(t).cast("string"), row_id.cast("string"))), 1, 8).alias("h")))
    counted = F.transform(digest, lambda d: F.struct(d["t"].alias("t"), sum((d["h"] >= F.lit(f"{m:08x}")).cast("bigint") for m in poisson_marks()).alias("n")))
    return F.filter(counted, lambda c: c["n"] > 0)


def bagged(rows: DataFrame, trees: int, row_id: Column, label: str = "label") -> DataFrame:
    """Every row once for each tree that draws it, with how often it is drawn."""
    drawn = _times(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: t, row_id)
    spread = rows.select(*[F.col(f"`{c}`") for c in rows.columns], F.inline(drawn)).withColumnRenamed("t", "tree")
    return spread.withColumn("p", F.col("n") * F.col(label).cast("bigint"))


def grow_forest(
    train: DataFrame, features: Sequence[str], row_id: str, trees: int = FOREST_TREES, growth: Growth = FOREST, label: str = "label", bins: int = BINS,
    packed: bool = False,
) -> DataFrame:
    """``trees`` trees, each over a bootstrap sample by Poisson weights.

    A binned table of at most ``HELD_CELLS`` goes whole to every task, which
    draws and grows its share of the trees there. With ``packed`` such a
    forest comes as one row per tree, which ``score`` and ``importances`` take
    like a node table.
    """
    cuts, rows = fit_bins(train, features, bins), train.count()
    if 0 < rows * len(features) <= HELD_CELLS:
        found = _packed_forest(train, cuts, row_id, trees, growth, label)
        if packed:
            return found
        kind = "tree int, node string, depth int, n long, p long, f int, bin int, gain double"
        return _named(_few_at_once(found.select("tree", *subtrees.PACKED_TYPES).mapInArrow(subtrees.unpacked_nodes, kind)), cuts)
    given = cuts.of(train.select(*features, row_id, label))
    # Rows multiply by the number of trees, so they are spread first.
    wide = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return grow(bagged(given.repartition(wide, row_id), trees, F.col(row_id), label), cuts, growth, rows)


def _few_at_once(df: DataFrame, label: str = "tree-nodes") -> DataFrame:
    """Store what a function over blocks gives: they are long, so few of them make a batch."""
    conf = df.sparkSession.conf
    batch = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        return written(df, label)
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def _row_blocks(rows: DataFrame) -> DataFrame:
    """Training rows ``(text, bins, p, fold)`` as numbered blocks, stored."""
    wide = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = rows.repartition(wide, "text", "bins").mapInArrow(subtrees.blocks_of_rows, "data binary")
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "tree-blocks")


def _to_tasks(blocks: DataFrame, keys: list[tuple]) -> DataFrame:
    """Every block once for each task, with the key of the task."""
    every = F.array(*[F.array(*[F.lit(v) for v in key]) for key in keys])
    return blocks.select("block", "data", F.posexplode(every).alias("task", "key")).repartitionById(len(keys), "task")


def _tasks(spark: SparkSession) -> int:
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def _packed_forest(train: DataFrame, cuts: Bins, row_id: str, trees: int, growth: Growth, label: str) -> DataFrame:
    """The forest with one row per tree; a tree that draws no row has none."""
    given = cuts.of(train.select(*cuts.features, row_id, label))
    rows = given.select(F.col(row_id).cast("string").alias("text"), "bins", F.col(label).cast("bigint").alias("p"), F.lit(None).cast("int").alias("fold"))
    tasks = min(trees, _tasks(train.sparkSession))
    run = subtrees.forest_grower((growth.max_depth, growth.min_split, growth.tries), growth.min_leaf, poisson_marks())
    grown = _to_tasks(_row_blocks(rows), [(i, tasks, trees) for i in range(tasks)]).mapInArrow(run, subtrees.PACKED)
    names = F.array(*[F.lit(f) for f in cuts.features])
    marks = F.array(*[F.array(*[F.lit(float(m)) for m in ms]).cast("array<double>") for ms in cuts.marks])
    return _few_at_once(grown.withColumns({"features": names, "marks": marks}))


def _packed_sums(nodes: DataFrame, rows: DataFrame, row_id: str) -> DataFrame:
    """Sums and numbers of leaf shares ``(id, sums)`` of every row over all packed trees.

    Every task holds some trees and walks all blocks of rows down each; a
    block's sums then meet.
    """
    whole = nodes.agg(F.sum("nodes").alias("nodes"), F.count("*").alias("trees")).first()
    cut_by = nodes.select("features", "marks").first()
    missing = F.lit(float("nan"))
    values = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), missing) for f in cut_by["features"]])
    given = rows.select(F.col(f"`{row_id}`").alias("id"), values.alias("vals"))
    kind = given.schema["id"].dataType
    ids = f"ids array<{kind.simpleString()}>"
    wide = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = given.repartition(wide).mapInArrow(subtrees.blocks_of_values(cut_by["marks"]), f"{ids}, data binary")
    blocks = written(blocks.withColumn("block", F.monotonically_increasing_id()), "walk-blocks")
    tasks = min(whole["trees"], max(_tasks(rows.sparkSession), -(-whole["nodes"] // HELD_NODES)))
    parts = ["f", "bin", "n", "p", "told"]
    dealt = nodes.select((F.col("tree") % tasks).alias("task"), F.lit(None).cast("bigint").alias("block"), F.lit(None).cast(blocks.schema["ids"].dataType).alias("ids"), F.lit(None).cast("binary").alias("data"), *parts)
    none = [F.lit(None).cast("binary").alias(c) for c in parts]
    task = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task")
    every = blocks.select(task, "block", "ids", "data").withColumn("ids", F.when(F.col("task") == 0, F.col("ids"))).select("*", *none)
    met = dealt.unionByName(every).repartitionById(tasks, "task").sortWithinPartitions(F.col("block").asc_nulls_first())
    walk = subtrees.forest_walker(to_arrow_type(kind), len(cut_by["features"]))
    sums = _few_at_once(met.mapInArrow(walk, f"block long, {ids}, sums binary, told binary"), "walk")
    added = sums.groupBy("block").applyInArrow(subtrees.added_up(to_arrow_type(kind)), f"id {kind.simpleString()}, s0 double, s1 double")
    return added.groupBy("id").agg(F.array(F.sum("s0"), F.sum("s1")).alias("sums"))


def _pieces(nodes: DataFrame, base: int) -> tuple[DataFrame, int]:
    """Trees from depth ``base`` down in pieces ``(tree, node, piece)``, and the depth at which these end.

    A piece is what lies below one node down to a depth at which no piece has
    more than ``PIECE`` nodes; 16 levels never have. ``nodes`` has ``tree, node, depth, f, threshold, share, n``.
    """
    below = nodes.filter(F.col("depth") >= base).withColumn("top", F.substring("node", 1, base))
    sizes = below.groupBy("tree", "top", "depth").agg(F.count("*").alias("nodes"))
    so_far = F.sum("nodes").over(W.partitionBy("tree", "top").orderBy("depth"))  # one row per level
    over = sizes.withColumn("so_far", so_far).filter(F.col("so_far") > PIECE).agg(F.min("depth")).first()[0]
    end = min(MOST_DEPTH + base, over if over is not None else MOST_DEPTH + base)
    heap = F.conv(F.concat(F.lit("1"), F.expr(f"substring(node, {base + 1})")), 2, 10).cast("bigint")
    node = F.struct(heap.alias("heap"), F.coalesce("f", F.lit(-1)).alias("f"), "threshold", "share", F.col("n").cast("bigint").alias("n"))
    inside = below.filter(F.col("depth") < end)
    return inside.groupBy("tree", F.col("top").alias("node")).agg(F.array_sort(F.collect_list(node)).alias("piece")), end


def _walk(nodes: DataFrame, rows: DataFrame, ends: list[tuple[int, int]], counts: list[int], size: Column, t: Column, fold: Column | None = None) -> DataFrame:
    """Sums and numbers of leaf shares ``(id, size, sums)`` of every row over the trees of its fold, per end and count.

    ``rows`` has ``id, vals`` and ``fold`` where trees have one. Rows are
    packed in blocks; every block meets every piece of a tree, and a task adds
    up what a block gets. Rows that leave a piece below go on to the next.
    """
    spark = rows.sparkSession
    nodes = written(nodes, "tree-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0]
    kind, tree_kind = rows.schema["id"].dataType, nodes.schema["tree"].dataType
    keys = [] if fold is None else ["fold"]
    at = rows.select(*keys, "id", "vals", F.lit(1 << 62).cast("bigint").alias("above"))
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = written(at, "walk-rows")
    parts = max(1, min(most, -(-at.count() // BLOCK)))
    at = at.repartitionByRange(parts, *keys, "id").sortWithinPartitions(*keys) if keys else at.repartition(parts)
    base, found = 0, []
    schema = (f"id {kind.simpleString()}, size int, sums array<double>, tree {tree_kind.simpleString()}, t int, node string, "
              "vals array<double>, above long")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    while deepest is not None and base <= deepest:
        pieces, end = _pieces(nodes, base)
        pieces = pieces.withColumns({"size": size.cast("int"), "t": t.cast("int")})
        if fold is not None and not base:
            pieces = pieces.withColumn("fold", fold)
        on = ", ".join(f"{k} {at.schema[k].dataType.simpleString()}" for k in keys)
        blocks = at.mapInArrow(lambda b, k=list(keys): subtrees.packed(b, k), f"{on + ', ' if on else ''}ids array<{kind.simpleString()}>, vals binary, above binary")
        blocks = written(blocks, "walk-blocks").repartition(parts).withColumn("block", F.monotonically_increasing_id())
        pieces = written(pieces, "walk-pieces")
        if base:
            pairs = blocks.join(pieces, keys)
        else:
            met = blocks.hint("shuffle_replicate_nl")
            dealt = pieces.repartition(PIECE_PARTS)
            pairs = met.join(dealt, keys) if keys else met.crossJoin(dealt)
        run = subtrees.walker(to_arrow_type(kind), to_arrow_type(tree_kind), ends, counts, base)
        # A block and a piece are long, so few of them make a batch.
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
        try:
            met = written(pairs.select("block", "ids", "vals", "above", "tree", "size", "t", "node", "piece").mapInArrow(run, schema), "walk")
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        found.append(met.filter("sums IS NOT NULL").select("id", "size", "sums"))
        keys = ["tree", "node"]
        at = met.filter("sums IS NULL").select(*keys, "id", "vals", "above")
        at = at.repartitionByRange(most, *keys, "id").sortWithinPartitions(*keys)
        base, parts = end, most
    if not found:
        return spark.createDataFrame([], f"id {kind.simpleString()}, size int, sums array<double>")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    width = 2 * len(ends) * len(counts)
    summed = every.groupBy("id", "size").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    return summed.select("id", "size", F.array(*[f"s{i}" for i in range(width)]).alias("sums"))


def score(nodes: DataFrame, rows: DataFrame, row_id: str) -> DataFrame:
    """Add ``prob`` (mean over the trees of the positive share in the row's leaf) and ``prediction``.

    Trees come as a node table or packed.
    """
    if "marks" in nodes.columns and not nodes.isEmpty():
        return _scored(rows, row_id, _packed_sums(nodes, rows, row_id))
    if "marks" in nodes.columns:
        return rows.withColumn("prob", F.lit(None).cast("double")).withColumn("prediction", F.lit(None).cast("int"))
    nodes = written(nodes, "tree-nodes")
    features = sorted(r[0] for r in nodes.filter("feature IS NOT NULL").select("feature").distinct().collect())
    if nodes.isEmpty():
        return rows.withColumn("prob", F.lit(None).cast("double")).withColumn("prediction", F.lit(None).cast("int"))
    names = F.array(*[F.lit(f) for f in features]) if features else F.array().cast("array<string>")
    held = nodes.select(
        "tree", "node", "depth", (F.array_position(names, F.col("feature")) - 1).cast("int").alias("f"), "threshold",
        (F.col("p") / F.col("n")).alias("share"), "n",
    )
    # NaN is above every number here, so a missing value goes to 1.
    missing = F.lit(float("nan"))
    values = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), missing) for f in features]) if features else F.array(missing)
    given = rows.select(F.col(f"`{row_id}`").alias("id"), values.alias("vals"))
    return _scored(rows, row_id, _walk(held, given, [(MANY, 0)], [1], F.lit(0), F.lit(0)))


def _scored(rows: DataFrame, row_id: str, sums: DataFrame) -> DataFrame:
    share = F.when(F.col("sums")[1] > 0, F.col("sums")[0] / F.col("sums")[1])
    mean = sums.select(F.col("id").alias(row_id), F.round(share, 9).alias("prob"))
    return rows.join(mean, row_id).withColumn("prediction", (F.col("prob") > 0.5).cast("int"))


def importances(nodes: DataFrame) -> DataFrame:
    """Share of each feature in the gains of a tree, averaged over the trees that have cuts; they sum to 1.

    Trees come as a node table or packed.
    """
    if "marks" in nodes.columns:
        first = nodes.select("features").first()
        names = F.array(*[F.lit(f) for f in first["features"]]) if first else F.array().cast("array<string>")
        sums = _few_at_once(nodes.select("tree", "f", "gain").mapInArrow(subtrees.unpacked_gains, "tree int, f int, gain double"), "tree-gains")
        gains = sums.select("tree", F.get(names, F.col("f")).alias("feature"), "gain")
    else:
        gains = nodes.filter("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    totals = gains.groupBy("tree").agg(F.sum("gain").alias("total"))
    trees = totals.agg(F.count("*").alias("trees"))
    shares = gains.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    return shares.select("feature", (F.col("share") / trees.scalar()).alias("importance"))


# --- search over settings ---------------------------------------------------------------

_FOLD, _LEAF = 10_000, 1_000_000  # places of the fold and of the leaf size in a tree's number


def forest_grid(
    train: DataFrame, features: Sequence[str], row_id: str, grid: dict[str, list], fold: Column, folds: int = 5, tries: int = 4, label: str = "label"
) -> DataFrame:
    """Held-out accuracy of every point of trees x max_depth x min_split x min_leaf, with its rank.

    The cut of a node depends on its path, rows and leaf size alone. So a
    smaller forest is the first trees of a larger one, and a lower depth or a
    higher split size only ends a walk earlier: one growth per leaf size and
    fold, all in one table, serves the whole grid.
    """
    sizes, most = sorted(grid["min_leaf"]), max(grid["trees"])
    cuts = fit_bins(train, features)
    base = written(cuts.of(train.select(*features, row_id, label).withColumn("fold", fold)).select(row_id, label, "fold", "bins"), "grid-rows")
    ends = [(d, s) for d in grid["max_depth"] for s in grid["min_split"]]
    if 0 < base.count() * len(features) <= HELD_CELLS:
        growth = Growth(max(grid["max_depth"]), min(grid["min_split"]), 1, tries)
        return _grid_table(_grid_in_tasks(base, row_id, label, growth, sizes, ends, sorted(grid["trees"]), folds), grid, sizes, ends)
    wide = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = base.withColumnRenamed("fold", "own").repartition(wide, row_id).withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    spread = spread.filter("fold <> own")
    drawn = _times(F.sequence(F.lit(0), F.lit(most - 1)), lambda t: F.col("fold") * _FOLD + t, F.col(row_id))
    weighted = spread.select("fold", "bins", label, F.inline(drawn))
    number = F.col("fold") * _FOLD + F.col("t")
    of_size = F.explode(F.sequence(F.lit(0), F.lit(len(sizes) - 1)))
    rows = weighted.withColumn("size", of_size).select(
        (F.col("size") * _LEAF + number).alias("tree"), "bins", "n", (F.col("n") * F.col(label).cast("bigint")).alias("p")
    )
    least = F.get(F.array(*[F.lit(s) for s in sizes]), F.floor(F.col("tree") / _LEAF).cast("int"))
    nodes = written(grow(rows, cuts, Growth(max(grid["max_depth"]), min(grid["min_split"]), least, tries), base.count()), "grid-nodes")
    walked = _grid_walk(nodes, base, row_id, cuts, ends, sorted(grid["trees"]))
    right = (walked["share"] > 0.5).cast("int") == F.col(label)
    judged = walked.join(base.select(row_id, label, "fold"), row_id).groupBy("size", "ends", "count", "fold").agg(F.avg(right.cast("int")).alias("accuracy"))
    return _grid_table(judged, grid, sizes, ends)


def _grid_in_tasks(base: DataFrame, row_id: str, label: str, growth: Growth, sizes: list[int], ends: list[tuple[int, int]], counts: list[int], folds: int) -> DataFrame:
    """Accuracy of every leaf size, end of a walk, number of trees and fold.

    The table goes whole to every task. A task has some trees of a fold, of one
    run between two numbers of trees; it grows them for all leaf sizes, which
    share the draws, and walks the fold's rows down at once.
    """
    spark = base.sparkSession
    rows = base.select(F.col(row_id).cast("string").alias("text"), "bins", F.col(label).cast("bigint").alias("p"), F.col("fold").cast("int").alias("fold"))
    runs = list(zip([0, *counts], counts))
    step = max(1, -(-_tasks(spark) // (folds * len(runs))))
    keys = [(f, k, i, step, b) for f in range(folds) for k, (a, b) in enumerate(runs) for i in range(a, min(b, a + step))]
    grower = subtrees.grid_grower((growth.max_depth, growth.min_split, growth.tries), sizes, ends, poisson_marks(), _FOLD, _LEAF)
    sums = _few_at_once(_to_tasks(_row_blocks(rows), keys).mapInArrow(grower, subtrees.GRID_SUMS), "grid-sums")
    added = subtrees.grid_sums(len(sizes), len(ends), len(counts))
    found = sums.groupBy("fold", "chunk").applyInArrow(added, "text string, size int, sums array<double>")
    width = 2 * len(ends) * len(counts)
    # A row told more than once adds to the sums of its id as often.
    summed = found.groupBy("text", "size").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    held = base.select(F.col(row_id).cast("string").alias("text"), label, "fold")

    def hit(i: int, count: int) -> Column:
        share = F.round(F.when(F.col(f"s{i + 1}") > 0, F.col(f"s{i}")) / count, 9)
        return F.avg(((share > 0.5).cast("int") == F.col(label)).cast("int"))

    points = [(e, c, 2 * (e * len(counts) + j)) for e in range(len(ends)) for j, c in enumerate(counts)]
    told = F.array(*[F.struct(F.lit(e).alias("ends"), F.lit(c).alias("count"), hit(i, c).alias("accuracy")) for e, c, i in points])
    return summed.join(held, "text").groupBy("size", "fold").agg(told.alias("points")).select("size", "fold", F.inline("points"))


def _grid_table(judged: DataFrame, grid: dict[str, list], sizes: list[int], ends: list[tuple[int, int]]) -> DataFrame:
    """Mean and spread of the folds' accuracies at every point, and its rank."""
    stats = judged.groupBy("size", "ends", "count").agg(F.avg("accuracy").alias("mean_score"), F.stddev_pop("accuracy").alias("std_score"))
    # One row per grid point.
    found = stats.select(
        F.col("count").alias("trees"), F.get(F.array(*[F.lit(d) for d, _ in ends]), F.col("ends")).alias("max_depth"), F.get(F.array(*[F.lit(s) for _, s in ends]), F.col("ends")).alias("min_split"),
        F.get(F.array(*[F.lit(s) for s in sizes]), F.col("size")).alias("min_leaf"), "mean_score", "std_score",
    )
    return found.withColumn("rank", F.rank().over(W.orderBy(F.round("mean_score", 12).desc())))


def _grid_walk(nodes: DataFrame, base: DataFrame, row_id: str, cuts: Bins, ends: list[tuple[int, int]], counts: list[int]) -> DataFrame:
    """Mean share of every held-out row per leaf size, end of the walk and number of trees."""
    names = F.array(*[F.lit(f) for f in cuts.features])
    marks = F.array(*[F.array(*[F.lit(m) for m in [*ms, float("inf")]]) for ms in cuts.marks])
    # Back to bin numbers: a threshold is the least value of the bin after the cut.
    f = (F.array_position(names, F.col("feature")) - 1).cast("int")
    after = F.array_position(F.get(marks, f), F.col("threshold")).cast("double")
    held = nodes.select("tree", "node", "depth", f.alias("f"), after.alias("threshold"), (F.col("p") / F.col("n")).alias("share"), "n")

    def _told(i: int) -> Column:
        return F.when(F.col("sums")[i + 1] > 0, F.col("sums")[i])

    given = base.select(F.col(row_id).alias("id"), "fold", F.col("bins").cast("array<double>").alias("vals"))
    tree = F.col("tree")
    summed = _walk(held, given, ends, counts, F.floor(tree / _LEAF), tree % _FOLD, F.floor(tree % _LEAF / _FOLD).cast("int"))
    means = F.array(*[
        F.struct(F.lit(e).alias("ends"), F.lit(c).alias("count"), F.round(_told(2 * (e * len(counts) + j)) / c, 9).alias("share"))
        for e in range(len(ends)) for j, c in enumerate(counts)
    ])
    return summed.select(F.col("id").alias(row_id), "size", F.inline(means))
