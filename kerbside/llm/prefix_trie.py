"""Prefix trie of conversations with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns; its members are the
conversations that start with it. Nodes are found by key: the two 64-bit XOR
sums over position-bound hashes of the turns, so a prefix's key is a running
aggregate and no conversation is gathered in a row. A node is then named by
its depth and its smallest member, which no other node has.

Subtree totals come from join rounds over the shrinking tree. Every node holds
what has been merged into it and what its edge upwards adds:

- rake: childless nodes are finished; their totals are summed by parent before
  the shuffle and added to the parents;
- compress: of the nodes with one child, those that come before both their
  one-child neighbours (by how often two divides the depth, then by a digest)
  are spliced out; the edge of the child takes over what they held. A plain
  chain of n nodes halves in every round.

The log of spliced nodes (node, child, what lies between) is then re-expanded:
pointer doubling over the log reaches a raked node in log2(rounds) joins, which
gives every spliced node its subtree total. A parent with more than a
thousandth of all nodes as children is never a unary node; rows under such
parents are kept out of the shuffled joins, and what they need of the at most
1000 such parents is broadcast.

Digests of the conversations that end in a node are streamed: their ids are
joined in bounded pieces, and one task hashes the pieces of a node in order
without holding them.

Defined cases: a null role or text is empty; turns are ordered by turn (null
first), then role, then text; repeated rows are turns of their own; rows
without a conv_id belong to no conversation and are left out; other columns
are ignored; an empty table gives no nodes. Long conversations are numbered in
pieces of ``PIECE`` turn values.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.llm.tables import stored

PIECE = 4096
IDS_A_ROW = 512
LEAST_HOT, HOT_SHARE = 1000, 1000
SHARED, GROUP = 6, 100

KEY = ("depth", "k1", "k2")
TOTALS = ("n_leaves", "saved_tokens")


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first one of its hundred."""
    return (F.crc32(conv_id.cast("string")) % SHARED).cast("long")


def _numbered(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), the turn's hashes and size, and of its conversation
    ``shared`` (turns replaced), ``taken`` (turns put there) and ``total`` after that."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        # Rises with the turn, null first; every conversation is cut into pieces of bounded turn ranges.
        F.coalesce(F.floor(F.col("turn") / PIECE), F.lit(-(1 << 62))).alias("piece"),
    )
    sizes = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("conv_id").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = sizes.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    own = sizes.groupBy("conv_id").agg(F.sum("n").alias("given")).withColumn("shared", shared_turns(F.col("conv_id")))
    first = own.select(F.col("conv_id").alias("first_id"), F.col("given").alias("first_given"))
    frames = own.join(first, F.col("first_id") == F.col("conv_id") - F.col("conv_id") % GROUP, "left").withColumn(
        "taken", F.least("shared", F.coalesce("first_given", F.lit(0)))
    )
    frames = frames.select("conv_id", "shared", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("given") - F.col("shared"))).alias("total"))
    inside = W.partitionBy("conv_id", "piece").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.join(pieces.join(frames, "conv_id").drop("n"), ["conv_id", "piece"]).select(
        "conv_id", (F.col("before") + F.row_number().over(inside)).alias("place"), "shared", "taken", "total",
        F.xxhash64("role", "text").alias("a"), F.xxhash64("text", "role", F.lit(1)).alias("b"), F.length("text").cast("long").alias("chars"),
    )


def members(turns: DataFrame) -> DataFrame:
    """Every rebuilt conversation's prefixes: the node's key, its parent's, the last text's size and whether it ends there."""
    rows = stored(_numbered(turns), "trie-turns")
    turn = ("a", "b", "chars")
    own = rows.filter(F.col("place") > F.col("shared")).select("conv_id", "total", (F.col("place") - F.col("shared") + F.col("taken")).alias("depth"), *turn)
    # At most SHARED - 1 turns of a conversation and GROUP conversations meet here.
    heads = rows.filter((F.col("conv_id") % GROUP == 0) & (F.col("place") < SHARED)).select(F.col("conv_id").alias("first_id"), F.col("place").alias("depth"), *turn)
    each = rows.filter("place = 1").select("conv_id", "shared", "total")
    taken = each.join(heads, F.col("first_id") == F.col("conv_id") - F.col("conv_id") % GROUP).filter(F.col("depth") <= F.col("shared"))
    steps = own.unionByName(taken.select(*own.columns)).select(
        "conv_id", "depth", "total", "chars", F.xxhash64("depth", "a", "b").alias("x1"), F.xxhash64("a", "depth", "b").alias("x2"),
        F.floor(F.col("depth") / PIECE).alias("piece"),
    )
    sums = steps.groupBy("conv_id", "piece").agg(F.bit_xor("x1").alias("p1"), F.bit_xor("x2").alias("p2"))
    ahead = W.partitionBy("conv_id").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("conv_id", "piece", *(F.coalesce(F.bit_xor(p).over(ahead), F.lit(0)).alias(p) for p in ("p1", "p2")))
    so_far = W.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    keyed = steps.join(offsets, ["conv_id", "piece"]).select(
        "conv_id", "depth", (F.col("depth") == F.col("total")).alias("ends"), "chars", "x1", "x2",
        F.bit_xor("x1").over(so_far).bitwiseXOR(F.col("p1")).alias("k1"), F.bit_xor("x2").over(so_far).bitwiseXOR(F.col("p2")).alias("k2"),
    )
    keyed = keyed.select("conv_id", *KEY, "ends", "chars", F.col("k1").bitwiseXOR(F.col("x1")).alias("up1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("up2"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = each.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), (F.col("total") == 0).alias("ends"), zero.alias("chars"), none.alias("up1"), none.alias("up2"))
    return keyed.unionByName(roots)


def _ends_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of the conversations that end in a node, per node that has any."""
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")), ",")
    pieces = rows.filter("ends").groupBy(*KEY, F.floor(F.col("conv_id") / IDS_A_ROW).alias("piece")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(nodes, digests):
            columns = [pa.array([n[i] for n in nodes], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], [*KEY, "ends_sha256"])

        last, state = None, None
        for batch in batches:
            nodes, digests = [], []
            depth, k1, k2, ids = (batch.column(i).to_pylist() for i in range(4))
            for node, text in zip(zip(depth, k1, k2, strict=True), ids, strict=True):
                if node != last:
                    if last is not None:
                        nodes.append(last)
                        digests.append(state.hexdigest())
                    last, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield made(nodes, digests)
        if last is not None:
            yield made([last], [state.hexdigest()])

    laid = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
    return laid.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _hot(nodes: DataFrame, children: str) -> DataFrame:
    """The parents of more than a thousandth of the nodes; at most HOT_SHARE of them."""
    return nodes.filter(F.col(children) > max(LEAST_HOT, nodes.count() // HOT_SHARE))


def trie_nodes(turns: DataFrame) -> DataFrame:
    """One row per node without subtree totals: name, parent, members, children, last text's size, digest."""
    rows = stored(members(turns), "trie-members")
    found = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("up1").alias("up1"), F.max("up2").alias("up2")
    )
    children = found.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(F.count("*").alias("n_children"))
    full = found.join(children, [*KEY], "left").join(_ends_digests(rows), [*KEY], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
    })
    nodes = stored(full, "trie-nodes")
    parents = nodes.select(*(F.col(k).alias(f"p_{k}") for k in KEY), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below, hot = nodes.filter("depth > 0"), _hot(parents, "n_children").drop("n_children")
    meet = (F.col("depth") - 1 == F.col("p_depth")) & (F.col("up1") == F.col("p_k1")) & (F.col("up2") == F.col("p_k2"))
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "chars", "ends_sha256")
    crowded = below.join(F.broadcast(hot), meet)
    others = below.join(F.broadcast(hot), meet, "left_anti").join(parents.drop("n_children"), meet)
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return stored(crowded.select(*out).unionByName(others.select(*out)).unionByName(root.select(*out)), "trie-parents")


def _raked(tree: DataFrame) -> DataFrame:
    """The tree without its childless nodes, whose totals their parents take."""
    gifts = tree.filter("kids = 0 AND up IS NOT NULL").groupBy(F.col("up").alias("conv_id"), F.col("up_depth").alias("depth")).agg(
        F.count("*").alias("gone"), *(F.sum(F.col(t) + F.col(f"edge_{t}")).alias(f"more_{t}") for t in TOTALS)
    )
    left = tree.filter("kids > 0").join(gifts, ["conv_id", "depth"], "left")
    changed = {t: F.col(t) + F.coalesce(f"more_{t}", F.lit(0)) for t in TOTALS} | {"kids": F.col("kids") - F.coalesce("gone", F.lit(0))}
    return left.withColumns(changed).select(*tree.columns)


def _hot_keys(tree: DataFrame) -> DataFrame:
    return F.broadcast(_hot(tree, "kids").select(F.col("conv_id").alias("up"), F.col("depth").alias("up_depth")))


def _marked(tree: DataFrame) -> DataFrame:
    """Add ``goes``: one-child nodes to splice out, no two of them neighbours."""
    # How often two divides the depth, as its lowest set bit; then a digest of the name, then the name.
    rank = F.struct(F.col("depth").bitwiseAND(-F.col("depth")).alias("bit"), F.xxhash64("conv_id", "depth").alias("digest"), "conv_id")
    single = tree.filter("kids = 1 AND up IS NOT NULL").select("conv_id", "depth", "up", "up_depth", rank.alias("rank"))
    # A node under a crowded parent has no one-child neighbour above.
    lower = single.join(_hot_keys(tree), ["up", "up_depth"], "left_anti").select(
        F.col("conv_id").alias("low_id"), F.col("depth").alias("low_depth"), F.col("rank").alias("low_rank"), F.col("up").alias("of"), F.col("up_depth").alias("of_depth")
    )
    pairs = single.join(lower, (F.col("conv_id") == F.col("of")) & (F.col("depth") == F.col("of_depth")))
    first = F.col("rank") < F.col("low_rank")
    waits = pairs.select(
        F.when(first, F.col("low_id")).otherwise(F.col("conv_id")).alias("conv_id"),
        F.when(first, F.col("low_depth")).otherwise(F.col("depth")).alias("depth"),
    ).distinct()
    marked = tree.join(waits.withColumn("waits", F.lit(True)), ["conv_id", "depth"], "left")
    goes = F.col("waits").isNull() & F.expr("kids = 1 AND up IS NOT NULL")
    return marked.select(*tree.columns, goes.alias("goes"))


def _spliced(marked: DataFrame) -> DataFrame:
    """The rows that stay; those whose parent goes hold it in ``via_*``."""
    columns = [c for c in marked.columns if c != "goes"]
    via = marked.filter("goes").select(F.col("conv_id").alias("v_id"), F.col("depth").alias("v_depth"), *(F.col(c).alias(f"via_{c}") for c in columns if c not in ("conv_id", "depth", "kids")))
    rest, hot = marked.filter("NOT goes").select(*columns), _hot_keys(marked)
    met = rest.join(hot, ["up", "up_depth"], "left_anti").join(via, (F.col("up") == F.col("v_id")) & (F.col("up_depth") == F.col("v_depth")), "left")
    # The children of a crowded parent keep it: it has more than one.
    same = rest.join(hot, ["up", "up_depth"], "left_semi")
    out = [c for c in met.columns if c not in ("v_id", "v_depth")]
    return met.select(*out).unionByName(same.select(*columns), allowMissingColumns=True)


def _next_tree(joined: DataFrame, columns: list[str]) -> DataFrame:
    gone = F.col("via_up").isNotNull()
    held = {f"edge_{t}": F.col(f"edge_{t}") + F.when(gone, F.col(f"via_{t}") + F.col(f"via_edge_{t}")).otherwise(0) for t in TOTALS}
    moved = {c: F.when(gone, F.col(f"via_{c}")).otherwise(F.col(c)) for c in ("up", "up_depth")}
    return joined.withColumns(held | moved).select(*columns)


def _splice_log(joined: DataFrame) -> DataFrame:
    """What a spliced node has beyond the subtree total of the child it had then."""
    return joined.filter("via_up IS NOT NULL").select(
        F.col("up").alias("conv_id"), F.col("up_depth").alias("depth"), F.col("conv_id").alias("to_id"), F.col("depth").alias("to_depth"),
        *((F.col(f"via_{t}") + F.col(f"edge_{t}")).alias(t) for t in TOTALS),
    )


def _union(tables: list[DataFrame]) -> DataFrame:
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    return found


def _re_expanded(log: DataFrame, raked: DataFrame, rounds: int) -> DataFrame:
    """Subtree totals of the spliced nodes. A node leads to one that went in a later round."""
    for _ in range(math.ceil(math.log2(max(2, rounds)))):
        log = stored(log, "trie-log")
        on = log.select(F.col("conv_id").alias("n_id"), F.col("depth").alias("n_depth"), F.col("to_id").alias("n_to"), F.col("to_depth").alias("n_to_depth"), *(F.col(t).alias(f"n_{t}") for t in TOTALS))
        further = F.col("n_id").isNotNull()
        log = log.join(on, (F.col("to_id") == F.col("n_id")) & (F.col("to_depth") == F.col("n_depth")), "left").select(
            "conv_id", "depth", F.when(further, F.col("n_to")).otherwise(F.col("to_id")).alias("to_id"), F.when(further, F.col("n_to_depth")).otherwise(F.col("to_depth")).alias("to_depth"),
            *((F.col(t) + F.when(further, F.col(f"n_{t}")).otherwise(0)).alias(t) for t in TOTALS),
        )
    ends = raked.select(F.col("conv_id").alias("to_id"), F.col("depth").alias("to_depth"), *(F.col(t).alias(f"end_{t}") for t in TOTALS))
    return log.join(ends, ["to_id", "to_depth"]).select("conv_id", "depth", *((F.col(t) + F.col(f"end_{t}")).alias(t) for t in TOTALS))


def subtree_totals(tree: DataFrame) -> DataFrame:
    """``conv_id``, ``depth`` and the subtree totals of every node.

    ``tree`` has a node a row: its name (``conv_id``, ``depth``), its parent's
    (``up``, ``up_depth``; null at a root), the number of children ``kids``
    and its own share of each total.
    """
    columns = ["conv_id", "depth", "up", "up_depth", "kids", *TOTALS, *(f"edge_{t}" for t in TOTALS)]
    tree = tree.withColumns({f"edge_{t}": F.lit(0).cast("long") for t in TOTALS}).select(*columns)
    raked, spliced = [], []
    while True:
        raked.append(tree.filter("kids = 0").select("conv_id", "depth", *TOTALS))
        tree = stored(_raked(tree), "trie-raked")
        if tree.isEmpty():
            break
        joined = stored(_spliced(stored(_marked(tree), "trie-marked")), "trie-spliced")
        spliced.append(_splice_log(joined))
        tree = _next_tree(joined, columns)
    done = _union(raked)
    return done.unionByName(_re_expanded(_union(spliced), done, len(spliced))) if spliced else done


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    nodes = trie_nodes(turns)
    one = F.lit(1).cast("long")
    tree = nodes.select(
        "conv_id", "depth", F.col("parent_conv_id").alias("up"), F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("up_depth"),
        F.col("n_children").alias("kids"), F.when(F.col("n_children") == 0, one).otherwise(0).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    return nodes.drop("chars").join(subtree_totals(tree), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *TOTALS, "ends_sha256"
    )
