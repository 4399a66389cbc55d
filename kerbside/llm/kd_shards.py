"""Sharding by a k-d tree over metadata, in DataFrame functions only.

The tree starts with all rows and the number of shards. A node of k shards is
cut along its widest dimension so that the lower part holds the bytes of
floor(k / 2) shards and the upper part those of the rest, until every leaf is
one shard and holds about the target bytes.

A dimension is a column turned into a whole number below 2^31: numbers and
times by their place between the least and the greatest value, anything else
by a digest; null is 0. A node's widths are relative to those of all rows. The
order along a dimension is the position, then a 32-bit digest of the text, so
no number of equal values stops a cut.

Weighted medians are exact and distributed. For all nodes of a level at once,
a histogram of bytes over ``BUCKETS`` steps of the key gives the step in which
the wanted byte lies; the next histogram covers only that step, until one key
is left. The cut goes before or after that key, whichever is nearer. The driver
holds nodes and histogram rows, at most ``shards * BUCKETS``.

Rows with equal texts form a group that takes the position of its least id, so
it moves as one through every cut. A group heavier than a hundredth of a shard
and than the heaviest row is dealt row by row instead; there are at most
100 * shards of those, which are broadcast.

Defined cases: a null text counts no bytes, only the ``OVERHEAD``; nulls in any
dimension share one position; repeated rows are rows of their own; with fewer
groups than shards some shards stay empty; an empty table gives no rows; other
columns are ignored. Slots number a shard's rows from 0 in bounded pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.running import numbered
from kerbside.llm.tables import stored

OVERHEAD = 8
BUCKETS = 512
HEAVY = 100  # a group beyond this fraction of a shard is dealt row by row
PIECE_ROWS = 50_000
_TOP = (1 << 31) - 1


@dataclass(frozen=True)
class Node:
    """A part of the rows that becomes ``shards`` shards, numbered from ``first``."""

    name: int
    first: int
    shards: int


@dataclass
class Bracket:
    """Where a node's cut is sought: keys ``low`` to ``high``, with ``below`` bytes of the node ahead."""

    node: Node
    dim: int
    total: int
    low: int
    high: int
    below: int = 0
    cut: int | None = None  # the greatest key of the lower part

    def off(self, ahead: int) -> int:
        """How far a lower part of ``ahead`` bytes is from the wanted one, in a unit that keeps it whole."""
        return abs(ahead * self.node.shards - self.total * (self.node.shards // 2))


def _positions(rows: DataFrame, dims: list[str]) -> list[Column]:
    numeric = [d for d in dims if isinstance(rows.schema[d].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))]

    def number(d: str) -> Column:
        kind = rows.schema[d].dataType
        plain = F.col(d) if isinstance(kind, T.NumericType) else F.col(d).cast("int") if isinstance(kind, T.BooleanType) else F.unix_micros(F.col(d).cast("timestamp"))
        plain = plain.cast("double")
        return F.when(~F.isnan(plain) & (F.abs(plain) < float("inf")), plain)

    ends = rows.agg(*(f(number(d)).alias(f"{f.__name__}_{d}") for d in numeric for f in (F.min, F.max))).first() if numeric else None
    found = []
    for d in dims:
        if d not in numeric:
            found.append(F.shiftright(F.crc32(F.col(d).cast("string")), 1))
        elif ends[f"min_{d}"] is None or ends[f"min_{d}"] == ends[f"max_{d}"]:
            found.append(F.lit(0).cast("long"))
        else:
            low, wide = ends[f"min_{d}"], ends[f"max_{d}"] - ends[f"min_{d}"]
            found.append(F.floor((number(d) - low) / wide * _TOP).cast("long"))
    return [F.coalesce(p, F.lit(0)).cast("long") for p in found]


def _grouped(rows: DataFrame, shards: int, places: list[str]) -> DataFrame:
    """The rows with the place of their group's least id and a 32-bit digest that no cut separates."""
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min(F.struct("doc_id", *places)).alias("lead"))
    groups = stored(groups.filter("n > 1"), "kd-groups")
    total, heaviest = rows.agg(F.sum("size"), F.max("size")).first()
    light = F.col("bytes") <= max((total or 0) // (shards * HEAVY), heaviest or 0)
    heavy = F.broadcast(groups.filter(~light).select("digest"))
    lone = rows.join(heavy, "digest", "left_semi").withColumn("tie", F.xxhash64("digest", "doc_id"))
    lead = groups.filter(light).select("digest", F.col("lead").alias("lead"))
    together = rows.join(heavy, "digest", "left_anti").join(lead, "digest", "left")
    together = together.withColumns({p: F.coalesce(F.col("lead")[p], F.col(p)) for p in places}).withColumn("tie", F.xxhash64("digest")).drop("lead")
    tie = F.col("tie").bitwiseAND((1 << 32) - 1)
    return together.unionByName(lone).select("doc_id", "size", "text_crc32", tie.alias("tie"), F.array(*places).alias("places"))


def _table(rows: DataFrame, names: str, values: list[tuple[int, ...]]) -> DataFrame:
    """A few whole numbers as a table; their count is bounded by the shards."""
    lines = ", ".join("(" + ", ".join(f"{int(v)}L" for v in value) + ")" for value in values)
    return rows.sparkSession.sql(f"SELECT * FROM VALUES {lines} AS t({names})")


def _key(dim: Column) -> Column:
    """The order along a dimension: place, then digest."""
    return F.shiftleft(F.element_at("places", (dim + 1).cast("int")), 32) + F.col("tie")


def _narrowed(rows: DataFrame, brackets: list[Bracket]) -> None:
    """One histogram over all open brackets; each then holds less or has its cut."""
    steps = {b.node.name: (b.high - b.low) // BUCKETS + 1 for b in brackets}
    edges = _table(rows, "node, dim, low, high, step", [(b.node.name, b.dim, b.low, b.high, steps[b.node.name]) for b in brackets])
    seen = rows.join(F.broadcast(edges), "node").withColumn("key", _key(F.col("dim"))).filter("key BETWEEN low AND high")
    counted = seen.groupBy("node", F.expr("(key - low) DIV step").alias("bucket")).agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
    found: dict[int, list] = {b.node.name: [] for b in brackets}
    for r in counted.collect():
        found[r["node"]].append((r["bucket"], r["bytes"], r["low"], r["high"]))
    for b in brackets:
        ahead = b.below
        for _, held, low, high in sorted(found[b.node.name]):
            # The bucket in which the wanted byte lies; the last one ends at or beyond it.
            if (ahead + held) * b.node.shards >= b.total * (b.node.shards // 2):
                if low == high:
                    b.cut = low - 1 if b.off(ahead) <= b.off(ahead + held) else low
                else:
                    b.low, b.high, b.below = low, high, ahead
                break
            ahead += held


def _cuts(rows: DataFrame, nodes: list[Node], extent: list[int], dims: int) -> list[Bracket]:
    """The cut of every node: its widest dimension, and the key nearest to the wanted byte there."""
    places = [F.element_at("places", i + 1) for i in range(dims)]
    seen = rows.groupBy("node").agg(
        F.sum("size").alias("total"), *(F.min(p).alias(f"low{i}") for i, p in enumerate(places)), *(F.max(p).alias(f"high{i}") for i, p in enumerate(places))
    )
    by_name, brackets = {n.name: n for n in nodes}, []
    for r in seen.collect():
        if r["node"] in by_name:
            wide = [(r[f"high{i}"] - r[f"low{i}"]) / max(1, extent[i]) for i in range(dims)]
            dim = wide.index(max(wide))
            brackets.append(Bracket(by_name[r["node"]], dim, r["total"], r[f"low{dim}"] << 32, (r[f"high{dim}"] << 32) + (1 << 32) - 1))
    while unsettled := [b for b in brackets if b.cut is None]:
        _narrowed(rows, unsettled)
    return brackets


def kd_shards(docs: DataFrame, shards: int, dims: list[str], id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` (from 0) and ``slot`` (gapless from 0) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *(F.col(d).alias(f"dim{i}") for i, d in enumerate(dims)))
    places = [f"place{i}" for i in range(len(dims))]
    found = _positions(plain, [f"dim{i}" for i in range(len(dims))])
    # The text is read once; only digests and numbers of it go on.
    narrow = stored(plain.select(
        "doc_id", (F.octet_length("text") + OVERHEAD).cast("long").alias("size"), F.crc32("text").alias("text_crc32"), F.unhex(F.md5("text")).alias("digest"),
        *(p.alias(name) for p, name in zip(found, places, strict=True)),
    ), "kd-rows")
    base = stored(_grouped(narrow, shards, places), "kd-places")
    ends = base.agg(F.count("*"), *(f(F.element_at("places", i + 1)) for i in range(len(dims)) for f in (F.min, F.max))).first()
    extent = [(ends[2 + 2 * i] - ends[1 + 2 * i]) if ends[0] else 0 for i in range(len(dims))]
    rows, nodes, last = base.withColumn("node", F.lit(0).cast("long")), [Node(0, 0, shards)], 0
    while open_nodes := [n for n in nodes if n.shards > 1]:
        cuts = _cuts(rows, open_nodes, extent, len(dims))
        made, lines = [n for n in nodes if n.shards == 1], []
        for b in cuts:
            lower, upper = last + 1, last + 2
            last += 2
            half = b.node.shards // 2
            made += [Node(lower, b.node.first, half), Node(upper, b.node.first + half, b.node.shards - half)]
            lines.append((b.node.name, b.dim, b.cut, lower, upper))
        nodes = made
        if lines:
            split = _table(rows, "node, dim, cut, lower, upper", lines)
            part = F.when(F.col("dim").isNull(), F.col("node")).when(_key(F.col("dim")) <= F.col("cut"), F.col("lower")).otherwise(F.col("upper"))
            rows = rows.join(F.broadcast(split), "node", "left").withColumn("node", part).drop("dim", "cut", "lower", "upper")
    shard_of = {n.name: n.first for n in nodes}
    leaves = _table(rows, "node, shard", list(shard_of.items()) or [(0, 0)])
    pieces = -(-ends[0] // (shards * PIECE_ROWS)) or 1
    placed = rows.join(F.broadcast(leaves), "node").withColumn("shard", F.col("shard").cast("int"))
    done = numbered(placed, ["tie", "doc_id"], F.expr(f"tie DIV {-(-(1 << 32) // pieces)}"), ["shard"], "slot")
    return done.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
