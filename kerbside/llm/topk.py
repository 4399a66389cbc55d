"""Exact top-k search by inner product as a Voronoi kNN join.

Pivots cut the space into cells. A vector ``x`` of cell ``j`` lies at distance
``r`` from its pivot ``p_j``; for a query ``q`` within ``u`` of its own pivot
``p_i``, the score ``q.x`` lies within

    p_i.p_j -+ (|p_i| r + u |p_j| + u r)

Per cell a histogram of distances is the summary. From it each query group
derives a floor: a score that at least ``k + 1`` vectors are sure to reach.
Only vectors whose upper bound reaches the floor are replicated to the group,
in blocks of bounded size, so a cell that holds a third of all rows is many
blocks. Each (group, block) tile is solved by itself, and the tiles' best ``k``
of each query are merged.

Defined cases: vectors that are null, empty, of another length than most, or
hold null or non-finite components take no part, nor do rows without an id;
rows with the query's own id are never its result; ties go to the smaller id;
with fewer than ``k`` candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.tables import stored

MOST_PIVOTS = 256
BUCKETS = 64
GROUP_QUERIES = 16_384
LEAST_BLOCK, LARGEST_BLOCK = 2_048, 65_536


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``v``: array of floor(scale * component) as long; unfit vectors are left out."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False))
    )
    return fit.select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point while that is exact, else by integers."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _pivots(vectors: DataFrame, n: int) -> np.ndarray:
    most = int(min(MOST_PIVOTS, max(1, np.sqrt(n) / 2)))
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(most).select("v").collect()  # at most MOST_PIVOTS vectors
    return np.unique(np.array([r["v"] for r in rows], np.float64), axis=0)


def _placed(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each vector with its nearest pivot's cell and the distance to it."""
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (pivots**2).sum(1)
        for batch in batches:
            x = _matrix(batch.column(1), dim).astype(np.float64)
            cell = (squares[None, :] - 2 * x @ pivots.T).argmin(1) if len(x) else np.zeros(0, np.int64)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], ["id", "v", "cell", "away"]
            )

    return vectors.select("id", "v").mapInArrow(run, "id long, v array<long>, cell int, away double")


def _needed(pivots, edges, data_counts, query_reach, k: int, groups: list[list[int]]) -> list[tuple[int, int, float]]:
    """(group, cell, least distance that has to be replicated) by the bounds above.

    ``data_counts[j, b]`` vectors of cell j lie at most ``edges[b]`` from its pivot.
    """
    norms = np.sqrt((pivots**2).sum(1))
    out: dict[tuple[int, int], float] = {}
    for number, cells in enumerate(groups):
        for i in cells:
            dots, u = pivots @ pivots[i], query_reach[i]
            slack = norms[i] * edges[None, :] + u * norms[:, None] + u * edges[None, :]
            slack = slack * (1 + 1e-9) + 1e-6
            lower, upper = (dots[:, None] - slack).ravel(), dots[:, None] + slack
            order = np.argsort(-lower)
            reached = np.cumsum(data_counts.ravel()[order])
            enough = int(np.searchsorted(reached, k + 1))
            floor = lower[order[enough]] if enough < len(order) else -np.inf
            for j in range(len(pivots)):
                wanted = np.flatnonzero((upper[j] >= floor) & (data_counts[j] > 0))
                if len(wanted):
                    b = wanted[0]
                    least = float(edges[b - 1]) if b else -1.0
                    out[number, j] = min(out.get((number, j), np.inf), least)
    return [(g, j, least) for (g, j), least in sorted(out.items())]


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query the k best of a tile; ids ascend, so equal scores come out by id."""
    least = np.iinfo(np.int64).min
    scores = np.where(ids[None, :] == own[:, None], least, scores)
    n = scores.shape[1]
    bound = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(scores), least)
    for row in range(len(scores)):
        at = np.flatnonzero((scores[row] >= bound[row]) & (ids != own[row]))
        at = at[np.argsort(-scores[row][at], kind="stable")][:k]
        yield row, ids[at], scores[row][at]


def top_k(data: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best data rows of every query row."""
    spark = data.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = whole_vectors(data, id_col, vector_col, scale)
    lengths = every.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    asked = whole_vectors(queries, id_col, vector_col, scale)
    if lengths is None:
        return empty
    dim, n = lengths["dim"], lengths["count"]
    same = F.size("v") == dim
    pivots = _pivots(every.filter(same), n)
    placed = stored(_placed(every.filter(same), pivots), "topk-data")
    wanted = stored(_placed(asked.filter(same), pivots), "topk-queries")
    cells = len(pivots)

    # Summaries: at most MOST_PIVOTS * BUCKETS counts, and one reach per query cell.
    furthest = placed.agg(F.max("away")).first()[0] or 0.0
    edges = (np.arange(1, BUCKETS + 1) / BUCKETS) * (furthest * (1 + 1e-9) + 1e-9)
    bucket = F.least(F.lit(BUCKETS - 1), F.floor(F.col("away") / F.lit(float(edges[0])))).cast("int")
    counts = np.zeros((cells, BUCKETS), np.int64)
    for r in placed.groupBy("cell", bucket.alias("bucket")).count().collect():
        counts[r["cell"], r["bucket"]] = r["count"]
    reach, asking = np.zeros(cells), np.zeros(cells, np.int64)
    for r in wanted.groupBy("cell").agg(F.max("away").alias("reach"), F.count("*").alias("n")).collect():
        reach[r["cell"]], asking[r["cell"]] = r["reach"], r["n"]
    if not asking.sum():
        return empty

    # Neighbouring cells share a group until it has enough queries; a fuller cell is cut into parts below.
    direction = pivots @ (pivots.sum(0) + np.arange(dim))
    groups: list[list[int]] = [[]]
    filled = 0
    for cell in np.argsort(direction, kind="stable"):
        if asking[cell] and filled and filled + asking[cell] > GROUP_QUERIES:
            groups.append([])
            filled = 0
        if asking[cell]:
            groups[-1].append(int(cell))
            filled += int(asking[cell])
    parts = [-(-int(asking[g].sum()) // GROUP_QUERIES) for g in groups]
    block_rows = int(min(LARGEST_BLOCK, max(LEAST_BLOCK, n // 64)))
    blocks = -(-n // block_rows)

    needed = _needed(pivots, edges, counts, reach, k, groups)
    need = spark.createDataFrame(needed, "grp int, cell int, least double")  # at most groups * MOST_PIVOTS rows
    of_cell = spark.createDataFrame([(c, g, parts[g]) for g, cs in enumerate(groups) for c in cs], "cell int, grp int, parts int")
    with_parts = need.join(F.broadcast(spark.createDataFrame(list(enumerate(parts)), "grp int, parts int")), "grp")
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)).cast("int")
    copies = (
        placed.join(F.broadcast(with_parts), "cell").filter(F.col("away") >= F.col("least"))
        .select("grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), block.alias("block"), "id", "v", F.lit(False).alias("asks"))
    )
    asks = wanted.join(F.broadcast(of_cell), "cell").select(
        "grp", F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "v", F.lit(True).alias("asks"),
    )
    schema = "query_id long, vec_id long, score long"

    def solve(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks().sort_by("id")
        is_query = tile["asks"].to_numpy(zero_copy_only=False)
        ids = tile["id"].to_numpy()
        x = _matrix(tile["v"].combine_chunks(), dim)
        q, own, d, d_ids = x[is_query], ids[is_query], x[~is_query], ids[~is_query]
        out: tuple[list, list, list] = ([], [], [])
        step = max(1, (1 << 22) // max(1, len(d)))
        for at in range(0, len(q) if len(d) else 0, step):
            for row, best, score in _best(_products(q[at : at + step], d), d_ids, own[at : at + step], k):
                out[0].append(np.full(len(best), own[at + row]))
                out[1].append(best)
                out[2].append(score)
        joined = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), joined, strict=True)))

    tiles = copies.unionByName(asks).groupBy("grp", "part", "block").applyInArrow(solve, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return tiles.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
