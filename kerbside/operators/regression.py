"""Regressions whose every step is one aggregate: ridge by normal equations, logistic by reweighted least squares.

A step adds up products of columns over all rows; partial sums combine before
the shuffle, so one row per task and model moves. Only those sums, whose number
depends on the columns alone, reach the driver, which solves the small system.
Several models (settings, folds) go through the same pass over the rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEPS = 12
SWEEPS = 400
SETTLED = 1e-10


def design(features: Sequence[str]) -> Column:
    """The constant and the features as one array of doubles."""
    return F.array(F.lit(1.0), *[F.col(f"`{f}`").cast("double") for f in features])


def _dot(left: Column, right: Column, width: int) -> Column:
    total = left[0] * right[0]
    for i in range(1, width):
        total = total + left[i] * right[i]
    return total


def probability(x: Column, w: Column, width: int) -> Column:
    return 1 / (1 + F.exp(-_dot(x, w, width)))


# --- ridge ------------------------------------------------------------------------------


def ridge(rows: DataFrame, inputs: str, outputs: str, width: int, heads: int, penalty: float) -> np.ndarray:
    """Coefficients ``(width + 1, heads)`` of all heads over the input array, constant first.

    One pass adds up the outer product of (constant, inputs) with (constant,
    inputs, outputs); a Cholesky factor of the shared left part serves every
    head. ``penalty`` is per row and spares the constant.
    """
    left = F.concat(F.array(F.lit(1.0)), F.col(inputs).cast("array<double>"))
    both = F.concat(F.array(F.lit(1.0)), F.col(inputs).cast("array<double>"), F.col(outputs).cast("array<double>"))
    terms = rows.select(left.alias("l"), both.alias("r")).select(F.posexplode("l").alias("i", "a"), "r").select("i", "a", F.posexplode("r").alias("j", "b"))
    sums = np.zeros((width + 1, width + 1 + heads))
    for i, j, total in terms.groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b"))).collect():
        sums[i, j] = total
    n = sums[0, 0]
    if not n:
        return np.zeros((width + 1, heads))
    gram = sums[:, : width + 1] + penalty * n * np.diag([0.0] + [1.0] * width)
    return _solved(gram, sums[:, width + 1 :])


def _solved(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cholesky where the system allows it; the least-norm solution where columns repeat each other."""
    try:
        lower = np.linalg.cholesky(gram)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(gram, right, rcond=None)[0]
    return np.linalg.solve(lower.T, np.linalg.solve(lower, right))


# --- logistic ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Setting:
    """One logistic model.

    ``c`` is the inverse penalty (infinite: none), ``lasso`` the share of it
    that is absolute, ``fold`` the rows it must not see (-1: it sees all).
    """

    c: float = 1.0
    lasso: float = 0.0
    fold: int = -1


# Shares of the absolute penalty by name; without a penalty the inverse one is infinite.
PENALTIES = {"l1": 1.0, "l2": 0.0, "elasticnet": 0.5, "none": 0.0}


def _adder(models: list[tuple[int, list[float]]], width: int):
    """Function for ``mapInArrow`` over ``(x, label, fold)``: a task's sums of products of every model, one row a model.

    ``models`` has the held-out fold and the coefficients of each.
    """
    held, weights = np.array([h for h, _ in models]), np.array([w for _, w in models]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((len(held), width, width + 1)), np.zeros(len(held), bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for f in np.unique(held):
                open_ = fold != f
                if not open_.any():
                    continue
                its, mine = np.flatnonzero(held == f), x[open_]
                z = mine @ weights[:, its]
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-z))
                v = p * (1 - p)
                r = np.where(np.isnan(label[open_][:, None]), 0.0, v * z + label[open_][:, None] - p)
                seen[its] = True
                for k, m in enumerate(its):
                    sums[m, :, :width] += mine.T @ (mine * v[:, k : k + 1])
                sums[its, :, width] += (mine.T @ r).T
        told = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(told.astype(np.int32)), pa.array(list(sums[told].reshape(len(told), -1)), pa.list_(pa.float64()))], ["model", "sums"])

    return run


def _weighted_sums(rows: DataFrame, weights: dict[Setting, np.ndarray], width: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For every model the weighted Gram matrix and the working right side."""
    models = [(s.fold, [float(v) for v in w]) for s, w in weights.items()]
    parts = rows.mapInArrow(_adder(models, width), "model int, sums array<double>")
    total = parts.select("model", F.posexplode("sums").alias("i", "v")).groupBy("model", "i").agg(F.sum("v").alias("v"))
    found: dict[int, np.ndarray] = {}
    for model, i, v in total.collect():  # models times the square of the columns
        found.setdefault(model, np.zeros(width * (width + 1)))[i] = v
    return {m: (s.reshape(width, width + 1)[:, :width], s.reshape(width, width + 1)[:, width]) for m, s in found.items()}


def _lassos(grams: np.ndarray, rights: np.ndarray, starts: np.ndarray, strengths: np.ndarray) -> np.ndarray:
    """Least squares with an absolute penalty on all but the constant, one coordinate of all models at a time."""
    found, going = starts.copy(), np.arange(len(starts))
    for _ in range(SWEEPS):
        gram, right, w = grams[going], rights[going], found[going]
        for j in range(w.shape[1]):
            own = gram[:, j, j]
            rest = right[:, j] - (gram[:, j] * w).sum(axis=1) + own * w[:, j]
            shrink = strengths[going] if j else 0.0
            moved = np.sign(rest) * np.maximum(0.0, np.abs(rest) - shrink) / np.where(own == 0, 1.0, own)
            w[:, j] = np.where(own == 0, w[:, j], moved)
        change = np.abs(w - found[going]).max(axis=1)
        found[going] = w
        going = going[~(change < 1e-12)]
        if not len(going):
            break
    return found


def fit_logistic_models(rows: DataFrame, settings: Sequence[Setting], width: int, steps: int = STEPS) -> dict[Setting, np.ndarray]:
    """Coefficients of every setting after at most ``steps`` Newton steps over ``rows(x, label, fold)``.

    The penalty is 1 / c on the sum of the losses and spares the constant.
    Steps that would move no coefficient by ``SETTLED`` are left out.
    """
    weights = {s: np.zeros(width) for s in settings}
    # A row that misses a column adds to nothing, one that misses its label only to the products.
    label = F.coalesce(F.col("label").cast("double"), F.lit(math.nan)).alias("label")
    rows = rows.filter(F.col("fold").isNotNull() & ~F.exists("x", lambda v: v.isNull())).select("x", label, "fold")
    # Every step passes over all rows, so they are spread over all tasks once.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))).persist()
    try:
        for _ in range(steps):
            found, before = _weighted_sums(rows, weights, width), dict(weights)
            lassos = []
            for k, s in enumerate(settings):
                if k not in found:
                    continue
                gram, right = found[k]
                gram = gram + np.diag([0.0] + [(1 - s.lasso) / s.c] * (width - 1))
                if s.lasso:
                    lassos.append((s, gram, right))
                else:
                    weights[s] = _solved(gram, right)
            if lassos:
                of, grams, rights = zip(*lassos, strict=True)
                solved = _lassos(np.array(grams), np.array(rights), np.array([weights[s] for s in of]), np.array([s.lasso / s.c for s in of]))
                weights |= zip(of, solved, strict=True)
            if all(np.abs(weights[s] - before[s]).max() < SETTLED for s in settings):
                break
    finally:
        rows.unpersist()
    return weights


def fit_logistic(train: DataFrame, features: Sequence[str], c: float = 1.0, steps: int = STEPS) -> np.ndarray:
    """Ridge-penalised logistic regression: constant first, then the features."""
    rows = train.select(design(features).alias("x"), "label", F.lit(0).alias("fold"))
    return fit_logistic_models(rows, [Setting(c)], len(features) + 1, steps)[Setting(c)]


def score_logistic(rows: DataFrame, features: Sequence[str], weights: np.ndarray) -> DataFrame:
    """Add ``prob`` and ``prediction``; one projection."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    prob = probability(design(features), w, len(features) + 1)
    return rows.withColumn("prob", prob).withColumn("prediction", (F.col("prob") > 0.5).cast("int"))


def logistic_grid(train: DataFrame, features: Sequence[str], grid: dict[str, list], fold: Column, folds: int = 5) -> DataFrame:
    """Held-out accuracy of every grid point: parameters, mean, deviation and rank over the folds.

    All points and folds share the stored rows and each pass over them. The
    solver converges far below every listed iteration limit, so the limits
    share a fit.
    """
    rows = train.select(design(features).alias("x"), "label", fold.alias("fold")).persist()
    points = {(c, kind): Setting(math.inf if kind == "none" else c, PENALTIES[kind]) for c in grid["C"] for kind in grid["penalty"]}
    settings = list(dict.fromkeys(replace(s, fold=f) for s in points.values() for f in range(folds)))
    width = len(features) + 1
    try:
        weights = fit_logistic_models(rows, settings, width, min(min(grid["max_iter"]), 3 * STEPS))
        models = rows.sparkSession.createDataFrame(
            [(s.c, s.lasso, s.fold, [float(v) for v in w]) for s, w in weights.items()], "c double, lasso double, fold int, w array<double>"
        )
        right = ((probability(F.col("x"), F.col("w"), width) > 0.5).cast("int") == F.col("label")).cast("int")
        judged = rows.join(F.broadcast(models), "fold").groupBy("c", "lasso", "fold").agg(F.avg(right).alias("accuracy"))
        scores = {Setting(r["c"], r["lasso"], r["fold"]): r["accuracy"] for r in judged.collect()}
    finally:
        rows.unpersist()
    found = []
    for (c, kind), setting in points.items():
        each = np.array([scores.get(replace(setting, fold=f), np.nan) for f in range(folds)])
        mean, deviation = float(np.nanmean(each)), float(np.nanstd(each))
        found += [(float(c), kind, int(limit), mean, deviation) for limit in grid["max_iter"]]
    ranked = [(*p, 1 + sum(round(q[3], 12) > round(p[3], 12) for q in found)) for p in found]
    return train.sparkSession.createDataFrame(
        ranked, "C double, penalty string, max_iter int, mean_score double, std_score double, rank int"
    )
