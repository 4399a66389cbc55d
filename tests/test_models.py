import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from kerbside.functions.draws import draw
from kerbside.operators import models as M
from kerbside.operators import regression as R
from kerbside.operators import subtrees, summaries, traffic
from kerbside.operators import trees as T
from kerbside.plans import fleet

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(12)
    data = [(i, rng.random(), rng.random()) for i in range(300)]
    return spark.createDataFrame([(i, a, b, int(a + 0.1 * b > 0.5)) for i, a, b in data], "id int, a double, b double, label int")


@pytest.mark.parametrize(
    "fit, settings",
    [
        (M.fit_forest, {"numTrees": 5, "maxDepth": 4}), (M.fit_logistic, {"maxIter": 20}),
        (M.fit_linear_svm, {"maxIter": 20}), (M.fit_boosting, {"maxIter": 3}), (M.fit_tree, {}),
    ],
)
def test_classifiers_learn_a_simple_rule(rows, fit, settings):
    scored = M.score(fit(rows, COLUMNS, **settings), rows)
    assert scored.filter(F.col("prediction") == F.col("label")).count() > 260
    assert scored.filter("prob < 0 OR prob > 1").count() == 0
    own = summaries.auc(scored, "label", "prob").first()["auc"]
    assert own == pytest.approx(M.evaluator_auc(scored), abs=1e-9)


def test_solvers_go_through_rows_on_every_core(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, vectors: seen.append(vectors.rdd.glom().map(len).collect()) or PipelineModel(stages=[]))
    wide = spark.range(40_000, numPartitions=1).selectExpr("id AS a", "id % 7 AS b", "id % 2 AS label")
    M.fit_tree(wide, COLUMNS)
    M.fit_tree(wide.limit(100), COLUMNS)
    assert len(seen[0]) == spark.sparkContext.defaultParallelism and min(seen[0]) > 3_000 and sum(seen[0]) == 40_000
    assert [n for n in seen[1] if n] == [100]


def test_vehicles_are_put_together_once_for_all_passes(spark):
    for rows in fleet._sets(spark, "/root/testdata/sf0.001"):
        assert all("/vehicles-" in f for f in rows.inputFiles())


def test_importances_are_sorted_and_named(rows):
    out = M.importances(M.fit_forest(rows, COLUMNS, numTrees=5, maxDepth=3)).collect()
    assert [r["feature"] for r in out] == ["a", "b"] and out[0]["importance"] >= out[1]["importance"]


def test_grid_search_table(rows):
    best, table = M.grid_search(rows, M.DecisionTreeClassifier(seed=1), {"maxDepth": [1, 3]}, 2, COLUMNS)
    out = table.orderBy("rank").collect()
    assert len(out) == 2 and out[0]["mean_score"] >= out[1]["mean_score"] and out[0]["rank"] == 1
    assert M.score(best, rows).count() == 300


def test_forecast_heads_recover_a_repeating_day(spark):
    days = [(d, h, 100 + 10 * h + d) for d in range(12) for h in range(24)]
    series = spark.createDataFrame(
        [(f"2024-01-{d + 1:02} {h:02}:00:00", v) for d, h, v in days], "ts string, total int"
    ).withColumn("ts", F.to_timestamp("ts"))
    scaler = traffic.fit_scaler(series, ["total"])
    seqs = traffic.sequences(traffic.scale_columns(series, scaler, ["total"]))
    late = traffic.held_out(seqs)
    assert sorted(r["seq"] for r in late.collect()) == [8, 9, 10]
    error = traffic.squared_error(M.forecast(M.fit_forecast(seqs), late)).first()["mse"]
    assert error < 1e-3


# Regressions and trees as table jobs


def logistic_data(rng, n, width):
    x = rng.normal(size=(n, width))
    w = rng.normal(size=width) * 2
    return x, (rng.random(n) < 1 / (1 + np.exp(-(x @ w - 0.5)))).astype(int)


def table_of(spark, x, y):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names) + ", label int"), names


def test_newton_equals_the_general_solver(spark):
    x, y = logistic_data(np.random.default_rng(1), 300, 3)
    rows, names = table_of(spark, x, y)
    own = R.fit_logistic(rows, names, 0.5)
    other = M.fit_logistic(rows, names, regParam=1 / (0.5 * 300), maxIter=300, tol=1e-12).stages[-1]
    assert own == pytest.approx([other.intercept, *other.coefficients.toArray()], abs=1e-5)
    scored = R.score_logistic(rows, names, own)
    assert scored.filter("prediction = label").count() > 220


@pytest.mark.parametrize("kind", ["l1", "l2", "elasticnet", "none"])
def test_every_penalty_ends_where_no_coefficient_wants_to_move(spark, kind):

    x, y = logistic_data(np.random.default_rng(2), 200, 4)
    rows, names = table_of(spark, x, y)
    c = math.inf if kind == "none" else 0.05
    mix = R.PENALTIES[kind]
    setting = R.Setting(c, mix)
    given = rows.select(R.design(names).alias("x"), "label", F.lit(0).alias("fold"))
    w = R.fit_logistic_models(given, [setting], 5, 60)[setting]
    z = np.concatenate([np.ones((200, 1)), x], axis=1)
    slope = z.T @ (1 / (1 + np.exp(-(z @ w))) - y)
    smooth = slope + np.array([0, *((1 - mix) / c * w[1:])])
    assert abs(smooth[0]) < 1e-4
    for j in range(1, 5):
        pull = mix / c
        assert abs(smooth[j] + pull * np.sign(w[j])) < 1e-4 if w[j] else abs(smooth[j]) <= pull + 1e-4


def test_sums_of_many_models_take_no_wide_join(spark):
    x, y = logistic_data(np.random.default_rng(5), 120, 2)
    rows, names = table_of(spark, x, y)
    given = rows.select(F.array(F.lit(1.0), F.when(F.col("id") != 7, F.col("x0")), F.col("x1")).alias("x"), F.when(F.col("id") != 9, F.col("label")).cast("double").alias("label"), (F.col("id") % 2).cast("int").alias("fold"))
    settings = {R.Setting(1.0, 0.0, f): np.array([0.1, -0.2, 0.3]) for f in (-1, 0, 1)}
    clean = given.filter("x[1] IS NOT NULL").withColumn("label", F.coalesce("label", F.lit(math.nan)))
    found = R._weighted_sums(clean, settings, 3)
    for k, s in enumerate(settings):
        keep = np.array([i != 7 and i % 2 != s.fold for i in range(120)])
        z = np.concatenate([np.ones((120, 1)), x], axis=1)
        p = 1 / (1 + np.exp(-(z @ settings[s])))
        v = p * (1 - p)
        right = np.where(np.arange(120) == 9, 0, v * (z @ settings[s]) + y - p)
        assert found[k][0] == pytest.approx(z[keep].T @ (z[keep] * v[keep][:, None]))
        assert found[k][1] == pytest.approx(z[keep].T @ right[keep])
    assert np.isfinite(R.fit_logistic_models(given, list(settings), 3)[R.Setting(1.0, 0.0, 0)]).all()


def test_folds_hide_their_rows(spark):
    x, y = logistic_data(np.random.default_rng(3), 150, 2)
    rows, names = table_of(spark, x, y)
    given = rows.select(R.design(names).alias("x"), "label", (F.col("id") % 3).cast("int").alias("fold"))
    settings = [R.Setting(1.0, 0.0, f) for f in range(3)]
    found = R.fit_logistic_models(given, settings, 3)
    for f, s in enumerate(settings):
        assert found[s] == pytest.approx(R.fit_logistic(rows.filter(f"id % 3 <> {f}"), names), abs=1e-8)
    table = R.logistic_grid(rows, names, {"C": [0.1, 1.0], "penalty": ["l1", "l2", "none"], "max_iter": [50, 100]}, (F.col("id") % 3).cast("int"), 3).collect()
    assert len(table) == 12 and min(r["rank"] for r in table) == 1
    best = max(r["mean_score"] for r in table)
    assert all((r["rank"] == 1) == (abs(r["mean_score"] - best) < 1e-12) for r in table)


def test_ridge_shares_one_pass_and_survives_repeated_columns(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    y = np.stack([x @ [1, 2, 3] + 4, x @ [0, -1, 1] - 2], axis=1)
    rows = spark.createDataFrame([(list(map(float, a)), list(map(float, b))) for a, b in zip(x, y, strict=True)], "i array<double>, o array<double>")
    found = R.ridge(rows, "i", "o", 3, 2, 0.0)
    assert found == pytest.approx(np.array([[4, -2], [1, 0], [2, -1], [3, 1]]), abs=1e-8)
    twice = rows.withColumn("i", F.concat("i", "i"))
    again = R.ridge(twice, "i", "o", 6, 2, 0.0)
    assert again[1:4] + again[4:] == pytest.approx(found[1:], abs=1e-6)
    assert R.ridge(rows.limit(0), "i", "o", 3, 2, 0.1).shape == (4, 2)


def plain_tree(rows, growth, width, path=""):
    """The same tree by recursion over rows ``(bins, n, p)``; gives its nodes."""
    n, p = sum(r[1] for r in rows), sum(r[2] for r in rows)
    purity = lambda n, p: (p * p + (n - p) * (n - p)) / n
    best = None
    for f in range(width):
        for b in sorted({r[0][f] for r in rows})[:-1]:
            nl, pl = sum(r[1] for r in rows if r[0][f] <= b), sum(r[2] for r in rows if r[0][f] <= b)
            if nl >= growth.min_leaf and n - nl >= growth.min_leaf:
                score = purity(nl, pl) + purity(n - nl, p - pl)
                if best is None or score > best[0]:
                    best = (score, f, b)
    if best is None or best[0] - purity(n, p) <= T.LEAST_GAIN or n < growth.min_split or len(path) >= growth.max_depth:
        return [(path, n, p, None)]
    low, high = [r for r in rows if r[0][best[1]] <= best[2]], [r for r in rows if r[0][best[1]] > best[2]]
    return [(path, n, p, best[1]), *plain_tree(low, growth, width, path + "0"), *plain_tree(high, growth, width, path + "1")]


@pytest.mark.parametrize("growth", [T.Growth(), T.Growth(3, 8, 3), T.Growth(60, 2, 5)])
def test_tree_equals_plain_recursion(spark, growth):
    rng = random.Random(growth.min_leaf)
    data = [(i, rng.choice([1.0, 2.0, 5.5, None]), float(rng.randrange(40)), float("nan") if i % 17 == 0 else rng.random(), 7.0, int(rng.random() < 0.4)) for i in range(160)]
    rows = spark.createDataFrame(data, "id int, a double, b double, c double, d double, label int")
    names = ["a", "b", "c", "d"]
    cuts = T.fit_bins(rows, names, 32)
    binned = [(tuple(r["bins"]), 1, r["label"]) for r in cuts.of(rows).collect()]
    nodes = T.grow_tree(rows, names, growth, bins=32).collect()
    want = plain_tree(binned, growth, 4)
    assert sorted((r["node"], r["n"], r["p"], names.index(r["feature"]) if r["feature"] else None) for r in nodes) == sorted(want, key=lambda x: x[0])


def test_scores_come_from_the_leaf_that_training_rows_reached(spark, rows):
    nodes = T.grow_tree(rows, COLUMNS)
    scored = T.score(nodes, rows, "id").collect()
    assert len(scored) == 300 and all(r["prediction"] == r["label"] and r["prob"] in (0.0, 1.0) for r in scored)
    empty = T.grow_tree(rows.limit(0), COLUMNS)
    assert empty.count() == 0 and T.score(empty, rows, "id").filter("prob IS NULL").count() == 300


@pytest.mark.parametrize("tries", [None, 2])
def test_large_nodes_over_all_tasks_and_small_ones_in_one_give_the_same_trees(spark, rows, monkeypatch, tries):
    noisy = rows.withColumn("label", F.when(F.col("id") % 6 == 0, 1 - F.col("label")).otherwise(F.col("label"))).withColumn("c", F.when(F.col("id") % 5 > 0, F.col("id") % 9)).withColumn("label", F.when((F.col("id") % 11 > 0) & (F.col("a") < 0.97), F.col("label")))

    def grown():
        return sorted(map(tuple, T.grow_forest(noisy, ["a", "b", "c"], "id", 3, T.Growth(12, 4, 2, tries)).collect()), key=lambda r: r[:2])

    one = grown()
    assert len(one) > 60
    monkeypatch.setattr(T, "LOCAL_ROWS", 60)
    assert grown() == one


def test_a_walk_through_small_pieces_ends_in_the_same_leaves(spark, rows, monkeypatch):
    noisy = rows.withColumn("label", F.when(F.col("id") % 6 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    twice = rows.unionByName(rows.filter("id < 40").withColumn("a", F.lit(None).cast("double")))
    nodes = T.grow_forest(noisy, COLUMNS, "id", 3, T.Growth(12, 4, 1, 1)).cache()
    one = sorted(map(repr, T.score(nodes, twice, "id").collect()))
    monkeypatch.setattr(T, "PIECE", 8)
    assert sorted(map(repr, T.score(nodes, twice, "id").collect())) == one and len(one) == 340


def test_forest_learns_and_importances_sum_to_one(spark, rows):
    nodes = T.grow_forest(rows, COLUMNS, "id", 20, T.Growth(6, 4, 1, 1)).cache()
    assert nodes.select("tree").distinct().count() == 20
    assert T.score(nodes, rows, "id").filter("prediction = label").count() > 270
    shares = {r["feature"]: r["importance"] for r in T.importances(nodes).collect()}
    assert sum(shares.values()) == pytest.approx(1.0) and shares["a"] > shares["b"]


def test_grid_equals_a_growth_for_each_point(spark, rows):
    noisy = rows.withColumn("label", F.when(F.col("id") % 7 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    grid = {"trees": [3, 6], "max_depth": [2, 5], "min_split": [2, 30], "min_leaf": [1, 4]}
    fold = (F.col("id") % 3).cast("int")
    got = {(r["trees"], r["max_depth"], r["min_split"], r["min_leaf"]): r for r in T.forest_grid(noisy, COLUMNS, "id", grid, fold, 3, 1).collect()}
    assert len(got) == 16
    cuts = T.fit_bins(noisy, COLUMNS)
    base = cuts.of(noisy)
    for point in [(3, 2, 30, 4), (6, 5, 2, 1), (6, 5, 30, 4)]:
        trees, depth, split, leaf = point
        place = sorted(grid["min_leaf"]).index(leaf)
        hits = []
        for f in range(3):
            spread = base.filter(fold != f).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("tree", F.col("t") + f * 10_000)
            drawn = draw("bag", F.col("tree"), F.col("id"))
            given = spread.withColumn("n", sum((drawn >= m).cast("bigint") for m in T.poisson_marks())).filter("n > 0")
            given = given.select((F.col("tree") + place * 1_000_000).cast("long").alias("tree"), "bins", "n", (F.col("n") * F.col("label").cast("bigint")).alias("p"))
            nodes = T.grow(given, cuts, T.Growth(depth, split, leaf, 1))
            held = noisy.filter(fold == f)
            hits.append(T.score(nodes, held, "id").agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0])
        assert got[point]["mean_score"] == pytest.approx(sum(hits) / 3)
    ranks = sorted(got.values(), key=lambda r: -r["mean_score"])
    assert ranks[0]["rank"] == 1 and all(a["rank"] <= b["rank"] for a, b in zip(ranks, ranks[1:], strict=False))


def odd_rows(spark, rows):
    """Noisy rows with missing values and labels, repeated and missing ids."""
    noisy = rows.withColumn("label", F.when(F.col("id") % 6 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    gaps = noisy.withColumn("c", F.when(F.col("id") % 5 > 0, F.col("id") % 9)).withColumn("label", F.when((F.col("id") % 11 > 0) & (F.col("a") < 0.97), F.col("label")))
    return gaps.unionByName(gaps.filter("id < 20")).unionByName(gaps.filter("id % 50 = 7").withColumn("id", F.lit(None).cast("int"))).localCheckpoint()


@pytest.mark.parametrize("tries", [None, 2])
def test_a_forest_grown_in_tasks_equals_one_grown_by_levels(spark, rows, monkeypatch, tries):
    given, names = odd_rows(spark, rows), ["a", "b", "c"]
    growth = T.Growth(5, 4, 2, tries)
    with monkeypatch.context() as m:
        m.setattr(T, "HELD_CELLS", 0)
        m.setattr(T, "LOCAL_ROWS", 100)
        want = T.grow_forest(given, names, "id", 3, growth).cache()
        by_levels = sorted(map(tuple, want.collect()), key=lambda r: r[:2])
    monkeypatch.setattr(T, "bagged", None)  # rows are not spread by tree
    got = sorted(map(tuple, T.grow_forest(given, names, "id", 3, growth).collect()), key=lambda r: r[:2])
    assert got == by_levels and len(got) > 50
    packed = T.grow_forest(given, names, "id", 3, growth, packed=True).cache()
    assert packed.count() == 3 and packed.agg(F.sum("nodes")).first()[0] == len(got)
    shares = [{r["feature"]: r["importance"] for r in T.importances(nodes).collect()} for nodes in (want, packed)]
    assert shares[0] == pytest.approx(shares[1])
    asked = given.unionByName(given.limit(3).withColumns({"a": F.lit(math.inf), "b": F.lit(-math.inf), "id": F.lit(999)}))
    monkeypatch.setattr(T, "HELD_NODES", 40)
    assert sorted(map(repr, T.score(packed, asked, "id").collect())) == sorted(map(repr, T.score(want, asked, "id").collect()))
    assert T.score(packed, asked.limit(0), "id").count() == 0


def test_an_empty_forest_scores_nothing(spark, rows):
    packed = T.grow_forest(rows.limit(0), COLUMNS, "id", 3, T.Growth(4, 2, 1, 1), packed=True)
    assert T.score(packed, rows, "id").filter("prob IS NULL").count() == 300 and T.importances(packed).count() == 0


def test_a_grid_grown_in_tasks_equals_one_grown_by_levels(spark, rows, monkeypatch):
    given = odd_rows(spark, rows)
    grid = {"trees": [2, 5], "max_depth": [2, 6], "min_split": [2, 20], "min_leaf": [1, 4]}

    def told():
        found = T.forest_grid(given, ["a", "b", "c"], "id", grid, (draw("fold", F.col("id")) % 3).cast("int"), 3, 2)
        return sorted((r["trees"], r["max_depth"], r["min_split"], r["min_leaf"], round(r["mean_score"], 9), round(r["std_score"], 9), r["rank"]) for r in found.collect())

    with monkeypatch.context() as m:
        m.setattr(T, "HELD_CELLS", 0)
        want = told()
    monkeypatch.setattr(T, "grow", None)  # no tree is stored
    assert told() == want and len(want) == 16


def test_draws_of_a_bag_are_those_of_the_columns(spark):
    texts = ["1", "22", None, "x" * 70, "", "abc"]
    table = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "id string, i int")
    for some in (texts, texts[:3]):
        bag = subtrees.Bag(pa.array(some), T.poisson_marks())
        for tree in (0, 7, 12, 20_399):
            drawn = draw("bag", F.lit(tree), F.col("id"))
            want = [r["n"] for r in table.orderBy("i").select(sum((drawn >= m).cast("int") for m in T.poisson_marks()).alias("n")).collect()]
            assert bag.drawn(tree).tolist() == want[: len(some)]
