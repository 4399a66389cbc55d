import datetime
import random

import numpy as np
from pyspark.sql import functions as F

from kerbside.functions import scalars as S
from kerbside.functions.draws import chance, draw
from kerbside.functions.quantiles import quantiles, value_ranks
from kerbside.functions.running import numbered, overlap_join, running_total
from kerbside.operators import fleet, summaries, traffic


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_bands_are_strict_and_missing_is_free_flow(spark):
    values = [None, float("nan"), 275.0, 275.5, 300.0, 300.5, 325.0, 326.0, 350.0, 350.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r["m"] for r in df.select("i", S.traffic_multiplier(F.col("v")).alias("m")).orderBy("i").collect()]
    assert got == [1.0, 1.0, 1.0, 1.05, 1.05, 1.1, 1.1, 1.25, 1.25, 1.5]


def test_day_rules_of_two_known_trucks(spark):
    rows = [(299, "6/4/2023", "14/1/2026"), (1378, "12/5/2023", "18/5/2024")]
    df = spark.createDataFrame(rows, "Truck_ID int, Last_Service_Date string, Warranty_Expiry_Date string")
    out = fleet.with_day_counts(fleet.parsed_dates(df), "2024-10-26").orderBy("Truck_ID").collect()
    assert [(r[fleet.SINCE_SERVICE], r[fleet.WARRANTY_LEFT]) for r in out] == [(569, 444), (533, -162)]


def test_level_codes_and_flags(spark):
    df = spark.createDataFrame([("Worn Out",), ("New",), ("worn",), (None,)], "v string")
    codes = df.select(S.level_code(F.col("v"), S.CONDITION_LEVELS["Tire_Condition"]).alias("c")).collect()
    assert [r["c"] for r in codes] == [0, 2, -1, -1]
    flags = spark.createDataFrame([("Manual",), ("Automatic",), (None,)], "t string").select(
        *S.level_flags("t", F.col("t"), fleet.TRANSMISSIONS)
    )
    assert flags.columns == ["t_Manual"] and [r[0] for r in flags.collect()] == [True, False, False]


def test_one_level_batch_still_has_the_flag(spark):
    df = spark.createDataFrame([("Automatic",)], "Transmission_Type string")
    assert fleet.with_transmission_flag(df).first()[fleet.MANUAL] is False


def test_speed_and_minutes(spark):
    row = one(
        spark,
        S.speed_limit(F.lit(None).cast("array<string>")).alias("missing"),
        S.speed_limit(F.array(F.lit("60"), F.lit("50"))).alias("listed"),
        S.edge_minutes(F.lit(0.0), F.lit(40)).alias("zero"),
        S.edge_minutes(F.lit(1000.0), F.lit(60)).alias("km"),
    )
    assert (row["missing"], row["listed"], row["zero"]) == (40, 50, 0.0)
    assert abs(row["km"] - 1.0) < 1e-12


def test_scaling_keeps_values_outside_the_fit_and_flattens_constants(spark):
    fit = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "a double, b double")
    new = spark.createDataFrame([(15.0, 7.0)], "a double, b double")
    out = traffic.scale_columns(new, traffic.fit_scaler(fit, ["a", "b"]), ["a", "b"]).first()
    assert (out["a"], out["b"]) == (1.5, 0.0)


def test_text_and_capacity(spark):
    row = one(
        spark, S.route_text(F.array(F.lit("A"), F.lit("B"))).alias("r"), S.first_word(F.lit("SWTE -> X")).alias("w"),
        S.truck_capacity(F.lit(7)).alias("c"), S.slot_label(F.lit(datetime.datetime(2024, 1, 2, 3))).alias("s"),
    )
    assert tuple(row) == ("A -> B", "SWTE", 14000, "2024-01-02 03:00:00")


def test_draws_do_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    first = {r["id"]: r["d"] for r in df.select("id", draw("s", F.col("id")).alias("d")).collect()}
    second = {r["id"]: r["d"] for r in df.repartition(7).select("id", draw("s", F.col("id")).alias("d")).collect()}
    assert first == second and len(set(first.values())) > 990
    hits = df.filter(chance("s", 0.3, F.col("id"))).count()
    assert 230 < hits < 370


def test_running_total_with_one_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(20)}", i, rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i int, v int")
    out = running_total(df, F.col("v"), ["i"], F.floor(F.col("i") / 50), ["g"]).collect()
    expected, sums = {}, {}
    for g, i, v in rows:
        expected[i] = sums.get(g, 0)
        sums[g] = expected[i] + v
    assert {r["i"]: r["before"] for r in out} == expected
    numbers = sorted(r["ordinal"] for r in numbered(df, ["i"], F.floor(F.col("i") / 50)).collect())
    assert numbers == list(range(3000))


def test_overlap_join_against_all_pairs(spark):
    rng = random.Random(2)

    def ranges(tag, n):
        lo, out = 0, []
        for i in range(n):
            hi = lo + rng.choice([0, 1, 3, 40])
            out.append((f"{tag}{i}", lo, hi))
            lo = hi
        return out

    a, b = ranges("a", 60), ranges("b", 80)
    left = spark.createDataFrame(a, "x string, lo bigint, hi bigint")
    right = spark.createDataFrame(b, "y string, lo bigint, hi bigint")
    got = sorted((r["x"], r["y"], r["lo"], r["hi"]) for r in overlap_join(left, right, [], 7).collect())
    want = sorted(
        (x, y, max(l1, l2), min(h1, h2)) for x, l1, h1 in a for y, l2, h2 in b if max(l1, l2) < min(h1, h2)
    )
    assert got == want


def test_quantiles_equal_numpy_with_heavy_ties(spark):
    rng = random.Random(3)
    data = {
        "ties": [5.0] * 700 + [rng.random() for _ in range(300)],
        "crowded": [rng.gauss(0, 1e-3) for _ in range(999)] + [1e9],
        "single": [2.0],
        "pair": [1.0, 4.0],
    }
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "col string, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for r in quantiles(df, "col", "value", probs).collect():
        want = np.quantile(data[r["col"]], r["prob"])
        assert abs(r["quantile"] - want) <= 1e-9 * max(1, abs(want)), r


def test_value_ranks_are_dense_over_counts(spark):
    df = spark.createDataFrame([("a", float(i % 13)) for i in range(500)], "by string, v double")
    out = sorted((r["v"], r["before"], r["n"]) for r in value_ranks(df, "by", "v").collect())
    total = 0
    for _, before, n in out:
        assert before == total
        total += n
    assert total == 500


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(11)], "a double, c double")
    out = {(r["col"], r["bin"]): r["n"] for r in summaries.histograms(df, ["a", "c"], 10).collect()}
    assert out[("a", 10)] == 2 and out[("a", 1)] == 1 and out[("c", 6)] == 11


def test_report_of_a_class_never_predicted(spark):
    counts = spark.createDataFrame([(1, 0, 3), (0, 0, 5)], "label int, prediction int, n bigint")
    out = {r["row"]: r for r in summaries.classification_report(counts).collect()}
    assert out["1"]["precision"] == 0.0 and out["1"]["recall"] == 0.0 and out["1"]["support"] == 3
    assert abs(out["accuracy"]["f1"] - 5 / 8) < 1e-12


def test_auc_with_ties_equals_pair_counting(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(2), rng.randrange(12) / 4) for _ in range(400)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, score double")
    assert abs(summaries.auc(df).first()["auc"] - want) < 1e-12
