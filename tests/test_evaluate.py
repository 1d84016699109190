import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluate as ev
from tidemark.operators import models, order


@pytest.fixture(params=["true", "false"], ids=["few stretches", "many stretches"])
def size(request, spark):
    """Small stretches are joined by the adaptive plan, or left as they are."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.unset(name)


def test_running_totals_equal_a_global_window(spark, size):
    rng = random.Random(1)
    rows = [(g, v, rng.randrange(9)) for g in ("a", "b") for v in rng.sample(range(1000), 300 if g == "a" else 3)]
    df = spark.createDataFrame(rows, "g string, v int, x int")
    for desc in (False, True):
        got = {(r["g"], r["v"]): r["x__cum"] for r in order.running_totals(df, ["g"], "v", ["x"], desc).collect()}
        for g, v, _ in rows:
            assert got[g, v] == sum(x for h, w, x in rows if h == g and (w >= v if desc else w <= v))


def test_null_groups_are_groups(spark, size):
    df = spark.createDataFrame([(None, float(i)) for i in range(5)] + [("b", 2.0)] * 7 + [("b", None)], "g string, v double")
    cum = {(r["g"], r["v"]): r["n__cum"] for r in order.running_totals(df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")), ["g"], "v", ["n"]).collect()}
    assert cum[None, 3.0] == 4 and cum["b", 2.0] == 8
    got = {r["g"]: r for r in order.exact_quantiles(df, ["g"], "v", {"mid": 0.5}).collect()}
    assert got[None]["mid"] == 2.0 and got["b"]["n"] == 7
    prof = {(r["g"], r["feature"]): (r["median"], r["members"]) for r in ev.cluster_profile(df, ["v"], "g", 1).collect()}
    assert prof == {(None, "v"): (2.0, 5), ("b", "v"): (2.0, 8)}
    pts = ev.pr_points(df.select(F.lit(1).alias("y"), F.col("v").alias("s"), "g"), "y", "s", ["g"]).where("g IS NULL")
    assert pts.count() == 5


def test_ranks_number_every_row_once(spark, size):
    rng = random.Random(4)
    rows = [(rng.choice(["a", None, "c"]), i, rng.randrange(10)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, x int")
    got = {(r["g"], r["k"]): r["at"] for r in order.ranks(df, ["g"], [F.desc("x"), F.asc("k")], "at").collect()}
    for g in ("a", None, "c"):
        mine = sorted((-x, k) for h, k, x in rows if h == g)
        assert [got[g, k] for _, k in mine] == list(range(len(mine)))
    assert order.ranks(df, [], [F.asc("k")], "at").where("at = k").count() == 500
    assert order.ranks(df.where("false"), ["g"], [F.asc("k")], "at").count() == 0


def test_exact_quantiles_interpolate(spark, size):
    df = spark.createDataFrame([("a", float(i)) for i in range(5)] + [("b", 2.0)] * 7 + [("c", None)], "g string, v double")
    got = {r["g"]: r for r in order.exact_quantiles(df, ["g"], "v", {"lo": 0.33, "mid": 0.5}).collect()}
    assert got["a"]["lo"] == pytest.approx(1.32) and got["a"]["mid"] == 2.0 and got["a"]["n"] == 5
    assert got["b"]["lo"] == 2.0 and "c" not in got


def test_pr_curve_with_ties_and_one_class(spark, size):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    pts = {r["threshold"]: (r["precision"], r["recall"]) for r in ev.pr_points(df, "y", "s").collect()}
    assert pts == {0.9: (0.5, 0.5), 0.5: (2 / 3, 1.0), 0.1: (0.5, 1.0)}
    r = ev.pr_summary(df, "y", "s").first()
    assert r["average_precision"] == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3) and r["base_rate"] == 0.5
    none = ev.pr_summary(df.where("y = 0"), "y", "s").first()
    assert none["average_precision"] == 0.0 and none["base_rate"] == 0.0


def test_confusion_has_four_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    assert {r["cell"]: r["n"] for r in ev.confusion(df, "y", "p").collect()} == {"True Neg": 0, "False Pos": 0, "False Neg": 0, "True Pos": 2}


def test_drift_finds_only_the_shifted_column(spark, size):
    a = spark.range(400).select(F.rand(1).alias("same"), F.randn(2).alias("moved"))
    b = spark.range(300).select(F.rand(3).alias("same"), (F.randn(4) + 1).alias("moved"))
    assert [r["feature"] for r in ev.ks_drift(a, b, ["same", "moved"]).collect()] == ["moved"]
    t = {r["feature"]: r for r in ev.ks_table(a, a, ["same"]).collect()}
    assert t["same"]["statistic"] == 0.0 and t["same"]["p"] == 1.0


def test_kolmogorov_p_at_known_values(spark):
    # with 20,000 rows on each side t is 100 d; values of the published table
    known = {0.0: 1.0, 0.001: 1.0, 0.003: 0.9999906941, 0.005: 0.9639452436, 0.01: 0.2699996717, 0.015: 0.0222179626, 0.1: 0.0}
    df = spark.createDataFrame([(d, 20000.0) for d in known], "d double, n double")
    got = {r["d"]: r["p"] for r in df.select("d", ev.kolmogorov_p(F.col("d"), F.col("n"), F.col("n")).alias("p")).collect()}
    assert got == pytest.approx(known, abs=1e-9)


def test_top_contributions_text(spark):
    con = spark.createDataFrame([(1, 3.0, -2.0, 0.0), (2, 1.0, 2.0, -1.0), (3, 0.5, 0.1, 0.2)], "k int, a double, b double, s double")
    val = spark.createDataFrame([(1, 1, 9, "x"), (2, 2, 5, "y"), (3, 3, 1, "z")], "k int, a int, b int, s string")
    got = {(r["k"], r["feature"]): r["feature_value"] for r in ev.top_contributions(con, val, "k", ["a", "b", "s"], n=1).collect()}
    assert got[1, "a"] == "1" + ev.LOW and got[1, "b"] == "9" + ev.HIGH
    assert got[2, "b"] == "5" + ev.MIDDLE and got[2, "s"] == "y" and (1, "s") not in got


def test_effect_sides(spark, size):
    df = spark.createDataFrame([("f", 1.0), ("f", 3.0), ("f", -1.0), ("f", -5.0), ("f", 0.0)], "feature string, contribution double")
    got = {r["contribution"]: r["level_of_effect"] for r in ev.effect_strength(df).collect()}
    assert got == {1.0: "weak", 3.0: "strong", -1.0: "weak", -5.0: "strong", 0.0: "weak"}


def test_hash_rank_is_a_permutation_and_folds_are_even(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    r = models.hash_rank(df, ["y"], ["id"], 3, "r").groupBy("y").agg(F.count_distinct("r").alias("n"), F.max("r").alias("m")).collect()
    assert {(x["y"], x["n"], x["m"]) for x in r} == {(0, 900, 899), (1, 100, 99)}
    f = models.folds(df, "y", ["id"], 5, 1, 0).groupBy("fold_0").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    assert {(x["p"], x["n"]) for x in f} == {(20, 200)}


def test_bin_edges_belong_to_the_upper_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(7)], "s double")
    edges = models.fit_bins(df, "s")
    assert edges == [2.0, 4.0]
    got = [r["b"] for r in df.orderBy("s").select(models.binned(F.col("s"), edges).alias("b")).collect()]
    assert got == ["low"] * 2 + ["medium"] * 2 + ["high"] * 3


def test_knee(spark):
    df = spark.createDataFrame([(f"f{i}", v) for i, v in enumerate([100.0, 40.0, 10.0, 9.0, 8.0, 7.0])], "f string, v double")
    assert models.knee(df, [], "v", "f").first()["knee"] == 3
