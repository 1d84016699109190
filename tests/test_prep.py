import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import numeric as num
from tidemark.functions import text as tx
from tidemark.operators import leads, prep, versions


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "a,b,want", [(0, 0, 0.0), (0, 5, 1.0), (0, -1, -math.inf), (4, 2, -0.5), (-1, 0, -1.0), (None, 3, 0.0), (2, None, 0.0)]
)
def test_relative_step(spark, a, b, want):
    lit = lambda v: F.lit(v).cast("double")
    assert one(spark, num.relative_step(lit(a), lit(b))) == want


def test_argmax_takes_the_first_on_ties_and_skips_nulls(spark):
    cols = [F.lit(1), F.lit(3), F.lit(3)]
    assert one(spark, num.argmax_name(["a", "b", "c"], cols)) == "b"
    assert one(spark, num.argmax_name(["a", "b"], [F.lit(None).cast("int"), F.lit(-2)])) == "b"


def test_row_std_is_population_and_skips_nulls(spark):
    v = one(spark, num.row_std([F.lit(1.0), F.lit(3.0), F.lit(None).cast("double")]))
    assert v == 1.0


@pytest.mark.parametrize(
    "url,want", [("http://a.b.com/x", "com/x"), ("http://a.b.c.com/x", "com"), ("https://a.b.org/x", "org/x"), ("nodots", None), ("a.b", None), ("a.b.co.uk", "co.uk")]
)
def test_url_domain(spark, url, want):
    assert one(spark, tx.url_domain(F.lit(url))) == want


def test_main_url(spark):
    assert one(spark, tx.main_url(F.lit("https://x.org/a/b"))) == "https://x.org"
    assert one(spark, tx.main_url(F.lit("https://x.org"))) is None
    n = versions.distinct_main_urls_in(F.array(F.lit("http://a/1"), F.lit("http://a/2"), F.lit("b")))
    assert one(spark, n) == 1
    assert one(spark, versions.distinct_main_urls_in(F.lit(None).cast("array<string>"))) == 0


@pytest.mark.parametrize(
    "path,name,kind,token,number",
    [
        ("r/lib-1.2.3.jar", "lib-1.2.3.jar", "jar", "1.2.3.", 1.23),
        ("r/plain", "plain", "no file type", None, 0.0),
        ("r/a12_b34", "a12_b34", "no file type", "12_", 1.2),
        ("r/v7", "v7", "no file type", "7", 0.0),
    ],
)
def test_path_parts(spark, path, name, kind, token, number):
    r = versions.path_parts(spark.createDataFrame([(path,)], "p string"), "p").first()
    assert (r["file_name"], r["file_type"], r["version"], r["version_number"]) == (name, kind, token, number)


def test_version_token_first_on_equal_length(spark):
    assert one(spark, tx.version_token(F.lit("a12b34"))) == "12"


def test_activity_name(spark):
    assert one(spark, tx.activity_name(F.lit("Web.Visits Page Action Change now"))) == "visits page"
    assert one(spark, tx.activity_name(F.lit("Score"))) == "Score"


def test_constant_and_gappy_columns(spark):
    df = spark.createDataFrame([(1, 5, "a", None), (2, 5, None, None)], "x int, c int, s string, z string")
    assert prep.drop_zero_variance(df).columns == ["x", "s"]
    assert prep.drop_zero_variance(df, exempt=["c"]).columns == ["x", "c", "s"]


def test_correlated_counts_dropped_columns_too(spark):
    df = spark.range(200).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"), (F.col("id") * -3).alias("c"), F.rand(1).alias("d"))
    assert prep.correlated(df, ["a", "b", "c", "d"], 0.9) == ["b", "c"]


def test_outliers_constant_column_and_kept_scores(spark):
    df = spark.createDataFrame([(float(i), 1.0, None) for i in range(30)] + [(1e6, 1.0, 3.0), (2e6, 1.0, None)], "x double, k double, csat double")
    assert prep.remove_outliers(df, ["x", "k"]).count() == 31
    assert prep.remove_outliers(df, ["x", "k"], "csat", keep_scored=True).count() == 31
    narrow = df.where("x < 2e6")
    assert prep.remove_outliers(narrow, ["x", "k"]).count() == 30
    assert prep.remove_outliers(narrow, ["x", "k"], "csat", keep_scored=True).count() == 31


def test_multiplicity_with_nulls_and_a_hot_point(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(2, 5)] * 400, "x int, y int")
    got = {r["point_size"]: r["count"] for r in prep.multiplicity(df, "x", "y").groupBy("point_size").count().collect()}
    assert got == {6: 3, 800: 400}
    tall = spark.range(30000).select(F.when(F.col("id") % 3 < 2, 1.5).alias("x"), F.lit(-0.0).alias("y"), "id")
    out = prep.multiplicity(tall, "x", "y", 1)
    assert out.columns == ["x", "y", "id", "point_size"]
    assert {(r["x"], r["point_size"]): r["count"] for r in out.groupBy("x", "point_size").count().collect()} == {(1.5, 20000): 20000, (None, 10000): 10000}


def test_activity_pivot_threshold_and_closed_list(spark):
    rows = [(1, "a.Social Like Action Change")] * 11 + [(2, "social like")] * 2 + [(2, "score")] * 20 + [(3, "other")] * 20 + [(2, "social share post")] * 10
    df = spark.createDataFrame([(k, r, i, 0 if k < 3 else 1) for i, (k, r) in enumerate(rows)], "lead int, reason string, activity_date int, class int")
    out = leads.activity_pivot(df, ["lead"])
    assert set(out.columns) == {"lead", "class", "CS-social like"}
    assert {r["lead"]: r["CS-social like"] for r in out.collect()} == {1: 11, 2: 2, 3: 0}


def test_unseen_categories_get_their_own_index(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "s string")
    got = prep.encode(train, ["s"]).transform(spark.createDataFrame([("b",), ("a",), ("zz",)], "s string"))
    assert [r["s_idx"] for r in got.collect()] == [0.0, 1.0, 3.0]


def brute_weekly(rows):
    """The row loop, as a check on small input."""
    rows = sorted(rows)
    seen, out, prev = {}, {}, None
    for i, (module, date, tie, name, kind, v) in enumerate(rows):
        seen.setdefault(module, set()).add(name)
        week = (date.day - 1) // 7 + 1
        if not (i == 0 or module == "" or date.day > 28 or kind == "xml"):
            cell = out.get((module, week))
            if cell is None:
                cell = out[module, week] = [0, 0, 0, 0, 0]
            elif prev[0] == module:
                cell[0] += v > prev[5]
                cell[1] += v == prev[5]
            cell[2] += "release" in module.lower()
            cell[3] += "snapshot" in module.lower()
            cell[4] = len(seen[module])
        prev = rows[i]
    return {k: tuple(v) for k, v in out.items()}


def test_weekly_versions_against_the_row_loop(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        m = rng.choice(["hot"] * 6 + ["", "My-Release", "x-SNAPSHOT", "rare"])
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(90))
        rows.append((m, day, i, f"f{rng.randrange(30)}", rng.choice(["jar", "jar", "xml"]), float(rng.randrange(4))))
    df = spark.createDataFrame(rows, "module_name string, date date, tie int, file_name string, file_type string, version_num_value double")
    got = {
        (r["module_name"], r["week_num"]): tuple(
            r[c] for c in ("versioning_up_count", "versioning_stuck_count", "is_release", "is_snapshot", "files_per_module")
        )
        for r in versions.weekly_versions(df, ["tie"]).collect()
    }
    assert got == brute_weekly(rows)


@pytest.mark.parametrize("width", [2, 30, 31, 70, 150])
def test_correlations_follow_one_rule_at_every_width(spark, width):
    """Gaps are skipped pair by pair, whatever the number of columns; a column without spread has no r."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(60, width)) + 1e6
    x[:, 1] = x[:, 0] * -2 + rng.normal(size=60) * 0.01
    x[rng.random(x.shape) < 0.2] = np.nan
    if width > 2:
        x[:, 2] = 7.0
    rows = [[None if np.isnan(v) and rng.random() < 0.5 else float(v) for v in r] for r in x]
    cols = [f"c {i}" for i in range(width)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in cols)).repartition(3)
    got = {(r["a"], r["b"]): r["r"] for r in prep.correlations(df, cols).collect()}
    want = pd.DataFrame(x, columns=cols).corr()
    assert len(got) == width * (width - 1) // 2
    for (a, b), r in got.items():
        assert (r is None and want.at[a, b] != want.at[a, b]) or r == pytest.approx(want.at[a, b], abs=1e-6)
    assert prep.drop_by_correlation(df, cols, 0.95).columns == [c for c in cols if c != "c 1"]


def test_correlations_of_500_columns(spark):
    df = spark.range(400).select(*[F.rand(i).alias(f"c{i}") for i in range(250)]).select("*", *[(F.col(f"c{i}") * 3 - 1).alias(f"d{i}") for i in range(250)])
    assert prep.correlated(df, df.columns, 0.9) == [f"d{i}" for i in range(250)]


def test_correlations_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert prep.correlations(df, ["a", "b"]).count() == 0 and prep.correlations(df, ["a"]).count() == 0
    gaps = spark.createDataFrame([(None, 1.0)] * 3, "a double, b double")
    assert [tuple(r) for r in prep.correlations(gaps, ["a", "b"]).collect()] == [("a", "b", None)]


def test_a_label_for_every_row_is_indexed_without_the_driver(spark):
    train = spark.range(5000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("s"), F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y").alias("t"))
    e = prep.encode(train.unionByName(train.where("s = 'v00042'")), ["s", "t"])
    got = {r["s"]: (r["s_idx"], r["t_idx"]) for r in e.transform(train.unionByName(spark.createDataFrame([("new", "zz")], "s string, t string"))).collect()}
    assert got["v00042"][0] == 0.0 and got["v00000"][0] == 1.0 and got["v04999"][0] == 4999.0
    assert got["new"] == (5000.0, 2.0) and got["v00002"][1] == 2.0 and {got["v00000"][1], got["v00001"][1]} == {0.0, 1.0}
    assert sorted(v[0] for k, v in got.items() if k != "new") == [float(i) for i in range(5000)]
