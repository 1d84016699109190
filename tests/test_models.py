import hashlib
import math
import random

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from tidemark.operators import clusters, isolation, models


def brute_dbscan(points, eps, m):
    ids = list(points)
    near = {a: [b for b in ids if math.dist(points[a], points[b]) ** 2 <= eps * eps] for a in ids}
    core = {a for a in ids if len(near[a]) >= m}
    label = {}
    for a in sorted(core):
        if a not in label:
            todo = [a]
            label[a] = a
            while todo:
                for n in near[todo.pop()]:
                    if n in core and n not in label:
                        label[n] = a
                        todo.append(n)
    return {a: label[a] if a in core else min((label[n] for n in near[a] if n in core), default=-1) for a in ids}


@pytest.mark.parametrize("dims,seed", [(1, 1), (2, 2), (2, 7), (3, 3)])
def test_density_clusters_against_brute_force(spark, dims, seed):
    rng = random.Random(seed)
    points = {}
    for i in range(150):
        c = rng.choice([0.0, 4.0, 9.0])
        points[i] = tuple(round(c + rng.gauss(0, 0.9), 2) for _ in range(dims))
    for i in range(150, 220):  # one hot point: many copies
        points[i] = (4.0,) * dims
    for i in range(220, 230):  # strays
        points[i] = tuple(rng.uniform(-30, 40) for _ in range(dims))
    cols = [f"c{i}" for i in range(dims)]
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in points.items()], "k int, " + ", ".join(f"{c} double" for c in cols))
    got = {r["k"]: r["group"] for r in clusters.dbscan(df, cols, "k", eps=0.8, min_points=5).collect()}
    assert got == brute_dbscan(points, 0.8, 5)


def blobs(spark, n=300):
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") < 5, 40.0).otherwise((F.col("id") % 2) * 6.0 + F.sin(F.col("id") * 7.0)).alias("a"),
        F.when(F.col("id") < 5, F.col("id") * 20.0).otherwise(F.cos(F.col("id") * 3.0)).alias("b"),
        (F.col("id") % 2).cast("int").alias("class"),
    )


@pytest.mark.parametrize("n", [300, 6000])
def test_isolation_scores_planted_outliers_highest(spark, n):
    df = blobs(spark, n)
    forest = isolation.isolation_fit(df, ["a", "b"], ["k"], trees=20, sample=256, seed=1)
    top = isolation.isolation_score(df, forest, ["a", "b"]).orderBy(F.desc("anomaly_score")).limit(3).collect()
    assert all(r["k"] < 5 for r in top)
    again = isolation.isolation_fit(df.repartition(5), ["a", "b"], ["k"], trees=20, sample=256, seed=1)
    assert sorted(forest.collect()) == sorted(again.collect())


def test_clusters_recover_blobs(spark):
    df = blobs(spark).where("k >= 5")
    model = clusters.cluster_fit(df, ["a", "b"], k=2)
    cells = clusters.cluster_predict(df, model).groupBy("class", "group").count().count()
    assert cells == 2
    _, k = clusters.elbow(df, ["a", "b"], range(2, 7))
    assert 2 <= k <= 6
    assert clusters.gmm(df, ["a", "b"], k=2).select("group").distinct().count() == 2


def test_cross_validation_covers_every_row_once(spark):
    df = blobs(spark).where("k >= 5")
    est = RandomForestClassifier(labelCol="class", featuresCol="features", weightCol="weight", numTrees=5, seed=1)
    oof, imp, metrics = models.cross_validate(df, ["a", "b"], "class", ["k"], est, k=3)
    assert oof.count() == df.count() == oof.select("k").distinct().count()
    assert metrics.count() == 3 and metrics.where("average_precision < 0.9").count() == 0
    best = imp.groupBy("feature").agg(F.avg("importance").alias("v")).orderBy(F.desc("v")).first()["feature"]
    assert best == "a"


def test_shadow_selection_keeps_signal_and_drops_noise(spark):
    df = blobs(spark).where("k >= 5").withColumn("noise", F.rand(3)).withColumn("flat", F.lit(1.0))
    out = {r["feature"]: r["decision"] for r in models.shadow_select(df, ["a", "noise", "flat"], "class", ["k"], rounds=6, trees=8).collect()}
    assert out["a"] == "confirmed" and out["flat"] == "rejected"


def test_stack_scores_and_merges_importance(spark):
    df = blobs(spark).where("k >= 5").withColumn("noise", F.rand(3))
    rf = lambda: RandomForestClassifier(labelCol="class", featuresCol="features", weightCol="weight", numTrees=5, seed=1)
    stack = models.Stack([rf(), rf()], [["a", "noise"], ["b", "noise"]], out_of_fold=2).fit(df, ["k"])
    scored = stack.transform(df)
    assert scored.count() == df.count()
    hit = scored.where((F.col("prob") > 0.5) == (F.col("class") == 1)).count()
    assert hit / df.count() > 0.95
    assert {r["feature"] for r in stack.importance(spark).collect()} == {"a", "b", "noise"}


def test_focal_terms_match_the_formula(spark):
    r = models.focal_terms(spark.createDataFrame([(0.3, 1), (0.3, 0)], "z double, y int"), "z", "y").collect()
    p = 1 / (1 + math.exp(-0.3))
    assert r[0]["der1"] == pytest.approx(-(1 - p) * (2 * math.log(p) * p + p - 1) / p)
    assert r[1]["der1"] == pytest.approx(p * (2 * math.log(1 - p) - p) / (1 - p))


def test_random_search_reports_every_candidate(spark):
    df = blobs(spark).where("k >= 5")
    est = LogisticRegression(labelCol="class", featuresCol="features", weightCol="weight", maxIter=5)
    best, table = models.random_search(df, ["a", "b"], "class", ["k"], {"regParam": lambda g: g.uniform(0, 1)}, n=3, k=2, estimator=est)
    assert table.count() == 3 and best is not None


def test_importance_is_averaged_over_the_models_that_use_a_feature(spark):
    class Fitted:
        def __init__(self, v):
            self.featureImportances = self.coefficients = self
            self.v = v

        def toArray(self):
            return self.v

    stack = models.Stack([None, None], [["a", "b"], ["b", "c"]])
    stack.fitted, stack.top = [Fitted([0.8, 0.2]), Fitted([0.5, 0.1])], Fitted([3.0, 1.0])
    got = {r["feature"]: r["importance"] for r in stack.importance(spark).collect()}
    assert got == {"a": 1.0, "b": pytest.approx((0 * 3 + 1 * 1) / 4), "c": 0.0}


def test_rows_without_a_label_stay(spark):
    df = spark.createDataFrame([(i, [0, 1, 1, None][i % 4]) for i in range(40)], "k int, y int")
    w = {r["y"]: r["weight"] for r in models.class_weights(df, "y").collect()}
    assert w == {0: 1.5, 1: 0.75, None: None} and models.class_weights(df, "y").count() == 40
    cut = models.folds(df, "y", ["k"], 5)
    assert cut.count() == 40 and {(r["y"], r["fold_0"]): r["count"] for r in cut.groupBy("y", "fold_0").count().collect()}[None, 3] == 2


def test_checked_relations_fail_on_scores_that_say_nothing(spark):
    from tidemark.plans.model_check_queries import apart, within

    df = spark.range(400).select((F.col("id") % 4 == 0).alias("yes"), F.lit(0.3).alias("flat"), (F.xxhash64("id") % 1000 / 1000.0).alias("loose"), F.when(F.col("id") % 4 == 0, 0.9).otherwise(0.1).alias("good"))
    row = df.agg(*[apart(F.col(c), F.col("yes"), 0.5).alias(c) for c in ("flat", "loose", "good")], within(F.col("good")).alias("inside"), within(F.when(F.col("yes"), F.col("good"))).alias("gaps")).first()
    assert (row["flat"], row["loose"], row["good"], row["inside"], row["gaps"]) == (False, False, True, True, False)


def test_class_weights_leave_rows_where_they_are(spark):
    """A join by the label would move each class to one task."""
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(4000).repartition(8, "id").select("id", F.when(F.col("id") % 9 > 0, (F.col("id") % 2).cast("int")).alias("y"))
        got = models.class_weights(df, "y").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        assert len(got) == 8 and sum(r["n"] for r in got) == 4000 and max(r["n"] for r in got) < 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_hash_rank_writes_nothing_and_ranks_each_label_by_hash(spark, monkeypatch):
    from tidemark.operators import order

    monkeypatch.setattr(order, "cut_lineage", lambda *a, **k: pytest.fail("written"))
    rows = [(i, None if i % 5 == 0 else i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, y int").repartition(7)
    got = {r["id"]: r["r"] for r in models.hash_rank(df, ["y"], ["id"], 4, "r").collect()}
    want = {}
    for y in (None, 0, 1):
        ids = sorted((i for i, v in rows if v == y), key=lambda i: hashlib.sha1(f"4|{i}".encode()).hexdigest())
        want |= {i: at for at, i in enumerate(ids)}
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 12, 97, 1000])
def test_shadow_rounds_permute_all_places(n):
    rng = random.Random(n)
    for _ in range(20):
        a, b = models._permutation(n, rng)
        assert sorted((a * i + b) % n for i in range(n)) == list(range(n))


def test_shadow_rounds_write_no_copies(spark, monkeypatch):
    """Every row meets one other row's features per round; no round writes the table."""
    from tidemark.operators import order

    monkeypatch.setattr(order, "cut_lineage", lambda *a, **k: pytest.fail("written"))
    df = spark.range(300).selectExpr("id", "cast(id % 2 as int) AS y", "cast(id % 2 as double) AS a", "cast(id % 7 as double) AS b")
    got = {r["feature"]: r["hits"] for r in models.shadow_select(df, ["a", "b"], "y", ["id"], rounds=2, trees=3, depth=2).collect()}
    assert got["a"] == 2


def test_scoring_run_computes_its_matrix_once(spark, monkeypatch):
    from tidemark.plans import flow_queries

    seen = spark.sparkContext.accumulator(0)

    def one(x):
        seen.add(1)
        return x

    rows = spark.range(200).selectExpr("id AS account_id", "date_add(DATE'2000-01-01', cast(id * 2 as int)) AS relevant_date", "cast(id % 2 as int) AS class", "cast(id % 2 as double) AS v")
    kept = F.udf(one, "double").asNondeterministic()
    monkeypatch.setattr(flow_queries, "model_frame", lambda r: rows.withColumn("x", kept("v")).drop("v"))
    out = flow_queries.training_and_scoring_run(spark, "/nowhere").collect()
    assert len(out) == 109 and seen.value == 200


def test_cluster_fit_computes_its_input_once_and_keeps_no_vectors(spark):
    """Scales and all starts share the kept plain features; k-means keeps vectors in its own form."""
    seen = spark.sparkContext.accumulator(0)

    def one(x):
        seen.add(1)
        return x

    kept = F.udf(one, "double").asNondeterministic()
    df = blobs(spark).where("k >= 5").select("k", kept("a").alias("a"), "b")
    gaps = spark.createDataFrame([(1000, None, 0.0), (1001, float("nan"), 1.0)], "k long, a double, b double")
    model = clusters.cluster_fit(df, ["a", "b"], k=2, starts=2)
    assert seen.value == 295
    plain = df.select("k", "b", F.col("a")).unionByName(gaps)
    out = clusters.cluster_predict(plain, model)
    assert out.where("group is null").count() == 2 and out.groupBy("group").count().count() == 3
    with_gaps = clusters.cluster_fit(blobs(spark).where("k >= 5").select("a", "b").unionByName(gaps.drop("k")), ["a", "b"], k=2, starts=2)
    centres = lambda m: [x for c in sorted(map(tuple, m.stages[-1].clusterCenters())) for x in c]
    assert centres(with_gaps) == pytest.approx(centres(model))
