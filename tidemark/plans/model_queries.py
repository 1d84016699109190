"""Model work on the given tables. Where a result is exact, its SQL is given."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from ..operators import clusters, evaluate as ev, isolation, models
from .block_queries import rounded
from .evaluate_queries import _importance, _IMP, _x
from .registry import query
from .roles import Roles, cte

FEATURES = ["quantity", "price", "discount", "tax", "line", "size"]


def frame(r: Roles):
    """Orders with summed lines and a class the features explain in part."""
    y = F.when((F.col("discount") + F.col("tax") > 0.42) & (F.col("class") == 0), 1).otherwise(0)
    dates = r.table("orders").select(F.col("o_orderkey").alias("lead"), F.col("o_orderdate").cast("date").alias("relevant_date"))
    return _x(r).withColumn("class", y).join(dates, "lead")


def small_gbt(label="class"):
    return models.gbt(label, maxIter=8, maxDepth=3)


# ---------------------------------------------------------------- exact results

@query(
    "stratified_folds",
    """SELECT o_orderkey, class, CAST((row_number() OVER (PARTITION BY class ORDER BY sha1('7|' || o_orderkey)) - 1) % 5 AS INTEGER) AS fold_0,
       CAST((row_number() OVER (PARTITION BY class ORDER BY sha1('8|' || o_orderkey)) - 1) % 5 AS INTEGER) AS fold_1
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS class FROM orders)""",
)
def stratified_folds(spark, path):
    df = Roles(spark, path).table("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("class")
    )
    return models.folds(df, "class", ["o_orderkey"], 5, 2, seed=7)


@query(
    "out_of_time_split",
    "SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1999-12-31' THEN 'train' ELSE 'test' END AS part FROM orders",
)
def out_of_time_split(spark, path):
    o = Roles(spark, path).table("orders")
    a, b = models.split_by_date(o, "o_orderdate", "1999-12-31")
    tag = lambda d, t: d.select("o_orderkey", F.lit(t).alias("part"))
    return tag(a, "train").unionByName(tag(b, "test"))


@query(
    "class_weights",
    """SELECT o_orderpriority, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)""",
)
def class_weights(spark, path):
    return rounded(models.class_weight_table(Roles(spark, path).table("orders"), "o_orderpriority"), ["weight"])


_P = "1 / (1 + exp(-z))"


@query(
    "focal_loss_table",
    f"""SELECT event_id, round(w * CASE WHEN y > 0 THEN -(1 - p) * (2 * ln(p) * p + p - 1) / p ELSE p * (2 * ln(1 - p) - p) / (1 - p) END, 6) + 0 AS der1,
        round(w * CASE WHEN y > 0 THEN 2 * (1 - p) * (1 - p) * ((2 * p - 1) * ln(p) + 2 * (p - 1)) ELSE p * (4 * (p - 1) - p) / ((p - 1) * (p - 1)) + 2 * ln(1 - p) END, 6) + 0 AS der2
        FROM (SELECT event_id, y, w, {_P} AS p FROM (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, 1.0::DOUBLE + user_id % 3 AS w, ln(1 + value) - 2 AS z FROM events))""",
)
def focal_loss_table(spark, path):
    e = Roles(spark, path).table("events").select(
        "event_id",
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("y"),
        (F.lit(1.0) + F.col("user_id") % 3).alias("w"),
        (F.log(1 + F.col("value")) - 2).alias("z"),
    )
    return rounded(models.focal_terms(e, "z", "y", "w").select("event_id", "der1", "der2"), ["der1", "der2"])


@query(
    "knee_cut",
    f"""WITH imp AS ({_IMP}), r AS (SELECT fold, importance AS v, row_number() OVER (PARTITION BY fold ORDER BY importance DESC, feature) AS rk, max(importance) OVER (PARTITION BY fold) AS hi,
          min(importance) OVER (PARTITION BY fold) AS lo, count(*) OVER (PARTITION BY fold) AS n FROM imp)
        SELECT fold, CAST(rk AS INTEGER) AS knee FROM (SELECT fold, rk, row_number() OVER (PARTITION BY fold ORDER BY round(1 - CAST(rk - 1 AS DOUBLE) / (n - 1) - (v - lo) / (hi - lo), 12) DESC, rk) AS best FROM r) WHERE best = 1""",
)
def knee_cut(spark, path):
    return models.knee(_importance(Roles(spark, path)), ["fold"], "importance", "feature")


@query(
    "importance_select",
    f"""WITH m AS (SELECT feature, avg(importance) AS a FROM ({_IMP}) GROUP BY 1) SELECT feature, round(a, 6) AS average_importance FROM m WHERE a >= (SELECT quantile_cont(a, 0.5) FROM m)""",
)
def importance_select(spark, path):
    return rounded(models.select_by_importance(_importance(Roles(spark, path))), ["average_importance"])


@query(
    "trial_bins",
    """WITH t AS (SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS c FROM orders),
       e AS (SELECT quantile_cont(o_totalprice, 1.0 / 3) AS a, quantile_cont(o_totalprice, 2.0 / 3) AS b FROM t WHERE c = 1)
       SELECT o_orderkey, CASE WHEN c = 2 THEN 'did trial without call-home' WHEN c = 3 THEN 'did not do trial' WHEN o_totalprice < a THEN 'low' WHEN o_totalprice < b THEN 'medium' ELSE 'high' END AS trial_cat_feature FROM t, e""",
)
def trial_bins(spark, path):
    t = Roles(spark, path).table("orders").select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("trial_cat"),
    )
    edges = models.fit_bins(t.where("trial_cat = 1"), "o_totalprice")
    return models.trial_category(t, models.binned(F.col("o_totalprice"), edges), ["o_totalprice"])


def _plane(r):
    """Two coordinates per vector, on a scale where some points are close."""
    return r.table("embeddings").select(
        "vec_id",
        F.round(F.col("embedding")[0].cast("double") * 40, 3).alias("x"),
        F.round(F.col("embedding")[1].cast("double") * 40, 3).alias("y"),
    )


@query(
    "dbscan",
    """WITH RECURSIVE p AS (SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) * 40, 3) AS x, round(CAST(embedding[2] AS DOUBLE) * 40, 3) AS y FROM embeddings),
       near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.5::DOUBLE * 0.5),
       core AS (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= 5),
       link AS (SELECT a, b FROM near JOIN core c ON c.id = a JOIN core d ON d.id = b),
       reach(src, dst) AS (SELECT a, b FROM link UNION SELECT r.src, l.b FROM reach r JOIN link l ON l.a = r.dst),
       comp AS (SELECT src AS id, min(dst) AS label FROM reach GROUP BY 1),
       edge AS (SELECT n.a AS id, min(label) AS label FROM near n JOIN comp c ON c.id = n.b GROUP BY 1)
       SELECT p.vec_id, coalesce(c.label, e.label, -1) AS "group" FROM p LEFT JOIN comp c ON c.id = p.vec_id LEFT JOIN edge e ON e.id = p.vec_id""",
)
def dbscan(spark, path):
    return clusters.dbscan(_plane(Roles(spark, path)), ["x", "y"], "vec_id", eps=0.5, min_points=5).select("vec_id", "group")


@query(
    "dbscan_vectors",
    """WITH RECURSIVE p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
       near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON list_sum([(t[1] - t[2]) * (t[1] - t[2]) FOR t IN list_zip(a.x, b.x)]) <= 1.17::DOUBLE * 1.17),
       core AS (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= 4),
       link AS (SELECT a, b FROM near JOIN core c ON c.id = a JOIN core d ON d.id = b),
       reach(src, dst) AS (SELECT a, b FROM link UNION SELECT r.src, l.b FROM reach r JOIN link l ON l.a = r.dst),
       comp AS (SELECT src AS id, min(dst) AS label FROM reach GROUP BY 1),
       edge AS (SELECT n.a AS id, min(label) AS label FROM near n JOIN comp c ON c.id = n.b GROUP BY 1)
       SELECT p.vec_id, coalesce(c.label, e.label, -1) AS "group" FROM p LEFT JOIN comp c ON c.id = p.vec_id LEFT JOIN edge e ON e.id = p.vec_id""",
)
def dbscan_vectors(spark, path):
    """Density clusters of whole vectors, in all their dimensions."""
    v = Roles(spark, path).table("embeddings").select("vec_id", "embedding")
    return clusters.dbscan(v, "embedding", "vec_id", eps=1.17, min_points=4).select("vec_id", "group")


# ---------------------------------------------------------------- fitted models (rows and properties)

@query("gbt_cv")
def gbt_cv(spark, path):
    """Per fold: average precision, area, base rate, F1 at 0.25."""
    _, _, metrics = models.cross_validate(
        frame(Roles(spark, path)), FEATURES, "class", ["lead"], small_gbt(), k=3, threshold=0.25, seed=2
    )
    return metrics


@query("gbt_importance")
def gbt_importance(spark, path):
    _, imp, _ = models.cross_validate(frame(Roles(spark, path)), FEATURES, "class", ["lead"], small_gbt(), k=3, seed=2)
    return ev.importance_summary(imp)


def _bases():
    return [
        small_gbt(),
        RandomForestClassifier(labelCol="class", featuresCol="features", weightCol="weight", numTrees=15, maxDepth=5, seed=5),
    ]


@query("stacking")
def stacking(spark, path):
    r = Roles(spark, path)
    train, test = models.split_by_date(frame(r), "relevant_date", "1999-12-31")
    stack = models.Stack(_bases(), [FEATURES, FEATURES], out_of_fold=3).fit(train, ["lead"])
    return stack.transform(test).select("lead", "class", "prob")


@query("stacking_feature_sets")
def stacking_feature_sets(spark, path):
    train = frame(Roles(spark, path))
    stack = models.Stack(_bases(), [["discount", "tax", "line"], ["quantity", "price", "discount"]]).fit(train, ["lead"])
    return stack.importance(spark)


@query("random_search")
def random_search(spark, path):
    space = {
        "maxIter": lambda g: g.choice([3, 5, 8]),
        "maxDepth": lambda g: g.randint(2, 4),
        "stepSize": lambda g: g.uniform(0.05, 0.3),
    }
    _, table = models.random_search(frame(Roles(spark, path)), FEATURES, "class", ["lead"], space, n=3, k=2)
    return table


@query("shadow_feature_select")
def shadow_feature_select(spark, path):
    return models.shadow_select(frame(Roles(spark, path)), FEATURES, "class", ["lead"], rounds=6, trees=10, depth=4)


def _in_out(r):
    return models.split_by_date(frame(r), "relevant_date", "1999-12-31")


@query("adversarial_validation")
def adversarial_validation(spark, path):
    train, test = _in_out(Roles(spark, path))
    _, imp, _ = models.adversarial(train, test, FEATURES, ["lead"], k=2, estimator=small_gbt("is_test"))
    return ev.importance_summary(imp)


@query("similarity_weights")
def similarity_weights(spark, path):
    train, test = _in_out(Roles(spark, path))
    return models.similarity_weights(train, test, FEATURES, ["lead"], k=2, estimator=small_gbt("is_test"))


@query("isolation_forest")
def isolation_forest(spark, path):
    df = frame(Roles(spark, path)).select("lead", *FEATURES)
    forest = isolation.isolation_fit(df, FEATURES, ["lead"], trees=50)
    return isolation.isolation_score(df, forest, FEATURES).select("lead", "anomaly_score")


@query("anomaly_score")
def anomaly_score(spark, path):
    train, test = _in_out(Roles(spark, path))
    _, scored = isolation.anomaly_score(train.drop("class"), test.drop("class"), FEATURES, ["lead"], trees=50)
    return scored.select("lead", "anomaly_score")


@query("trial_scoring")
def trial_scoring(spark, path):
    """Unsupervised trial model fitted on the early leads, its bins reused on the late ones."""
    r = Roles(spark, path)
    df = frame(r).withColumn("trial_cat", F.when(F.col("line") >= 4, 1).when(F.col("line") >= 2, 2).otherwise(3))
    train, test = models.split_by_date(df, "relevant_date", "1999-12-31")
    seen = train.where("trial_cat = 1").select("lead", *FEATURES)
    forest = isolation.isolation_fit(seen, FEATURES, ["lead"], trees=50)
    edges = models.fit_bins(isolation.isolation_score(seen, forest, FEATURES), "anomaly_score")
    late = isolation.isolation_score(test.select("lead", "trial_cat", *FEATURES), forest, FEATURES)
    return models.trial_category(late, models.binned(F.col("anomaly_score"), edges), [*FEATURES, "anomaly_score"])


@query("cluster_feature")
def cluster_feature(spark, path):
    train, test = _in_out(Roles(spark, path))
    model = clusters.cluster_fit(train, FEATURES, k=4, starts=2)
    return clusters.cluster_predict(test.select("lead", *FEATURES), model).select("lead", "group")


@query("trial_cluster_category")
def trial_cluster_category(spark, path):
    train, test = _in_out(Roles(spark, path))
    model = clusters.cluster_fit(train.where("line >= 4"), FEATURES, k=4, starts=2)
    late = test.withColumn("trial_cat", F.when(F.col("line") >= 4, 1).when(F.col("line") >= 2, 2).otherwise(3))
    late = clusters.cluster_category(late.select("lead", "trial_cat", *FEATURES), model)
    return models.trial_category(late, F.col("cluster_category"), [*FEATURES, "cluster_category"])


@query("kmeans_elbow")
def kmeans_elbow(spark, path):
    costs, best = clusters.elbow(_plane(Roles(spark, path)), ["x", "y"], range(2, 8))
    return costs.withColumn("chosen", F.col("k") == best)


@query("gmm")
def gmm(spark, path):
    return clusters.gmm(_plane(Roles(spark, path)), ["x", "y"], max_iter=20).select("vec_id", "group")


@query("score_accounts")
def score_accounts(spark, path):
    """Fit on the past, score the live accounts, list the positives."""
    train, live = _in_out(Roles(spark, path))
    model = small_gbt().fit(models.assemble_vector(models.class_weights(train, "class"), FEATURES))
    scored = models.score_accounts(live.select("lead", *FEATURES), model, FEATURES, 0.5)
    return scored.where("class_pred = 1").select("lead", "class_pred_proba", "class_pred")
