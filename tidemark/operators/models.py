"""Model work on Spark ML: folds, weights, cross-validation, stacking, selection, scoring."""

from __future__ import annotations

import math
import random
from typing import Callable, Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import evaluate as ev
from .order import exact_quantiles

#: Bits of a hash that name its stretch in `hash_rank`.
STRETCH_BITS = 12


def hash_rank(df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, name: str) -> DataFrame:
    """0-based rank by SHA-1 of (seed, key) within `by`, as one global row_number would give.

    Hashes are spread evenly, so their first digits cut every label, however large, into stretches of
    equal size without a sample: rows are counted by stretch, moved once, and ranked inside it. Nothing
    is written. A null label is a label.
    """
    h = F.unhex(F.sha1(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])))
    # a struct equals another with nulls in the same places
    placed = df.withColumns({"g__": F.struct(F.lit(0).alias("all__"), *[F.col(f"`{c}`") for c in by]), "h__": h})
    placed = placed.withColumn("s__", F.shiftright(F.conv(F.hex(F.substring("h__", 1, 2)), 16, 10).cast("int"), 16 - STRETCH_BITS))
    earlier = Window.partitionBy("g__").orderBy("s__").rowsBetween(Window.unboundedPreceding, -1)  # a row per stretch
    before = placed.groupBy("g__", "s__").agg(F.count(F.lit(1)).alias("n__"))
    before = before.select("g__", "s__", F.coalesce(F.sum("n__").over(earlier), F.lit(0)).alias("o__"))
    at = F.row_number().over(Window.partitionBy("g__", "s__").orderBy("h__"))
    out = placed.withColumn("at__", at).drop("h__").join(before, ["g__", "s__"])
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("at__") - 1 + F.col("o__")).alias(name))


def folds(df: DataFrame, label: str, key: Sequence[str], k: int = 5, repeats: int = 1, seed: int = 0) -> DataFrame:
    """Repeated stratified k-fold assignment in columns fold_0, fold_1, ..."""
    for r in range(repeats):
        df = hash_rank(df, [label], key, seed + r, "rank__").withColumn(
            f"fold_{r}", (F.col("rank__") % k).cast("int")
        ).drop("rank__")
    return df


def split_by_date(df: DataFrame, date: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Train on or before the cut day, test after it."""
    day = F.lit(cut).cast("date")
    return df.where(F.col(date).cast("date") <= day), df.where(F.col(date).cast("date") > day)


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class), over the rows with a label."""
    n = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # one row per class
    return n.select(
        label,
        "n",
        (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"),
    )


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """`df` with its class's weight; a row without a label stays, without a weight.

    The table has a row per class and goes to every task: a join by the label would give each class
    to a single task.
    """
    table = class_weight_table(df, label).select(label, F.col("weight").alias(name))
    return df.join(F.broadcast(table), label, "left")


def assemble_vector(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def probability(scored: DataFrame, name: str = "prob") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")


def gbt(label: str = "class", weight: str | None = "weight", seed: int = 5, **kw) -> GBTClassifier:
    est = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **kw)
    return est.setWeightCol(weight) if weight else est


def importance_rows(spark, features: Sequence[str], per_fold: Mapping[int, Sequence[float]]) -> DataFrame:
    rows = [(f, int(i), float(v[j])) for i, v in per_fold.items() for j, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, fold int, importance double")


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    estimator: Estimator | None = None,
    k: int = 5,
    threshold: float = 0.5,
    seed: int = 0,
    balanced: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fit k models; return out-of-fold probabilities, importances and fold metrics.

    The folded, assembled frame is kept (memory and disk) for the k fits. Only
    importances (features x folds) reach the driver.
    """
    # ranking and weighting pass over the input several times: compute it once
    df = df.select(*key, label, *features).persist()
    base = folds(df, label, key, k, 1, seed)
    base = class_weights(base, label) if balanced else base.withColumn("weight", F.lit(1.0))
    base = assemble_vector(base, features).select(*key, label, "weight", "fold_0", "features").persist()
    est = estimator or gbt(label)
    parts, imp = [], {}
    for i in range(k):
        model = est.fit(base.where(F.col("fold_0") != i))
        if hasattr(model, "featureImportances"):
            imp[i] = model.featureImportances.toArray()
        parts.append(probability(model.transform(base.where(F.col("fold_0") == i))))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    oof = oof.withColumnRenamed("fold_0", "fold").drop("features")
    metrics = ev.pr_summary(oof, label, "prob", ["fold"]).join(
        ev.f1_at(oof, label, "prob", threshold, ["fold"]).select("fold", "f1"), "fold"
    )
    importance = importance_rows(df.sparkSession, features, imp)
    return oof, importance, metrics


def focal_terms(df: DataFrame, score: str, label: str, weight: str | None = None, gamma: float = 2.0) -> DataFrame:
    """First and second derivative of the focal loss per row, from the raw score."""
    p = 1 / (1 + F.exp(-F.col(score).cast("double")))
    q, g = 1 - p, F.lit(float(gamma))
    up1 = -F.pow(q, g - 1) * (g * F.log(p) * p + p - 1) / p
    up2 = g * F.pow(q, g) * ((g * p - 1) * F.log(p) + 2 * (p - 1))
    dn1 = F.pow(p, g - 1) * (g * F.log(q) - p) / q
    dn2 = F.pow(p, g - 2) * (p * (2 * g * (p - 1) - p) / F.pow(p - 1, F.lit(2.0)) + (g - 1) * g * F.log(q))
    w = F.lit(1.0) if weight is None else F.col(weight)
    y = F.col(label) > 0
    return df.select("*", (F.when(y, up1).otherwise(dn1) * w).alias("der1"), (F.when(y, up2).otherwise(dn2) * w).alias("der2"))


class Stack:
    """Base models, each on its own features, under a balanced logistic regression.

    out_of_fold=k trains the top on out-of-fold probabilities; None on fitted ones.
    """

    def __init__(
        self,
        models: Sequence[Estimator],
        feature_sets: Sequence[Sequence[str]],
        final: LogisticRegression | None = None,
        label: str = "class",
        out_of_fold: int | None = None,
        seed: int = 0,
    ):
        self.models, self.feature_sets, self.label = list(models), [list(f) for f in feature_sets], label
        self.final = final or LogisticRegression(labelCol=label, featuresCol="stack", weightCol="weight")
        self.out_of_fold, self.seed = out_of_fold, seed
        self.fitted: list[Model] = []
        self.top: Model | None = None

    def _add(self, df: DataFrame, models: Sequence[Model]) -> DataFrame:
        for i, (m, feats) in enumerate(zip(models, self.feature_sets)):
            df = probability(m.transform(assemble_vector(df, feats)), f"p{i}").drop("features")
        return assemble_vector(df, [f"p{i}" for i in range(len(models))], "stack")

    def _fit_bases(self, df: DataFrame) -> list[Model]:
        return [m.fit(assemble_vector(df, f)) for m, f in zip(self.models, self.feature_sets)]

    def fit(self, df: DataFrame, key: Sequence[str]) -> "Stack":
        base = class_weights(df.persist(), self.label).persist()
        self.fitted = self._fit_bases(base)
        if self.out_of_fold is None:
            held = self._add(base, self.fitted)
        else:
            k = self.out_of_fold
            cut = folds(base, self.label, key, k, 1, self.seed).persist()
            held = None
            for i in range(k):
                part = self._add(cut.where(F.col("fold_0") == i), self._fit_bases(cut.where(F.col("fold_0") != i)))
                held = part if held is None else held.unionByName(part)
        self.top = self.final.fit(held)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = probability(self.top.transform(self._add(df, self.fitted)))
        return out.drop("stack")

    def importance(self, spark) -> DataFrame:
        """Min-max scaled base importances, averaged with the top's weights over the models that use
        the feature: one that does not use it says nothing about it."""
        w = self.top.coefficients.toArray()
        rows = []
        for i, (m, feats) in enumerate(zip(self.fitted, self.feature_sets)):
            imp = m.featureImportances.toArray()
            lo, hi = float(min(imp)), float(max(imp))
            rows += [(f, float((v - lo) / ((hi - lo) or 1.0)), float(w[i])) for f, v in zip(feats, imp)]
        parts = spark.createDataFrame(rows, "feature string, scaled double, weight double")
        weighted = F.sum(F.col("scaled") * F.col("weight")) / F.sum("weight")
        return parts.groupBy("feature").agg(F.when(F.sum("weight") != 0, weighted).otherwise(F.avg("scaled")).alias("importance"))


def random_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    space: Mapping[str, Callable[[random.Random], object]],
    n: int = 25,
    k: int = 3,
    seed: int = 42,
    estimator: Estimator | None = None,
    parallelism: int = 4,
) -> tuple[Model, DataFrame]:
    """n sampled parameter sets, k stratified folds, best by area under the PR curve.

    Returns the refitted best model and one row per set with its mean score.
    """
    est = estimator or gbt(label)
    rng = random.Random(seed)
    sets = [{name: draw(rng) for name, draw in space.items()} for _ in range(n)]
    maps = [{est.getParam(name): v for name, v in s.items()} for s in sets]
    df = df.select(*key, label, *features).persist()
    base = class_weights(folds(df, label, key, k, 1, seed), label)
    base = assemble_vector(base, features).select(label, "weight", "features", F.col("fold_0").alias("fold")).persist()
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=maps, evaluator=judge, numFolds=k, foldCol="fold", parallelism=parallelism, seed=seed
    ).fit(base)
    rows = [(i, repr(sorted(s.items())), float(m)) for i, (s, m) in enumerate(zip(sets, cv.avgMetrics))]
    base.unpersist()
    df.unpersist()
    return cv.bestModel, df.sparkSession.createDataFrame(rows, "candidate int, params string, score double")


def knee(curve: DataFrame, group: Sequence[str], value: str, tie: str) -> DataFrame:
    """Rank at which a falling convex curve bends most: largest distance below its chord.

    Curves are ranked feature lists or costs per k, so a group is short.
    """
    w = Window.partitionBy(*group).orderBy(F.desc(value), tie)
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = curve.select(
        *group,
        F.row_number().over(w).alias("rank"),
        F.col(value).alias("v"),
        F.first(value).over(full).alias("hi"),
        F.last(value).over(full).alias("lo"),
        F.count(F.lit(1)).over(full).alias("n"),
    )
    x = F.when(F.col("n") > 1, (F.col("rank") - 1) / (F.col("n") - 1)).otherwise(F.lit(0.0))
    y = F.when(F.col("hi") > F.col("lo"), (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(F.lit(0.0))
    gap = F.round(1 - x - y, 12)
    return r.groupBy(*group).agg(F.max_by("rank", F.struct(gap, -F.col("rank"))).alias("knee"))


def select_by_importance(importance: DataFrame, rule: str = "median") -> DataFrame:
    """Features at or above the median importance, or the top ones up to the knee."""
    mean = ev.importance_summary(importance)
    if rule == "median":
        mid = exact_quantiles(mean, [], "average_importance", {"m": 0.5}).select("m")
        cut = mid.first()["m"]
        return mean.where(F.col("average_importance") >= F.lit(cut))
    k = knee(mean, [], "average_importance", "feature").first()["knee"]
    return mean.orderBy(F.desc("average_importance"), "feature").limit(int(k))


def binomial_tail(hits: int, n: int) -> float:
    """P(X >= hits) for n fair draws."""
    return sum(math.comb(n, i) for i in range(hits, n + 1)) / 2**n


def _permutation(n: int, rng: random.Random) -> tuple[int, int]:
    """a and b of a permutation a * i + b modulo n; the products fit in a long up to 2^42 rows."""
    a = rng.randrange(1, max(2, min(n, 1 << 20)))
    while math.gcd(a, n) > 1:
        a = rng.randrange(1, max(2, min(n, 1 << 20)))
    return a, rng.randrange(max(n, 1))


def shadow_select(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    rounds: int = 10,
    alpha: float = 0.05,
    seed: int = 0,
    trees: int = 20,
    depth: int = 5,
) -> DataFrame:
    """Features that beat the best shuffled copy often enough; -1 labels are left out.

    The rows are put in the random order of a hash rank, once, and kept there. A round gives the
    features of the row at place i to the row at place a * i + b modulo the number of rows, with a
    and b drawn for the round: a permutation that cuts the copies from the label and moves
    the features alone, in one shuffle.
    Decision per feature: confirmed, rejected or tentative at level alpha.
    """
    known = df.where(F.col(label) != -1).select(*key, label, *features).persist()
    ranked = hash_rank(class_weights(known, label), [], key, seed, "rank__").select("rank__", label, "weight", *features)
    # as many partitions as joins have, and never joined up: the rows stay where they are in every round
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = ranked.repartition(parts, "rank__").persist()
    n = ranked.count()
    known.unpersist()
    rng = random.Random(seed)
    hits = {f: 0 for f in features}
    for r in range(rounds):
        a, b = _permutation(n, rng)
        moved = F.pmod(F.col("rank__") * F.lit(a) + F.lit(b), F.lit(max(n, 1))).alias("rank__")
        right = ranked.select(moved, *[F.col(f).alias(f"shadow__{f}") for f in features])
        both = assemble_vector(ranked.join(right, "rank__"), [*features, *[f"shadow__{f}" for f in features]])
        forest = RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed + r)
        imp = forest.fit(both).featureImportances.toArray()
        best = max(imp[len(features):])
        for j, f in enumerate(features):
            hits[f] += int(imp[j] > best)
    ranked.unpersist()
    rows = []
    for f in features:
        up, down = binomial_tail(hits[f], rounds), binomial_tail(rounds - hits[f], rounds)
        rows.append((f, hits[f], "confirmed" if up <= alpha else "rejected" if down <= alpha else "tentative"))
    return df.sparkSession.createDataFrame(rows, "feature string, hits int, decision string")


def adversarial(
    train: DataFrame, test: DataFrame, features: Sequence[str], key: Sequence[str], k: int = 5, seed: int = 0, estimator: Estimator | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tell train from test: out-of-fold P(test), importances, fold metrics."""
    both = train.select(*key, *features).withColumn("is_test", F.lit(0)).unionByName(
        test.select(*key, *features).withColumn("is_test", F.lit(1))
    )
    est = estimator or gbt("is_test")
    return cross_validate(both, features, "is_test", key, est, k, seed=seed)


def similarity_weights(
    train: DataFrame, test: DataFrame, features: Sequence[str], key: Sequence[str], k: int = 5, seed: int = 0, estimator: Estimator | None = None
) -> DataFrame:
    """Out-of-fold probability of being a test row, per training row, as its weight."""
    oof, _, _ = adversarial(train, test, features, key, k, seed, estimator)
    return oof.where("is_test = 0").select(*key, F.col("prob").alias("similarity_weight"))


# ---------------------------------------------------------------- trial categories


def fit_bins(scores: DataFrame, score: str, n: int = 3) -> list[float]:
    """Inner edges of n quantile bins (exact): n - 1 numbers."""
    qs = {f"q{i}": i / n for i in range(1, n)}
    row = exact_quantiles(scores, [], score, qs).first()
    return [row[q] for q in qs]


# fixed values: category labels
BIN_LABELS = ("low", "medium", "high")
CLUSTER_LABELS = ("low", "medium", "high", "very high")
NO_TELEMETRY, NO_TRIAL = "did trial without call-home", "did not do trial"


def binned(score: Column, edges: Sequence[float], labels: Sequence[str] = BIN_LABELS) -> Column:
    """Label of the quantile bin; a score on an edge belongs to the upper bin."""
    out = F.when(score < F.lit(edges[0]), F.lit(labels[0]))
    for e, name in zip(edges[1:], labels[1:]):
        out = out.when(score < F.lit(e), F.lit(name))
    return out.otherwise(F.lit(labels[len(edges)]))


def trial_category(df: DataFrame, category: Column, drop: Sequence[str] = ()) -> DataFrame:
    """Category 1 takes the scored label, 2 and 3 their fixed text; raw trial columns go."""
    cat = F.col("trial_cat")
    out = F.when(cat == 1, category).when(cat == 2, F.lit(NO_TELEMETRY)).when(cat == 3, F.lit(NO_TRIAL))
    return df.withColumn("trial_cat_feature", out).drop("trial_cat", *drop)


def columns_with_nulls(df: DataFrame) -> list[str]:
    """Columns holding any null (the trial columns); names only."""
    row = df.agg(*[F.max(F.col(f"`{c}`").isNull()).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[str(i)]]


def score_accounts(df: DataFrame, model: Model, features: Sequence[str], threshold: float = 0.5, inclusive: bool = True) -> DataFrame:
    """Probability and label per account; keys stay on the row throughout."""
    out = probability(model.transform(assemble_vector(df, features)), "class_pred_proba").drop("features")
    p = F.col("class_pred_proba")
    return out.withColumn("class_pred", F.when(p >= threshold if inclusive else p > threshold, 1).otherwise(0))
