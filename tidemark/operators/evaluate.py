"""Evaluation and explanation tables: the data behind curves, matrices and reports."""

from __future__ import annotations

import math
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import prep
from .order import exact_quantiles, join_groups, running_totals


def class_share(df: DataFrame, feature: str, label: str, min_obs: int = 50) -> DataFrame:
    """Percent of each class within each category of at least `min_obs` rows."""
    cells = df.groupBy(feature, label).agg(F.count(F.lit(1)).alias("n"))
    totals = cells.groupBy(feature).agg(F.sum("n").alias("total")).where(F.col("total") >= min_obs)
    return cells.join(totals, feature).select(
        F.concat(F.col(feature).cast("string"), F.lit(": "), F.col("total").cast("string")).alias(feature),
        label,
        (F.col("n") * 100 / F.col("total")).alias("percentage"),
    )


def importance_summary(importance: DataFrame, n: int | None = None) -> DataFrame:
    """Mean importance per feature over folds, the top n."""
    out = importance.groupBy("feature").agg(F.avg("importance").alias("average_importance"))
    return out if n is None else out.orderBy(F.desc("average_importance"), "feature").limit(n)


# ---------------------------------------------------------------- classification


def pr_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each distinct score, with what the areas need.

    Rows are grouped by score first; the running totals come from stretches of the sorted scores, so
    neither a busy score nor the number of scores ends up in one task.
    """
    n = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    cum = running_totals(n, by, score, ["pos", "n"], descending=True)
    totals = cum.groupBy(*by).agg(F.max("pos__cum").alias("positives"), F.max("n__cum").alias("rows"))
    tp, seen = F.col("pos__cum"), F.col("n__cum")
    before = seen - F.col("n")
    return (
        join_groups(cum, totals, by)
        .select(
            *by,
            F.col(score).alias("threshold"),
            tp.alias("tp"),
            (seen - tp).alias("fp"),
            (tp / seen).alias("precision"),
            F.when(F.col("positives") > 0, tp / F.col("positives")).otherwise(F.lit(1.0)).alias("recall"),
            "positives",
            "rows",
            F.col("pos").alias("step"),
            # the point before the first threshold is (precision 1, recall 0)
            F.when(before > 0, (tp - F.col("pos")) / before).otherwise(F.lit(1.0)).alias("precision_before"),
        )
    )


def pr_summary(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision, trapezoid area under the curve and base rate."""
    p = pr_points(df, label, score, by).withColumn("dr", F.when(F.col("positives") > 0, F.col("step") / F.col("positives")).otherwise(0.0))
    aggs = [
        F.sum(F.col("dr") * F.col("precision")).alias("average_precision"),
        F.sum(F.col("dr") * (F.col("precision") + F.col("precision_before")) / 2).alias("auc"),
        F.max(F.col("positives") / F.col("rows")).alias("base_rate"),
    ]
    return p.groupBy(*by).agg(*aggs)


def pr_grid(df: DataFrame, label: str, score: str, points: int = 100) -> DataFrame:
    """The best recall at a precision of at least g, on an even grid of g in [0, 1]."""
    last = points - 1
    # the curve's end point (precision 1, recall 0) is always attainable
    ends = pr_points(df, label, score).select(F.floor(F.col("precision") * last + 1e-9).cast("int").alias("g"), "recall")
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("g"))
    best = grid.join(ends.groupBy("g").agg(F.max("recall").alias("r")), "g", "left")
    up = Window.orderBy(F.desc("g")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # `points` rows
    return best.select(
        (F.col("g") / last).alias("precision"), F.coalesce(F.max("r").over(up), F.lit(0.0)).alias("recall")
    )


def f1_at(df: DataFrame, label: str, score: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    pred, y = F.col(score) > threshold, F.col(label) == 1
    c = df.groupBy(*by).agg(
        F.count(F.when(pred & y, 1)).alias("tp"),
        F.count(F.when(pred & ~y, 1)).alias("fp"),
        F.count(F.when(~pred & y, 1)).alias("fn"),
    )
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return c.withColumn("f1", F.when(den > 0, 2 * F.col("tp") / den).otherwise(F.lit(0.0)))


def f1_summary(df: DataFrame, label: str, score: str, threshold: float, fold: str) -> DataFrame:
    return f1_at(df, label, score, threshold, [fold]).agg(
        F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"), F.count(F.lit(1)).alias("folds")
    )


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Four cells with count and share of all rows; empty cells are 0."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    cells = {"True Neg": ~y & ~p, "False Pos": ~y & p, "False Neg": y & ~p, "True Pos": y & p}
    one = df.agg(F.count(F.lit(1)).alias("all"), *[F.count(F.when(c, 1)).alias(n) for n, c in cells.items()])
    rows = [F.struct(F.lit(n).alias("cell"), F.col(f"`{n}`").alias("n")) for n in cells]
    return one.select("all", F.explode(F.array(*rows)).alias("c")).select(
        "c.cell", "c.n", F.when(F.col("all") > 0, F.col("c.n") * 100 / F.col("all")).alias("percentage")
    )


# ---------------------------------------------------------------- drift


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "feature", "value")


def kolmogorov_p(d: Column, n1: Column, n2: Column, terms: int = 10) -> Column:
    """Asymptotic two-sided p-value of the Kolmogorov distribution at t = d sqrt(n1 n2 / (n1 + n2)).

    The distribution has two equal series: one converges fast for large t, the other for
    small t; each is used on its side of 1, where a few terms are exact to rounding.
    Equal samples (d = 0) have p = 1.
    """
    t = d * F.sqrt(n1 * n2 / (n1 + n2))
    far = [(1.0 if k % 2 else -1.0) * F.exp(-2.0 * k * k * t * t) for k in range(1, terms + 1)]
    near = [F.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * t * t)) for k in range(1, terms + 1)]
    p = F.when(t <= 0, 1.0).when(t < 1, 1 - math.sqrt(2 * math.pi) / t * sum(near)).otherwise(2 * sum(far))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))


def ks_table(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value of every column."""
    both = _long(train, cols).withColumn("t", F.lit(1)).unionByName(_long(test, cols).withColumn("t", F.lit(0)))
    n = both.where("value is not null").groupBy("feature", "value").agg(
        F.sum("t").alias("a"), F.sum(1 - F.col("t")).alias("b")
    )
    cum = running_totals(n, ["feature"], "value", ["a", "b"])
    totals = cum.groupBy("feature").agg(F.max("a__cum").alias("n1"), F.max("b__cum").alias("n2"))
    gap = F.abs(F.col("a__cum") / F.col("n1") - F.col("b__cum") / F.col("n2"))
    d = (
        cum.join(totals.where("n1 > 0 and n2 > 0"), "feature")
        .groupBy("feature")
        .agg(F.max(gap).alias("statistic"), F.max("n1").cast("double").alias("n1"), F.max("n2").cast("double").alias("n2"))
    )
    return d.select("feature", "statistic", kolmogorov_p(F.col("statistic"), F.col("n1"), F.col("n2")).alias("p"))


def ks_drift(train: DataFrame, test: DataFrame, cols: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """Columns whose distributions differ: p <= 0.05 and a statistic above the threshold."""
    return (
        ks_table(train, test, cols)
        .where((F.col("p") <= 0.05) & (F.abs("statistic") > threshold))
        .select("feature", F.round("p", 5).alias("p"), F.round("statistic", 2).alias("statistic"))
        .orderBy(F.desc("statistic"), "feature")
    )


def log_histogram(train: DataFrame, test: DataFrame, cols: Sequence[str], width: float = 0.25) -> DataFrame:
    """log1p histogram of both samples: count and density per bin."""
    both = _long(train, cols).withColumn("sample", F.lit("train")).unionByName(
        _long(test, cols).withColumn("sample", F.lit("test"))
    )
    bins = (
        both.where("value > -1")
        .groupBy("feature", "sample", F.floor(F.log1p("value") / width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = bins.groupBy("feature", "sample").agg(F.sum("n").alias("total"))
    return bins.join(totals, ["feature", "sample"]).select(
        "feature", "sample", "bin", "n", (F.col("n") / (F.col("total") * F.lit(width))).alias("density")
    )


def cluster_profile(df: DataFrame, cols: Sequence[str], group: str, min_members: int = 1) -> DataFrame:
    """Median of every column per group of more than `min_members` rows, long form.

    Exact medians from value counts and running totals over stretches, so that a group of
    any size never sits in one task. Rows whose group is null are a group.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > min_members)
    long = df.select(group, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot([group], list(cols), "feature", "value")
    med = exact_quantiles(long, [group, "feature"], "value", {"median": 0.5}).drop("n")
    out = join_groups(med, sizes, [group])
    return out.select(group, "feature", "median", "members")


# ---------------------------------------------------------------- explanations

LOW, HIGH, MIDDLE = " (low comparing to other leads)", " (high comparing to other leads)", " (around the average)"


def linear_contributions(df: DataFrame, features: Sequence[str], coefficients: Mapping[str, float]) -> DataFrame:
    """coef * (x - mean) per feature: exact for a linear scorer. Means are one row."""
    means = prep.training_means(df, features)
    return df.select(
        *[
            (F.lit(float(coefficients[c])) * (F.col(c) - F.lit(float(means[c])))).alias(c) if c in coefficients else F.col(c)
            for c in df.columns
        ]
    )


def melt_contributions(contrib: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    return contrib.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        list(keys), list(features), "feature", "contribution"
    )


def top_contributions(
    contrib: DataFrame,
    values: DataFrame,
    key: str,
    features: Sequence[str],
    n: int = 5,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Per row the n largest positive and n largest negative contributions, with the
    value and, for numbers, how it compares: below the 33rd, above the 66th percentile."""
    kept = [f for f in features if f not in exclude]
    long = melt_contributions(contrib, [key], kept).where("contribution <> 0")
    positive = F.col("contribution") > 0
    # a window over the features of one row: as wide as the schema
    order = Window.partitionBy(key, positive).orderBy(F.desc(F.abs("contribution")), "feature")
    top = long.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    numbers = [f for f in kept if prep.is_numeric(values, f)]
    held = values.select(key, *[F.col(f).cast("double").alias(f) for f in numbers]).unpivot([key], numbers, "feature", "value")
    edges = exact_quantiles(held, ["feature"], "value", {"lower": 0.33, "upper": 0.66}).drop("n")
    text = values.select(key, *[F.col(f).cast("string").alias(f) for f in kept]).unpivot([key], kept, "feature", "feature_value")
    v = F.col("feature_value").try_cast("double")
    note = (
        F.when(F.col("lower").isNull(), F.lit(""))
        .when(v < F.col("lower"), F.lit(LOW))
        .when(v > F.col("upper"), F.lit(HIGH))
        .otherwise(F.lit(MIDDLE))
    )
    return (
        top.join(text, [key, "feature"])
        .join(edges, "feature", "left")
        .select(key, "feature", F.concat("feature_value", note).alias("feature_value"), "contribution")
    )


def effect_strength(contrib: DataFrame) -> DataFrame:
    """'strong' beyond the feature's median on the contribution's own side, else 'weak'."""
    side = contrib.withColumn("positive", F.col("contribution") > 0)
    med = exact_quantiles(side, ["feature", "positive"], "contribution", {"median": 0.5}).drop("n")
    beyond = F.when(F.col("positive"), F.col("contribution") > F.col("median")).otherwise(F.col("contribution") < F.col("median"))
    return (
        side.join(med, ["feature", "positive"])
        .withColumn("level_of_effect", F.when(beyond, "strong").otherwise("weak"))
        .drop("positive", "median")
    )


def error_drivers(pred: DataFrame, contrib: DataFrame, key: str, side: str = "positive") -> DataFrame:
    """Per feature: contributions against the class among the misses, for it among the hits.

    side "positive": false negatives pushed down vs true positives pushed up;
    side "negative": false positives pushed up vs true negatives pushed down.
    """
    actual = 1 if side == "positive" else 0
    rows = pred.where(F.col("class") == actual).select(key, (F.col("class_pred") == actual).alias("hit"))
    toward = F.col("contribution") > 0 if side == "positive" else F.col("contribution") < 0
    away = F.col("contribution") < 0 if side == "positive" else F.col("contribution") > 0
    out = contrib.join(rows, key).groupBy("feature").agg(
        F.count(F.when(~F.col("hit") & away, 1)).alias("misled"), F.count(F.when(F.col("hit") & toward, 1)).alias("led")
    )
    return out.where("misled > 0 or led > 0")


def contribution_summary(contrib: DataFrame) -> DataFrame:
    return contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
