"""Lead scoring inputs: activity pivots, lead attributes, trial usage, e-mail domains."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, functions as F

from ..functions import numeric as num
from ..functions.text import activity_name, phone_status
from ..session import cut_lineage
from . import prep
from .order import ranks, same

# fixed values: technology names as they occur in usage columns
TECHNOLOGIES = (
    "maven", "generic", "buildinfo", "docker", "npm", "pypi", "gradle", "nuget", "yum", "helm", "gems", "debian", "ivy", "sbt",
    "conan", "bower", "go", "chef", "gitlfs", "composer", "puppet", "conda", "vagrant", "cocoapods", "cran", "opkg", "p2", "vcs", "alpine",
)

# fixed values: scoring reasons that become features
SCORING_REASONS = (
    "form - fills out web contact/buy now/get quote form",
    "academy - sign up",
    "academy - course completion ",
    "webinar generic - on demand",
    "on24 resource 2 viewed",
    "on24 resource 3 viewed",
    "social click link",
    "form - fills out trial form (tier 2 not targeted company)",
    "03 - webinar - attended",
    "web - visits undesirable web pages",
    "form - fills out partners trial or mp form",
    "form - fills out contact/buy now/get quote form",
    "webinar cloud - meeting",
    "form - fills out social linkedin",
    "04 - webinar - on demand",
    "website gated content - generic",
    "form - fills out trial enterprise form",
    "form - fills out social facebook",
    "content syndication - ziff davis generic - multi",
    "form - fills out marketo - contact us demo after webinar",
    "free tier from event cta",
    "webinar cloud - no show",
    "form - fills out trial form",
    "web - visits key web pages",
    "webinar cloud - attended",
    "form - fills out trial form (tier 2 targeted company)",
    "02 - webinar - no show",
    "drift conversation",
    "email - clicks link in email",
    "form - fills out marketo - on-demand webinar",
    "webinar cloud - on demand",
    "on24 q&a participant",
    "free tier pipelines checkbox",
    "form - fills out web - website gated content",
    "form - fills out orbitera form",
    "webinar generic - no show",
    "web - visits multiple web pages in 1 day",
    "trial dropout - visits the website",
    "webinar generic - meeting",
    "ziff davis - more than 1",
    "event - asked for a meeting",
    "on24 resource 1 viewed",
    "content syndication - ziff davis generic",
    "webinar generic - attended",
    "free tier commercial",
    "free tier 25%+ usage",
    "social share post",
    "01 - webinar - registered",
    "social like",
)


def counted_activities(df: DataFrame, min_count: int, allowed: Sequence[str] | None, reason: str = "reason") -> DataFrame:
    """Activities (a, n) seen more than `min_count` times, 'score' left out."""
    seen = df.select(activity_name(F.col(reason)).alias("a")).where("a <> 'score'")
    if allowed is not None:
        seen = seen.where(F.col("a").isin(list(allowed)))
    return seen.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_count)


def frequent_activities(df: DataFrame, min_count: int, allowed: Sequence[str], reason: str = "reason") -> list[str]:
    """The named activities seen more than `min_count` times, most frequent first.

    They become columns, so the list has to be named. `activity_index` and `activity_vectors` take
    activities of any number, in sparse form.
    """
    if allowed is None:
        raise ValueError("columns need a list of activities; activity_index and activity_vectors do without")
    return [r["a"] for r in counted_activities(df, min_count, allowed, reason).orderBy(F.desc("n"), "a").collect()]


def activity_index(df: DataFrame, min_count: int = 10, allowed: Sequence[str] | None = None, reason: str = "reason") -> DataFrame:
    """Activities (activity, n, idx) seen more than `min_count` times, numbered from 0, most
    frequent first. A table of any size; no name reaches the driver."""
    return cut_lineage(ranks(counted_activities(df, min_count, allowed, reason), [], [F.desc("n"), F.asc("a")], "idx").select(F.col("a").alias("activity"), "n", "idx"))


def activity_counts(df: DataFrame, keys: Sequence[str], index: DataFrame, reason: str = "reason") -> DataFrame:
    """Long form: keys, idx, n, a row for each indexed activity of a key. Counts come
    before the index is met, so a frequent activity moves once per key."""
    name = free_column(keys, "activity__")
    long = df.groupBy(*keys, activity_name(F.col(f"`{reason}`")).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return long.join(index.select(F.col("activity").alias(name), "idx"), name).select(*keys, "idx", "n")


def activity_vectors(df: DataFrame, keys: Sequence[str], index: DataFrame, reason: str = "reason") -> DataFrame:
    """One row per key: `indices` (rising) and `counts` of its activities by `index` (repeat
    a training index on test data). A key without any has empty arrays; a null key is a key."""
    entries = F.sort_array(F.collect_list(F.struct("idx", "n"))).alias("e")
    held = activity_counts(df, keys, index, reason).groupBy(*keys).agg(entries)
    everyone = df.select(*keys).distinct()
    met = everyone.alias("l").join(held.alias("r"), same(keys, "l", "r"), "left").select(*[F.col(f"l.`{k}`") for k in keys], "e")
    part = lambda f: F.coalesce(F.transform("e", lambda p: p[f]), F.array().cast("array<long>"))
    return met.select(*[F.col(f"`{k}`") for k in keys], part("idx").alias("indices"), part("n").alias("counts"))


def with_sparse_vector(df: DataFrame, size: int, name: str = "features") -> DataFrame:
    """`indices` and `counts` as one sparse vector of `size` entries for Spark ML."""
    vector = F.udf(lambda i, v: Vectors.sparse(size, i, v), VectorUDT())
    return df.withColumn(name, vector("indices", "counts"))


def free_column(taken: Sequence[str], name: str) -> str:
    while name in taken:
        name += "_"
    return name


def activity_pivot(
    df: DataFrame,
    keys: Sequence[str],
    min_count: int = 10,
    allowed: Sequence[str] | None = SCORING_REASONS,
    attributes_complete: bool = False,
    activities: Sequence[str] | None = None,
    prune: bool = True,
    exempt: Sequence[str] = ("relevant_date",),
) -> DataFrame:
    """Activity counts per key as `CS-<activity>` columns next to the key's attributes.

    Input columns: keys, reason, activity_date and attributes. `activities` repeats a
    training choice on test data. `attributes_complete` drops attribute rows with a
    null (journeys). Constant columns are pruned at the end.
    """
    kept = list(activities) if activities is not None else frequent_activities(df, min_count, allowed)
    named = df.withColumn("activity__", activity_name(F.col("reason")))
    counts = named.groupBy(*keys).agg(
        F.lit(1).alias("seen__"), *[F.count(F.when(F.col("activity__") == a, 1)).alias(f"CS-{a}") for a in kept]
    )
    attributes = df.drop("reason", "activity_date")
    if attributes_complete:
        attributes = attributes.dropna()
    out = counts.drop("seen__").join(attributes.dropDuplicates(), list(keys))
    return prep.drop_zero_variance(out, [*keys, "class", *exempt]) if prune else out


def latest_by(df: DataFrame, key: str, order: str, tie: str) -> DataFrame:
    """The row with the largest `order` per key, smallest `tie` first: an aggregate, no sort."""
    best = df.groupBy(key).agg(
        F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(-F.col(order), F.col(tie))).alias("r")
    )
    return best.select("r.*")


def exclude_known(trials: DataFrame, leads: DataFrame, on: str = "email") -> DataFrame:
    return trials.join(leads.select(on).where(F.col(on).isNotNull()).distinct(), on, "left_anti")


def lead_features(df: DataFrame) -> DataFrame:
    """Phone status, merged territory and source, academic mail flag, leading analytics, rates."""
    totals = [c for c in df.columns if "total_" in c]
    cs = [c for c in df.columns if "CS-" in c]
    gone = {"leadsource", "country", "phone", "email", "relevant_date", *cs}
    mql, decision = F.col("days_to_mql"), F.col("days_to_decision")
    out = [F.col(f"`{c}`") for c in df.columns if c not in gone]
    out += [F.when(F.col(f"`{c}`") > 0, 1).otherwise(0).alias(c) for c in cs]
    out += [
        phone_status(F.col("phone")).alias("has_valid_phone"),
        F.when(F.col("territory") == "APAC", F.lit("APAC")).otherwise(F.col("country")).alias("country/territory"),
        F.when(F.col("leadsource").isin("other", "Webinar", "Gated Content"), F.lit("other")).otherwise(F.col("leadsource")).alias("lead_source"),
        F.when(F.col("email").rlike(r"\.edu|\.ac|\.college"), 1).otherwise(0).alias("is_student_email"),
        num.safe_ratio(F.col("n_reasons"), mql).alias("n_reasons / time to mql"),
        num.safe_ratio(F.col("number_of_attempts"), decision).alias("n_attempts / time in mql"),
        num.safe_ratio(F.col("number_of_engagements"), decision).alias("n_engagements / time in mql"),
    ]
    if totals:
        out.append(num.argmax_name(totals, [F.col(c) for c in totals]).alias("leading_analytics"))
    return df.select(*out)


def trial_features(df: DataFrame, technologies: Sequence[str] = TECHNOLOGIES) -> DataFrame:
    """Technology columns by name part: how many, their spread, the leading one, size ratios."""
    cols = [c for c in df.columns if any(t in c for t in technologies)]
    held = [F.col(c) for c in cols]
    return df.select(
        "*",
        num.nonzero_count(held).alias("n_tech"),
        num.row_std(held).alias("n_tech_std"),
        num.argmax_name(cols, held).alias("leading_tech"),
        num.safe_ratio(F.col("a_size_avg"), F.col("b_size_avg")).alias("a_size_avg/b_size_avg"),
        num.safe_ratio(F.col("a_count_avg"), F.col("b_count_avg")).alias("a_count_avg/b_count_avg"),
    )


def domain_validity(df: DataFrame, known: DataFrame) -> DataFrame:
    """0 for digits-only or test user names, 1 for general mail, else the known table; unknown 0.

    known: domain, is_valid. Whether it is small enough to broadcast is left to its size.
    """
    user = F.split(F.col("email"), "@").getItem(0)
    bad = user.rlike("^[0-9]+$") | user.contains("tests")
    table = known.groupBy("domain").agg(F.max("is_valid").alias("known__"))
    return (
        df.join(table, "domain", "left")
        .withColumn(
            "domain_is_valid",
            F.when(bad, 0).when(F.col("is_general") != 0, 1).otherwise(F.coalesce("known__", F.lit(0))),
        )
        .drop("known__")
    )
