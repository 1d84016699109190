"""Cohorts: which accounts, at which reference date, with which class.

Nothing here reads a clock: `as_of` is a parameter, and random draws are either
hash-derived (repeatable anywhere) or seeded.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import months_between_boundaries
from ..functions.numeric import hash_fraction
from .asof import KEY, REF, asof_running, largest
from .skew import hot_keys, spread_join


def contract_history(
    events: DataFrame,
    products: DataFrame,
    accounts: DataFrame,
    logos: DataFrame,
    as_of: str,
    cloud_unit: str,
    keep_open_wins: bool = True,
    row_id: str = "event_id",
) -> DataFrame:
    """Closed, won (or undecided) contract events with products, account and parent.

    First and last event month come from a grouped aggregate joined back, not from
    a window: the aggregate combines map-side, and everything known per account is
    joined in one go over salted keys, so a busy account is worked on by many tasks.
    """
    won = F.col("iswon") == "true"
    if keep_open_wins:
        won = won | F.col("iswon").isNull()
    kept = events.where(
        (F.col("isclosed") == "true")
        & won
        & (F.col("sales_business_unit") != cloud_unit)
        & (F.col("event_month") <= F.lit(as_of).cast("date"))
    )
    span = kept.groupBy(KEY).agg(
        F.max("event_month").alias("last_event_month"), F.min("event_month").alias("first_event_month")
    )
    old = products.select("product_id", F.col("product_name").alias("prev_product_name"))
    new = products.select(F.col("product_id").alias("product_renewal_id"), F.col("product_name").alias("new_product_name"))
    who = accounts.select(KEY, "logo", "territory").join(logos.select("logo", "pbid"), "logo", "left").drop("logo")
    pure = F.when((F.col("net_new_arr") > 0) & (F.col("event_type") == "Customer Success"), 1).otherwise(0)
    return (
        kept.withColumn("pure_upsell_flag", pure)
        .join(old, "product_id", "left")
        .join(new, "product_renewal_id", "left")
        .transform(lambda d: spread_join(d, span.join(who, KEY, "left"), KEY, row_id, hot=hot_keys(kept, [KEY])))
        .drop("product_id", "product_renewal_id", "net_new_arr", "event_type", "isclosed", "iswon")
    )


def upsell_accounts(
    history: DataFrame, mids: Sequence[str], base: str, uppers: Sequence[str], labels: Mapping[int, str]
) -> DataFrame:
    """Accounts that moved up: best previous tier and last event month.

    A move is (base or mid) -> upper, or extra revenue within upper, and the two
    products differ. Rank 1 is mid, 2 is base, 3 anything else.
    """
    prev, new = F.col("prev_product_name"), F.col("new_product_name")
    up = new.isin(list(uppers)) & prev.isin(base, *mids)
    more = (F.col("pure_upsell_flag") == 1) & prev.isin(list(uppers))
    rank = F.when(prev.isin(list(mids)), 1).when(prev == base, 2).otherwise(3)
    best = (
        history.where((up | more) & (prev != new))
        .groupBy(KEY)
        .agg(F.min(rank).alias("r"), F.max("event_month").alias("event_month"))
    )
    label = F.when(F.col("r") == 1, labels[1]).when(F.col("r") == 2, labels[2]).otherwise(labels[3])
    return best.select(KEY, "event_month", label.alias("previous_product"))


def first_upgrades(history: DataFrame, base: str, uppers: Sequence[str]) -> DataFrame:
    """Simpler form: month of the first base -> upper event, three months earlier."""
    hit = (F.col("prev_product_name") == base) & F.col("new_product_name").isin(list(uppers))
    month = F.add_months(F.trunc(F.min("event_month"), "month"), -3)
    return (
        history.where(hit)
        .groupBy(KEY, "territory")
        .agg(month.alias(REF))
        .select(KEY, "territory", F.lit(1).alias("class"), REF)
    )


def non_upsell(history: DataFrame, upsell: DataFrame, tier: str) -> DataFrame:
    """Accounts that renewed in the same tier and never moved up."""
    same = (F.col("prev_product_name") == tier) & (F.col("new_product_name") == tier)
    return (
        history.where(same)
        .select(KEY, "territory")
        .distinct()
        .join(upsell.select(KEY), KEY, "left_anti")
        .withColumn("class", F.lit(0))
    )


def random_reference_month(
    history: DataFrame, accounts: DataFrame, as_of: str, seed: int = 0, method: str = "hash", row_id: str = "event_id"
) -> DataFrame:
    """One random month per account between its earliest allowed date and as_of - 3 months.

    Earliest: the first event + 4 months without a customer date; the first event
    if customer date + 4 months lies before it; else customer date + 4 months.
    Each event row gives a draw and one row is kept at random. `hash` derives both
    from the row id, `rand` from a seeded generator. The pick is a `min_by`, so no
    account is sorted in one task.
    """
    if method == "hash":
        u, pick = hash_fraction(F.col(row_id), F.lit(seed)), F.sha1(F.concat_ws("|", F.lit(f"pick{seed}"), F.col(row_id).cast("string")))
    else:
        u, pick = F.rand(seed), F.rand(seed + 1)
    since = accounts.select(KEY, F.add_months("customer_since", 4).alias("c4"))
    # one draw per account is kept before anything is joined
    kept = history.select(KEY, "first_event_month", u.alias("u"), pick.alias("pick")).groupBy(KEY).agg(
        F.min_by("u", "pick").alias("u"), F.min("first_event_month").alias("first")
    )
    first = F.col("first")
    lo = F.when(F.col("c4").isNull(), F.add_months(first, 4)).when(F.col("c4") < first, first).otherwise(F.col("c4"))
    hi = F.add_months(F.lit(as_of).cast("date"), -3)
    # whole days, as the result is a month
    day = F.date_add(lo, F.floor(F.col("u") * F.datediff(hi, lo)).cast("int"))
    return kept.join(since, KEY, "left").select(KEY, F.trunc(day, "month").alias(REF))


def assign_reference(history: DataFrame, upsell: DataFrame, drawn: DataFrame, as_of: str) -> DataFrame:
    """Upgraded accounts: event month - 3 months; others: their drawn month."""
    usable = drawn.where(F.col(REF) <= F.lit(as_of).cast("date")).withColumnRenamed(REF, "drawn")
    # history is reduced to its output grain before the joins
    grain = history.groupBy(KEY, "sales_business_unit", "territory").agg(F.max("pbid").alias("pbid"))
    up = F.col("event_month").isNotNull()
    month = F.when(up, F.add_months(F.trunc("event_month", "month"), -3)).otherwise(F.col("drawn"))
    return (
        grain.join(upsell.select(KEY, "event_month"), KEY, "left")
        .join(usable, KEY, "left")
        .select(KEY, "sales_business_unit", "territory", month.alias(REF), F.when(up, 1).otherwise(0).alias("upgraded"), "pbid")
    )


def add_controls(assigned: DataFrame, accounts: DataFrame) -> DataFrame:
    """A second, earlier row with class 0 for every upgraded account; duplicates fall out."""
    year_back = F.add_months(F.col(REF), -12)
    start = F.add_months(F.col("customer_since"), 3)
    earlier = (
        assigned.where("upgraded = 1")
        .join(accounts.select(KEY, "customer_since"), KEY, "left")
        .withColumn(REF, F.when(start < year_back, year_back).otherwise(start))
        .withColumn("upgraded", F.lit(0))
        .drop("customer_since")
    )
    return assigned.unionByName(earlier).distinct()


def cohort_union(
    opps: DataFrame, accounts: DataFrame, base: str, upper: str, since_year: int, won: str, not_like: str
) -> DataFrame:
    """Same-tier wins (class 0) and upgrades (class 1), dated three months before close.

    The account's 18-character id is cut to the 15 characters opportunities use.
    """
    recent = opps.where(
        (F.col("original_product") == base) & (F.year("createddate") >= since_year) & (F.col("iswon") == won)
    )
    month = F.add_months(F.trunc("closedate", "month"), -3).alias(REF)
    same = recent.where(F.col("product") == base).select(KEY, F.lit(0).alias("class"), month)
    up = recent.where((F.col("product") == upper) & ~F.lower(F.col("type")).contains(not_like)).select(
        KEY, F.lit(1).alias("class"), month
    )
    full = F.col("account_id_full")
    ids = accounts.select(F.left(full, F.length(full) - 3).alias(KEY), "territory")
    return same.unionByName(up).distinct().where(F.col(REF).isNotNull()).join(ids, KEY)


def drop_contradictions(pop: DataFrame) -> DataFrame:
    """Remove every account that has two classes on one date."""
    by_date = pop.groupBy(KEY, REF).agg((F.min("class") != F.max("class")).alias("odd"))
    bad = by_date.where("odd").select(KEY).distinct()
    # null classes never contradict; the anti join keeps all rows of the other accounts
    return pop.join(bad, KEY, "left_anti")


def cohort_v4(
    opps: DataFrame, old_products: Column, new_products: DataFrame, accounts: DataFrame, base: Sequence[str], since: str, lead_days: int = 90
) -> DataFrame:
    """Won and closed renewals since a day; class = the new product is not a base one.

    `old_products` is the condition that the original product is a base product;
    `new_products` holds (product_id, new_product) of the licences that count.
    """
    live = opps.where(
        (F.col("type") != "New Business")
        & (F.col("iswon") == "true")
        & (F.col("isclosed") == "true")
        & (F.col("closedate") >= F.lit(since).cast("date"))
    ).where(old_products)
    return (
        live.distinct()
        .join(new_products.select("product_id", "new_product"), "product_id")
        .join(accounts.select(KEY, "territory"), KEY)
        .select(
            KEY,
            "territory",
            F.date_sub(F.col("closedate").cast("date"), lead_days).alias(REF),
            F.when(F.col("new_product").isin(list(base)), 0).otherwise(1).alias("class"),
        )
    )


def union_cohorts(positives: DataFrame, negatives: DataFrame, drawn: DataFrame) -> DataFrame:
    """Positives and, with their drawn date, the controls; duplicates stay."""
    cols = [KEY, "territory", "class", REF]
    controls = negatives.join(drawn, KEY, "left").select(*cols).distinct()
    return controls.unionByName(positives.select(*cols))


def scoring_cohort(accounts: DataFrame, tier: str, as_of: str) -> DataFrame:
    """Live accounts of the base tier, dated `as_of`, class 0."""
    return accounts.where(F.col("top_subscription") == tier).select(
        KEY, "territory", F.lit(as_of).cast("date").alias(REF), F.lit(0).alias("class")
    )


def time_from_renewal(pop: DataFrame, history: DataFrame) -> DataFrame:
    """Months since the last renewal in a yearly cycle.

    Smallest positive month difference; if none is positive, 12 + the largest.
    The smallest positive one belongs to the latest event of an earlier month and
    the largest to the first event, so neither needs all pairs of dates and events.
    """
    months = history.select(KEY, F.trunc("event_month", "month").alias("m")).distinct()
    first = months.groupBy(KEY).agg(F.min("m").alias("first_month"))
    # events of a strictly earlier month are due on the first of the next one
    due = months.withColumn("due", F.add_months("m", 1))
    prior = asof_running(pop, due, F.col("due"), {"m": largest(F.col("m"))})
    ref = F.col(REF)
    near = months_between_boundaries(F.col("m"), ref)
    far = months_between_boundaries(F.col("first_month"), ref)
    return (
        pop.select(KEY, REF)
        .join(first, KEY, "left")
        .join(prior, [KEY, REF], "left")
        .select(KEY, REF, F.when(F.col("m").isNotNull(), near).otherwise(far + 12).alias("tfr"))
    )


def months_from_renewal(pop: DataFrame, opps: DataFrame, close: str = "closedate") -> DataFrame:
    """Months since the latest close on or before the date."""
    last = asof_running(pop, opps, F.col(close), {"last__": largest(F.col(close).cast("date"))})
    return last.select(KEY, REF, months_between_boundaries(F.col("last__"), F.col(REF)).alias("months_from_renewal"))


def consolidate_wins(df: DataFrame, numeric: Sequence[str], mode: str = "colmin", seed: int = 2, row_id: str = "row_id") -> DataFrame:
    """One row per account: of winning accounts the won rows, of others a random row.

    mode "colmin" takes each numeric column's minimum over the won rows; "earliest"
    the won row of the earliest date. Others: the row with the smallest hash.
    """
    won = F.col("class") == 1
    row = F.struct(*[F.col(c) for c in numeric])
    draw = F.sha1(F.concat_ws("|", F.lit(str(seed)), F.col(row_id).cast("string")))
    # both outcomes from one aggregation: no join of an account's rows with its flag
    if mode == "colmin":
        best = [F.min(F.when(won, F.col(c))).alias(f"w__{c}") for c in numeric]
    else:
        pick = F.min_by(row, F.when(won, F.struct(REF, row_id)))
        best = [pick.getField(c).alias(f"w__{c}") for c in numeric]
    per = df.groupBy(KEY).agg((F.sum("class") > 0).alias("won__"), F.min_by(row, draw).alias("l__"), *best)
    return per.select(KEY, *[F.when(F.col("won__"), F.col(f"w__{c}")).otherwise(F.col(f"l__.{c}")).alias(c) for c in numeric])


def latest_per_account(df: DataFrame) -> DataFrame:
    """All rows at each account's latest date."""
    last = df.groupBy(KEY).agg(F.max(REF).alias(REF))
    return df.join(last, [KEY, REF], "left_semi")
