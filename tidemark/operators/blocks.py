"""Feature blocks: each returns at most one row per (account_id, relevant_date).

Blocks are thin specifications over `asof`; facts come with an `account_id`.
Text keywords, tiers and look-backs are parameters.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import day_due, day_floor, epoch_text_to_timestamp, month_number, month_start
from ..functions.numeric import safe_ratio
from . import asof
from .asof import KEY, REF, Back, asof_aggregate, asof_running, with_buckets
from .skew import hot_keys, spread_join

YEAR_FROM_MONTH_START = Back(months=12, from_month_start=True)
TWO_YEARS_FROM_MONTH_START = Back(months=24, from_month_start=True)
FOUR_MONTHS = Back(months=4)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Substring test for any of the words; null text gives null."""
    out = None
    for w in words:
        hit = text.contains(w)
        out = hit if out is None else out | hit
    return out


# ---------------------------------------------------------------- support


def support_cases(pop: DataFrame, movements: DataFrame, cases: DataFrame, parameter: int) -> DataFrame:
    """Distinct cases moved within 12 and within 3 months.

    movements: case_id, parameter_id, movement_date. cases: case_id, account_id.
    """
    # a case moves many times a day: one row per case and day before the join
    moved = movements.where(F.col("parameter_id") == parameter).select(
        "case_id", day_floor(F.col("movement_date")).alias("movement_date")
    ).distinct()
    fact = moved.join(cases, "case_id")
    # the window opens on the month's first day, the 12-month count on the exact day
    return asof_aggregate(
        pop,
        fact,
        "movement_date",
        {
            "cases_within_last_year": asof.distinct(late=Back(months=12)),
            "cases_within_3_last_months": asof.distinct(late=Back(months=3)),
        },
        YEAR_FROM_MONTH_START,
        distinct_of=F.col("case_id"),
    )


def poor_cases(pop: DataFrame, satisfaction: DataFrame, poor: Sequence[str]) -> DataFrame:
    """Cases of the last 12 months with a poor rating or a stated reason."""
    bad = F.col("support_experience").isin(list(poor)) | (F.col("reason") != "")
    fact = satisfaction.select(KEY, "case_created_date", F.when(bad, 1).otherwise(0).alias("bad"))
    return asof_aggregate(pop, fact, "case_created_date", {"n_poor_cases": asof.total(F.col("bad"))}, Back(months=12))


def case_topics(
    pop: DataFrame,
    cases: DataFrame,
    security: Sequence[str],
    ha_exact: str,
    ha_words: Sequence[str],
    docker: Sequence[str],
    closed: Sequence[str],
) -> DataFrame:
    """Subject keyword counts and mean resolution days of closed cases (12 months)."""
    low = F.lower(F.col("subject"))
    took = F.datediff(
        F.coalesce(F.col("resolved_time"), F.col("closeddate")).cast("date"), F.col("createddate").cast("date")
    )
    return asof_aggregate(
        pop,
        cases,
        "createddate",
        {
            "n_security_subject": asof.total(F.when(contains_any(low, security), 1).otherwise(0)),
            "n_ha_subject": asof.total(
                F.when(F.col("subject").contains(ha_exact) | contains_any(low, ha_words), 1).otherwise(0)
            ),
            "n_docker_subject": asof.total(F.when(contains_any(low, docker), 1).otherwise(0)),
            "avg_resolution_days": asof.mean(took, F.col("status").isin(list(closed))),
        },
        YEAR_FROM_MONTH_START,
    )


def issue_tracker_cases(
    pop: DataFrame, accounts: DataFrame, issues: DataFrame, unresolved: Sequence[str]
) -> DataFrame:
    """Issues filed under the account's name, at most 12 month boundaries back."""
    named = accounts.select(KEY, F.col("name").alias("account_name"))
    fact = spread_join(issues, named, "account_name", ["created", "status"], "inner").withColumn("created", day_floor(F.col("created")))
    return asof_aggregate(
        pop,
        fact,
        "created",
        {
            "n_issue_cases": asof.count(),
            "unresolved_issue_cases": asof.total(F.when(F.col("status").isin(list(unresolved)), 1).otherwise(0)),
        },
        Back(boundary_months=12),
    )


# ---------------------------------------------------------------- engagement


def sessions(pop: DataFrame, facts: DataFrame, name_words: Sequence[str], product: str) -> DataFrame:
    named = contains_any(F.lower(F.col("session_name")), name_words)
    about = (F.col("primary_product") == product) | (F.col("secondary_product") == product)
    return asof_aggregate(
        pop,
        facts,
        "session_createddate",
        {
            "total_sessions_past_year": asof.count(),
            "named_sessions_past_year": asof.total(F.when(named, 1).otherwise(0)),
            "product_sessions_past_year": asof.total(F.when(about, 1).otherwise(0)),
        },
        YEAR_FROM_MONTH_START,
    )


def training(
    pop: DataFrame, trainings: DataFrame, record_type: str, stage_excluded: str | None = None, back: Back | None = TWO_YEARS_FROM_MONTH_START
) -> DataFrame:
    """Distinct training times of one record type; `back=None` takes all before the date."""
    fact = trainings.where(F.col("record_type") == record_type)
    if stage_excluded is not None:
        fact = fact.where(F.col("stage") != stage_excluded)
    measures = {"n_training": asof.distinct()}
    if back is None:
        return asof_running(pop, fact, F.col("createddate"), measures, F.col("createddate"))
    return asof_aggregate(pop, fact, "createddate", measures, back, F.col("createddate"))


def trials(pop: DataFrame, trial_rows: DataFrame, enterprise: str) -> DataFrame:
    return asof_aggregate(
        pop,
        trial_rows,
        "createddate",
        {
            "n_trials": asof.distinct(),
            "n_ent_trials": asof.distinct(where=F.col("subscription_type") == enterprise),
        },
        TWO_YEARS_FROM_MONTH_START,
        F.col("createddate").cast("date"),
    )


def trials_dedup(pop: DataFrame, trial_rows: DataFrame, shift_hours: int) -> DataFrame:
    """Count trials, only the first per (contact, product, month), by their local day.

    The first row is taken by `min` instead of a ranking window, so no task has to
    sort all trials of one contact. Equal first times count once, as rank 1 does.
    """
    first = trial_rows.groupBy("who_id", "product", month_start(F.col("createddate")).alias("month__")).agg(
        F.min(F.struct("createddate", "trial_id", KEY)).alias("f")
    )
    fact = first.select(
        F.col(f"f.{KEY}").alias(KEY),
        (F.col("f.createddate") + F.expr(f"make_interval(0, 0, 0, 0, {shift_hours})")).cast("date").alias("local_day"),
    )
    return asof_aggregate(pop, fact, "local_day", {"total_trials": asof.count()}, YEAR_FROM_MONTH_START)


def page_views(
    pop: DataFrame, contacts: DataFrame, sessions_: DataFrame, views: DataFrame, patterns: Mapping[str, str], days: int = 90
) -> DataFrame:
    """Views by path pattern per contact over `days`, then the best contact's value."""
    # the narrow tables first, so that the views meet both in one join; adaptive execution splits a
    # busy device here, as no grouping by device follows
    whose = sessions_.select("session_id", "device_id").join(contacts.select(KEY, "contact_id", "device_id"), "device_id")
    fact = spread_join(views, whose, "session_id", [c for c in ("path", "view_date", "pageviews") if c in views.columns], "inner")
    fact = fact.withColumn("contact__", F.struct(KEY, "contact_id"))
    people = pop.join(contacts.select(KEY, "contact_id").distinct(), KEY).select(
        F.struct(KEY, "contact_id").alias("contact__"), REF
    )
    per_contact = asof_aggregate(
        people,
        fact,
        "view_date",
        {
            name: asof.total(F.when(F.col("path").contains(p), F.col("pageviews")).otherwise(0))
            for name, p in patterns.items()
        },
        Back(days=days),
        key="contact__",
    )
    return per_contact.groupBy(F.col(f"contact__.{KEY}").alias(KEY), REF).agg(
        *[F.max(n).alias(n) for n in patterns]
    )


def site_visits(pop: DataFrame, contacts: DataFrame, visits: DataFrame, name: str = "count_visits") -> DataFrame:
    """Distinct visit times before the date; the time comes as epoch text."""
    whose = contacts.where(F.col(KEY).isNotNull()).select(KEY, "client_id")
    timed = visits.withColumn("visit", epoch_text_to_timestamp(F.col("time_stamp"))).where("visit is not null")
    fact = spread_join(timed, whose, "client_id", "time_stamp", "inner", hot_keys(visits, ["client_id"])).withColumn("visit", F.col("visit").cast("timestamp_ntz"))
    return asof_running(pop, fact, F.col("visit"), {name: asof.distinct()}, F.col("visit"))


def keyword_mentions(
    pop: DataFrame, mentions: DataFrame, families: Mapping[str, Sequence[str]], months: int = 4, fmt: str = "MM/dd/yyyy"
) -> DataFrame:
    """Distinct mention dates per keyword family; dates are text in `fmt`.

    mentions: account_id, term, day_text. A dict of families replaces one
    expression per column; days are reduced once for all families.
    """
    # families without any row in a window still give 0, as long as the key has a row
    fact = mentions.withColumn("day__m", F.try_to_timestamp("day_text", F.lit(fmt)).cast("date"))
    return asof_aggregate(
        pop,
        fact,
        "day__m",
        {name: asof.distinct(where=F.col("term").isin(list(words))) for name, words in families.items()},
        Back(months=months),
        F.col("day_text"),
    )


def email_activity(
    pop: DataFrame, tasks: DataFrame, reply: str, sent: str, sent_text: str, call: str, topic: str
) -> DataFrame:
    """Distinct subjects replied to / sent / called about in 4 months, topic rows, reply rate."""
    kind, subject = F.col("task_type"), F.col("subject")
    out = asof_aggregate(
        pop,
        tasks,
        "createddate",
        {
            "n_replys": asof.distinct(where=kind == reply),
            "n_sent": asof.distinct(where=(kind == sent) | subject.contains(sent_text)),
            "n_calls": asof.distinct(where=kind == call),
            "n_task_topic": asof.total(F.when(F.lower(subject).contains(topic), 1).otherwise(0)),
        },
        FOUR_MONTHS,
        subject,
    )
    rate = F.when(F.col("n_sent") > 0, F.col("n_replys").cast("double") / F.col("n_sent")).otherwise(F.lit(-1.0))
    return out.withColumn("replys_to_sent", rate)


def days_since_activity(
    pop: DataFrame, tasks: DataFrame, reply: str, sent: str, sent_text: str, topic: str
) -> DataFrame:
    kind, subject, at = F.col("task_type"), F.col("subject"), F.col("createddate")
    out = asof_running(
        pop,
        tasks,
        at,
        {
            "days_since_reply": asof.largest(at, kind == reply),
            "days_since_sent": asof.largest(at, (kind == sent) | subject.contains(sent_text)),
            "days_since_topic": asof.largest(at, F.lower(subject).contains(topic)),
        },
    )
    return out.select(
        KEY,
        REF,
        *[
            F.datediff(F.col(REF), F.col(c).cast("date")).alias(c)
            for c in ("days_since_reply", "days_since_sent", "days_since_topic")
        ],
    )


# ---------------------------------------------------------------- contacts and contracts


def contacts(pop: DataFrame, people: DataFrame, title_words: Sequence[str]) -> DataFrame:
    """Distinct creation times up to the date, security titles, and their share."""
    hit = F.when(contains_any(F.lower(F.col("title")), title_words), 1).otherwise(0)
    at = F.col("createddate")
    out = asof_running(
        pop, people, at, {"n_contacts": asof.distinct(), "n_security_contacts": asof.total(hit)}, at
    )
    share = F.col("n_security_contacts").cast("double") / F.col("n_contacts")
    return out.withColumn("security_contacts_prop", share)


def days_since_contact(pop: DataFrame, people: DataFrame) -> DataFrame:
    at = F.col("createddate")
    out = asof_running(pop, people, at, {"last__": asof.largest(at)})
    return out.select(KEY, REF, F.datediff(F.col(REF), F.col("last__").cast("date")).alias("days_from_contact_added"))


def contracts_active(pop: DataFrame, contracts: DataFrame, cotermed: str, tiers: Mapping[str, Column]) -> DataFrame:
    """Distinct starts still active (also per tier) and a co-termed flag.

    A contract matters from the first of its start month. Being active is a +1 on
    that day and a -1 after the last end of the same start, so the open count at
    any date is a running sum: no join of dates with contracts.
    """
    opens = day_due(month_start(F.col("startdate")))
    wheres = {"n_active_contracts": F.lit(True), **tiers}
    rows = contracts.where(F.col("startdate").isNotNull()).withColumn("open__", opens)
    spans = rows.groupBy(KEY, "startdate", "open__").agg(
        *[F.max(F.when(w, F.col("enddate"))).alias(n) for n, w in wheres.items()]
    )
    steps = []
    for n in wheres:
        shuts = F.date_add(F.col(n).cast("date"), 1)
        alive = F.col(n).cast("date") >= F.col("open__")
        steps.append(F.when(alive, F.struct(F.lit(n).alias("name"), F.col("open__").alias("day"), F.lit(1).alias("step"))))
        steps.append(F.when(alive, F.struct(F.lit(n).alias("name"), shuts.alias("day"), F.lit(-1).alias("step"))))
    moves = spans.select(KEY, F.explode(F.array(*steps)).alias("m")).where("m is not null").select(KEY, "m.*")
    moves = moves.select(KEY, "day", *[F.when(F.col("name") == n, F.col("step")).otherwise(0).alias(n) for n in wheres])
    ended = F.greatest(F.col("open__"), day_due(F.col("enddate")))
    flags = rows.where((F.col("status") == cotermed) & F.col("enddate").isNotNull()).select(KEY, ended.alias("day"), F.lit(1).alias("is_cotermed"))
    seen = rows.select(KEY, F.col("open__").alias("day"), F.lit(1).alias("known"))
    events = moves.unionByName(flags, allowMissingColumns=True).unionByName(seen, allowMissingColumns=True)
    measures = {n: asof.total(F.col(n)) for n in wheres}
    measures["is_cotermed"] = asof.largest(F.col("is_cotermed"))
    measures["known"] = asof.largest(F.col("known"))
    out = asof_running(pop, events.where("day is not null"), F.col("day"), measures)
    return out.where("known = 1").select(
        KEY,
        REF,
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in wheres],
        F.coalesce("is_cotermed", F.lit(0)).alias("is_cotermed"),
    )


def server_interval_stab(pop: DataFrame, contracts: DataFrame, as_of: str, statuses: Mapping[str, str]) -> DataFrame:
    """Servers over the contracts whose [start, actual end] holds the reference date.

    statuses maps the roles cotermed / expired / activated / canceled to labels.
    Intervals and dates meet on (account, half-year bucket), never on the account alone.
    """
    s, end, today = F.col("status"), F.col("enddate"), F.lit(as_of).cast("date")
    actual = (
        F.when(s == statuses["cotermed"], F.coalesce(F.col("cotermed_date"), end))
        .when(s.isin(statuses["expired"], statuses["activated"]), F.coalesce(end, today))
        .when(s == statuses["canceled"], F.coalesce(F.col("cancellation_date"), end))
        .otherwise(F.coalesce(end, today))
    )
    spans = (
        contracts.where(s.isin(list(statuses.values())))
        .select(
            KEY,
            day_due(F.coalesce(F.col("startdate"), F.lit("2012-01-01").cast("date"))).alias("from__"),
            day_floor(actual).alias("to__"),
            F.coalesce("servers", "product_servers").alias("s"),
            F.coalesce("product_servers", "servers").alias("p"),
        )
        .where("from__ <= to__")
        .groupBy(KEY, "from__", "to__")
        .agg(*[f(c).alias(n) for f, c, n in _SERVER_FOLDS])
    )
    spans = with_buckets(spans, F.col("from__"), F.col("to__"), 6)
    asked = pop.select(KEY, REF).withColumn("bucket__", F.floor(month_number(F.col(REF)) / 6).cast("int"))
    hits = asked.join(spans, [KEY, "bucket__"]).where(F.col(REF).between(F.col("from__"), F.col("to__")))
    out = hits.groupBy(KEY, REF).agg(*[f(n).alias(n) for f, _, n in _SERVER_FOLDS])
    return out.select(
        KEY,
        REF,
        "max_servers",
        "min_servers",
        (F.col("max_servers") - F.col("min_servers")).alias("servers_diff"),
        "max_product_servers",
        "min_product_servers",
        (F.col("max_product_servers") - F.col("min_product_servers")).alias("product_servers_diff"),
    )


_SERVER_FOLDS = (
    (F.max, "s", "max_servers"),
    (F.min, "s", "min_servers"),
    (F.max, "p", "max_product_servers"),
    (F.min, "p", "min_product_servers"),
)


def qoe_exact(pop: DataFrame, scores: DataFrame) -> DataFrame:
    """The score of exactly the reference month (real rows only)."""
    live = scores.where("is_fictive = 0").select(KEY, F.col("create_date_monthly").alias(REF), "qoe_score")
    return pop.select(KEY, REF).join(live, [KEY, REF])


def cloud_subscription(pop: DataFrame, people: DataFrame, servers: DataFrame, trial: str) -> DataFrame:
    """Flag: some contact owned a non-trial server by the date."""
    # only an owner's first server matters for a flag
    real = servers.where(F.col("server_type") != trial).groupBy("owner_email").agg(F.min("created").alias("created"))
    fact = people.join(real, people["email"] == real["owner_email"]).select(KEY, "created")
    return asof_running(pop, fact, F.col("created"), {"n": asof.count()}).select(
        KEY, REF, F.lit(1).alias("have_cloud_subscription")
    )


def failed_opportunities(pop: DataFrame, opps: DataFrame, lost: str, without: str, within: str, new_business: str) -> DataFrame:
    name = F.lower(F.col("name"))
    fact = opps.where(
        (F.col("iswon") == lost) & ~name.contains(without) & name.contains(within) & (F.col("type") != new_business)
    )
    at = F.col("createddate")
    return asof_running(pop, fact, at, {"n_fail_opp": asof.distinct()}, at)


def db_flag(pop: DataFrame, snaps: DataFrame, db_type: str) -> DataFrame:
    """1 if any snapshot of the last month runs on the given database, else 0."""
    fact = snaps.withColumn("hit", F.when(F.col("db_type") == db_type, 1).otherwise(0))
    return asof_aggregate(pop, fact, "art_create_date", {"is_db": asof.largest(F.col("hit"))}, Back(months=1))


# ---------------------------------------------------------------- usage


def repo_pivot(
    pop: DataFrame, snaps: DataFrame, types: Mapping[str, str], periods: Sequence[asof.Period] = asof.FIVE_PERIODS
) -> DataFrame:
    """Per package type: best value per environment and period, summed over environments."""
    inner = {
        name: asof.largest(F.when(F.col("package_type") == t, F.col("avg_repos")).otherwise(F.lit(0.0)))
        for name, t in types.items()
    }
    return asof.usage_block(pop, snaps, "environment_service_id", "art_create_date", inner, periods, n_env="n_env")


def storage_usage(
    pop: DataFrame, snaps: DataFrame, measures: Sequence[str], periods: Sequence[asof.Period] = asof.FIVE_PERIODS, version: bool = False
) -> DataFrame:
    """Environment means per period, summed over environments (optionally top version)."""
    inner = {m: asof.mean(F.col(m)) for m in measures}
    outer = {}
    if version:
        inner["version"] = asof.largest(F.substring("version", 1, 1))
        outer["version"] = "max"
    return asof.usage_block(pop, snaps, "environment_service_id", "art_create_date", inner, periods, outer)


def user_usage(
    pop: DataFrame, snaps: DataFrame, measures: Sequence[str] = ("number_of_permissions", "internal_groups", "number_of_users"),
    periods: Sequence[asof.Period] = asof.FIVE_PERIODS,
) -> DataFrame:
    return storage_usage(pop, snaps, measures, periods)


def replication_usage(pop: DataFrame, snaps: DataFrame, flags: Mapping[str, Column], periods: Sequence[asof.Period]) -> DataFrame:
    """Environment means of the value where a replication flag holds (0 elsewhere), summed."""
    inner = {n: asof.mean(F.when(c, F.col("avg_repos")).otherwise(F.lit(0.0))) for n, c in flags.items()}
    return asof.usage_block(pop, snaps, "environment_service_id", "art_create_date", inner, periods)


# ---------------------------------------------------------------- account-level (no date)


def firmographics(
    people: DataFrame, contact_map: DataFrame, accounts: DataFrame, tops: Mapping[str, str], roles: Mapping[str, Column],
    any_role: tuple[str, Column],
) -> DataFrame:
    """Maxima of descriptive columns and distinct people by role, per account.

    People are reduced to one row per (account, e-mail) and per (account, id)
    before counting, so distinct counts need no per-condition expansion.
    """
    rows = spread_join(people, contact_map.select("person_id", KEY), "person_id", "email", "inner")
    name, cond = any_role
    by_mail = rows.groupBy(KEY, "email").agg(
        *[F.max(src).alias(dst) for dst, src in tops.items()],
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in roles.items()],
    )
    mail = by_mail.groupBy(KEY).agg(
        *[F.max(d).alias(d) for d in tops],
        F.count("email").alias("total_employees_with_details"),
        *[F.count(F.when((F.col(n) == 1) & F.col("email").isNotNull(), 1)).alias(n) for n in roles],
    )
    by_id = rows.where(cond).select(KEY, "person_id").distinct().groupBy(KEY).agg(F.count("person_id").alias(name))
    # accounts only select, so they meet one row per account instead of all people
    known = mail.join(accounts.select(KEY), KEY, "left_semi")
    return known.join(by_id, KEY, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def company_profile(ids: DataFrame, attributes: DataFrame, industry: DataFrame) -> DataFrame:
    """Distinct company attributes; private if no ticker is known."""
    primary = industry.where(F.col("isprimary")).drop("isprimary")
    kind = F.when(F.col("stock_ticker").isNull(), F.lit("private")).otherwise(F.lit("public"))
    return (
        ids.where("company_id is not null")
        .join(attributes, "company_id", "left")
        .join(primary, "company_id", "left")
        .withColumn("public_or_private", kind)
        .drop("stock_ticker")
        .distinct()
    )


def open_pipeline(opps: DataFrame, as_of: str, months: int = 13) -> DataFrame:
    """Open opportunity money per account since the month `months` back."""
    since = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), -months)
    return (
        opps.where((F.col("contract_expiry") >= since) & (F.col("isclosed") == "false"))
        .groupBy(KEY)
        .agg(
            F.sum("arr_growth").alias("expected_arr_growth"),
            F.sum("previous_arr").alias("related_contracts_arr"),
            F.sum("arr").alias("expected_arr"),
        )
    )


def top_subscription(accounts: DataFrame, logos: DataFrame, ladder: Sequence[str]) -> DataFrame:
    """Best tier over all accounts of a parent; `ladder` lists tiers best first."""
    rank = F.coalesce(*[F.when(F.col("top_subscription") == t, F.lit(i)) for i, t in enumerate(ladder)])
    # reduce accounts to their parent before meeting the parent table
    best = accounts.groupBy("logo").agg(F.min(rank).alias("r"))
    label = F.coalesce(*[F.when(F.col("r") == i, F.lit(t)) for i, t in enumerate(ladder)])
    return best.join(logos, "logo").select("logo", "number_of_accounts", label.alias("top_sub"))
