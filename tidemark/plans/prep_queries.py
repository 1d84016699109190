"""Feature preparation on the given tables, with its SQL."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions import numeric as num
from ..functions import text as tx
from ..operators import asof, blocks, leads, prep, versions
from .block_queries import period_sql, rounded
from .cohort_queries import _SUF
from .registry import query
from .roles import PACKAGES, Roles, cte

_LAGGED = [f"{c}{s}" for s in ("", "__q1", "__q2", "__m1", "__m2") for c in [*PACKAGES, "n_env"]]

_TECH = {
    "rp": "SELECT p.account_id, p.relevant_date, environment_service_id, "
    + period_sql("u.art_create_date")
    + " AS period, "
    + ", ".join(f"max(CASE WHEN package_type = '{t}' THEN avg_repos ELSE 0 END) AS {n}" for n, t in PACKAGES.items())
    + " FROM pop p JOIN usage_part u USING (account_id) GROUP BY 1, 2, 3, 4",
    "rq": "SELECT account_id, relevant_date, period, CAST(count(*) AS DOUBLE) AS n_env, "
    + ", ".join(f"sum({n}) AS {n}" for n in PACKAGES)
    + " FROM rp WHERE period IS NOT NULL GROUP BY 1, 2, 3",
    "tech": "SELECT account_id, relevant_date, "
    + ", ".join(f"coalesce(max(CASE WHEN period = '{p}' THEN {c} END), -1) AS {c}{s}" for p, s in _SUF.items() for c in [*PACKAGES, "n_env"])
    + " FROM rq GROUP BY 1, 2",
}
TECH_CTE = cte("pop", "usage_part", also=_TECH)


def tech_frame(r: Roles):
    """Technology usage by window, missing windows filled with -1 (as in training)."""
    block = blocks.repo_pivot(r.pop(), r.usage(part=True), PACKAGES)
    block = block.withColumn("n_env", F.col("n_env").cast("double"))
    return prep.fill(asof.widen_periods(block, [*PACKAGES, "n_env"]), -1)


def _key(df, *cols):
    return df.select("account_id", "relevant_date", *cols)


@query(
    "tech_counts",
    TECH_CTE
    + "SELECT account_id, relevant_date, "
    + ", ".join(
        f"{' + '.join(f'CASE WHEN {c}{s} <> 0 THEN 1 ELSE 0 END' for c in PACKAGES)} AS n_tech{s}, {' + '.join(c + s for c in PACKAGES)} AS n_repos{s}"
        for s in _SUF.values()
    )
    + " FROM tech",
)
def tech_counts(spark, path):
    df = prep.tech_counts(tech_frame(Roles(spark, path)), list(PACKAGES))
    return _key(df, *[f"n_{k}{s}" for s in _SUF.values() for k in ("tech", "repos")])


_TOP = f"greatest({', '.join(PACKAGES)})"
_LEAD = "CASE " + " ".join(f"WHEN {c} = {_TOP} THEN '{c}'" for c in PACKAGES) + " END"


@query(
    "leading_tech",
    TECH_CTE + f"SELECT account_id, relevant_date, CASE WHEN t IN ('small', 'large') THEN 'else' ELSE t END AS leading_tech FROM (SELECT *, {_LEAD} AS t FROM tech)",
)
def leading_tech(spark, path):
    return _key(prep.leading(tech_frame(Roles(spark, path)), list(PACKAGES), ["small", "large"]), "leading_tech")


@query(
    "row_std",
    TECH_CTE + f"SELECT account_id, relevant_date, round(list_stddev_pop([{', '.join(PACKAGES)}]), 6) AS n_tech_std FROM tech",
)
def row_std(spark, path):
    return rounded(_key(prep.row_std(tech_frame(Roles(spark, path)), list(PACKAGES)), "n_tech_std"), ["n_tech_std"])


def step_sql(p: str, c: str) -> str:
    return f"(CASE WHEN {p} <> 0 THEN ({c} - {p}) / {p} WHEN {c} = {p} THEN 0 WHEN {c} > {p} THEN 1 ELSE CAST('-infinity' AS DOUBLE) END)"


def _growth_sql(f: str) -> str:
    m = f"round(({step_sql(f + '__m2', f + '__m1')} + {step_sql(f + '__m1', f)}) / 2, 6) + 0 AS {f}_monthly_growth"
    q = f"round(({step_sql(f + '__q2', f + '__q1')} + {step_sql(f + '__q1', f)}) / 2, 6) + 0 AS {f}_quarter_growth"
    return f"{m}, {q}"


_GROW = [*PACKAGES, "n_env"]


@query(
    "growth_features",
    TECH_CTE + "SELECT account_id, relevant_date, " + ", ".join(_growth_sql(f) for f in _GROW) + " FROM tech",
)
def growth_features(spark, path):
    df = prep.growth(tech_frame(Roles(spark, path)), _GROW)
    cols = [f"{f}_{k}_growth" for f in _GROW for k in ("monthly", "quarter")]
    return rounded(_key(df, *cols), cols)


@query(
    "growth_acceleration",
    TECH_CTE
    + f"""SELECT account_id, relevant_date, round(b, 6) + 0 AS q1_n_env_growth, round(a, 6) + 0 AS q2_n_env_growth, CASE WHEN b < a THEN 1 ELSE 0 END AS binary_n_env,
       round(d, 6) + 0 AS q1_promo_growth, round(c, 6) + 0 AS q2_promo_growth, CASE WHEN d < c THEN 1 ELSE 0 END AS binary_promo FROM
       (SELECT *, {step_sql('n_env__m2', 'n_env__m1')} AS a, {step_sql('n_env__m1', 'n_env')} AS b, promo__q1 - promo__q2 AS c, promo - promo__q1 AS d FROM tech)""",
)
def growth_acceleration(spark, path):
    df = prep.growth_pair(tech_frame(Roles(spark, path)), "n_env", keep_older=True)
    df = prep.growth_pair(df, "promo", scheme="quarter", normalize=False, keep_older=True)
    cols = [f"{q}_{f}_growth" for q in ("q1", "q2") for f in ("n_env", "promo")]
    return rounded(_key(df, *cols, "binary_n_env", "binary_promo"), cols)


@query(
    "safe_ratios",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0 ELSE round(l_tax / l_discount, 6) END AS guarded,
       CASE WHEN l_discount = 0 THEN NULL ELSE round(l_quantity / l_discount, 6) END AS unguarded FROM lineitem""",
)
def safe_ratios(spark, path):
    li = Roles(spark, path).table("lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.round(num.safe_ratio(F.col("l_tax"), F.col("l_discount")), 6).alias("guarded"),
        F.round(num.open_ratio(F.col("l_quantity"), F.col("l_discount")), 6).alias("unguarded"),
    )


@query("drop_columns_by_pattern", TECH_CTE + f"SELECT {', '.join([*PACKAGES, 'n_env'])} FROM tech")
def drop_columns_by_pattern(spark, path):
    return prep.drop_like(tech_frame(Roles(spark, path)), ["__q", "__m", "account_id", "relevant_date"])


_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_GAPPY = "SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount > 0 THEN l_discount END AS l_discount, CASE WHEN l_returnflag <> 'R' THEN l_tax END AS l_tax FROM lineitem"


@query(
    "fill_missing",
    f"""WITH g AS ({_GAPPY}) SELECT l_orderkey, l_linenumber, l_quantity, round(coalesce(l_discount, (SELECT avg(l_discount) FROM g)), 6) AS l_discount, coalesce(l_tax, -1) AS l_tax FROM g""",
)
def fill_missing(spark, path):
    li = Roles(spark, path).table("lineitem")
    g = li.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("l_tax"),
    )
    out = prep.fill(prep.fill(g, prep.training_means(g, ["l_discount"])), -1)
    return rounded(out, ["l_discount"])


_VAR = {"l_quantity": True, "l_extendedprice": True, "l_discount": True, "l_returnflag": False, "one": True, "word": False, "gap": False}


@query(
    "drop_zero_variance",
    "WITH f AS (SELECT *, 1 AS one, 'same' AS word, CASE WHEN l_tax > 0 THEN 'x' END AS gap FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {f'round(stddev_pop({c}), 6)' if n else 'CAST(NULL AS DOUBLE)'} AS std, count(DISTINCT {c}) {'' if n else f'+ max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)'} > 1 AS varies FROM f"
        for c, n in _VAR.items()
    ),
)
def drop_zero_variance(spark, path):
    li = Roles(spark, path).table("lineitem")
    df = li.select("*", F.lit(1).alias("one"), F.lit("same").alias("word"), F.when(F.col("l_tax") > 0, "x").alias("gap"))
    return rounded(prep.variance_table(df, list(_VAR)), ["std"])


def _kept(df, cols):
    """Which of the columns are still there, with their counts."""
    rest = [c for c in cols if c in df.columns]
    return df.select(*[F.col(c).cast("string").alias(c) for c in rest]).unpivot([], rest, "column", "value").groupBy("column").agg(F.count("value").alias("n"))


@query(
    "drop_flat_columns",
    "WITH f AS (SELECT *, 1 AS one, 'same' AS word, CASE WHEN l_tax > 0 THEN 'x' END AS gap FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n FROM f HAVING count(DISTINCT {c}) {'' if n else f'+ max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)'} > 1" for c, n in _VAR.items()
    ),
)
def drop_flat_columns(spark, path):
    """The columns that the drop leaves."""
    li = Roles(spark, path).table("lineitem")
    df = li.select("*", F.lit(1).alias("one"), F.lit("same").alias("word"), F.when(F.col("l_tax") > 0, "x").alias("gap")).select(*_VAR)
    return _kept(prep.drop_zero_variance(df), list(_VAR))


_CORR = {"qty": "l_quantity", "price": "l_extendedprice", "disc": "l_discount", "net": "l_extendedprice * (1 - l_discount)", "tax": "l_tax", "line": "l_linenumber"}


@query(
    "drop_by_correlation",
    "WITH f AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _CORR.items()) + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM f" for a, b in combinations(_CORR, 2)),
)
def drop_by_correlation(spark, path):
    li = Roles(spark, path).table("lineitem")
    df = li.select(*[F.expr(e).alias(n) for n, e in _CORR.items()])
    return rounded(prep.correlations(df, list(_CORR)), ["r"])


@query(
    "drop_correlated_columns",
    "WITH f AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _CORR.items()) + " FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{b}' AS \"column\", count({b}) AS n FROM f HAVING " + (" AND ".join(f"coalesce(abs(corr({a}, {b})), 0) <= 0.9" for a in list(_CORR)[:i]) or "true")
        for i, b in enumerate(_CORR)
    ),
)
def drop_correlated_columns(spark, path):
    """The columns that the drop leaves."""
    li = Roles(spark, path).table("lineitem")
    df = li.select(*[F.expr(e).alias(n) for n, e in _CORR.items()])
    return _kept(prep.drop_by_correlation(df, list(_CORR), 0.9), list(_CORR))


@query(
    "encode_categories",
    " ".join(
        [
            "WITH a AS (SELECT o_orderpriority AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS i FROM orders GROUP BY 1),",
            "b AS (SELECT o_orderstatus AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS DOUBLE) AS i FROM orders GROUP BY 1)",
            "SELECT o_orderkey, a.i AS o_orderpriority_idx, b.i AS o_orderstatus_idx FROM orders JOIN a ON a.v = o_orderpriority JOIN b ON b.v = o_orderstatus",
        ]
    ),
)
def encode_categories(spark, path):
    o = Roles(spark, path).table("orders")
    cols = ["o_orderpriority", "o_orderstatus"]
    return prep.encode(o, cols).transform(o).select("o_orderkey", *[f"{c}_idx" for c in cols])


@query(
    "align_train_test",
    "SELECT o_orderkey, o_totalprice, 'train' AS part FROM orders WHERE o_orderdate <= '1999-01-01' UNION ALL SELECT o_orderkey, o_totalprice, 'test' FROM orders WHERE o_orderdate > '1999-01-01'",
)
def align_train_test(spark, path):
    o = Roles(spark, path).table("orders")
    train = o.where("o_orderdate <= '1999-01-01'").drop("o_orderpriority", "o_custkey", "o_orderdate")
    test = o.where("o_orderdate > '1999-01-01'").drop("o_orderstatus", "o_custkey", "o_orderdate")
    a, b = prep.align(train, test)
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))


# ---------------------------------------------------------------- leads

_REASON = """CASE WHEN event_type = 'view' THEN 'Web.' || 'View Page' || ' Action Change' WHEN value > 60 THEN 'score' ELSE event_type END"""
_ACTS = {"view page": "Web.View Page Action Change", "click": "click", "signup": "signup", "purchase": "purchase"}


def _activity(r):
    e = r.table("events")
    reason = (
        F.when(F.col("event_type") == "view", F.lit("Web.View Page Action Change"))
        .when(F.col("value") > 60, F.lit("score"))
        .otherwise(F.col("event_type"))
    )
    return e.join(r.table("customer"), e["user_id"] == F.col("c_custkey")).select(
        F.col("user_id").alias("lead_id"),
        F.date_trunc("week", "ts").cast("date").alias("relevant_date"),
        reason.alias("reason"),
        F.col("ts").alias("activity_date"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
    )


_PIVOT = ", ".join(f"""count(CASE WHEN reason = '{v}' THEN 1 END) AS "CS-{n}" """ for n, v in _ACTS.items())


@query(
    "activity_pivot",
    f"""WITH a AS (SELECT user_id AS lead_id, {_REASON} AS reason, c_mktsegment AS segment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM events JOIN customer ON user_id = c_custkey)
        SELECT lead_id, segment, balance, {_PIVOT} FROM a GROUP BY 1, 2, 3""",
)
def activity_pivot(spark, path):
    df = _activity(Roles(spark, path)).drop("relevant_date")
    return leads.activity_pivot(df, ["lead_id"], allowed=list(_ACTS), exempt=("segment", "balance"))


@query(
    "activity_pivot_journeys",
    f"""WITH a AS (SELECT user_id AS lead_id, CAST(date_trunc('week', ts) AS DATE) AS relevant_date, {_REASON} AS reason, c_mktsegment AS segment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM events JOIN customer ON user_id = c_custkey)
        SELECT lead_id, relevant_date, segment, balance, {_PIVOT} FROM a WHERE balance IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def activity_pivot_journeys(spark, path):
    df = _activity(Roles(spark, path))
    return leads.activity_pivot(
        df, ["lead_id", "relevant_date"], allowed=list(_ACTS), attributes_complete=True, exempt=("segment", "balance")
    )


@query(
    "activity_vectors",
    f"""WITH a AS (SELECT user_id AS lead_id, {_REASON} AS reason FROM events JOIN customer ON user_id = c_custkey),
        named AS (SELECT lead_id, lower(CASE WHEN reason LIKE 'Web.%' THEN 'view page' ELSE reason END) AS act, count(*) AS n FROM a GROUP BY 1, 2),
        i AS (SELECT act, row_number() OVER (ORDER BY sum(n) DESC, act) - 1 AS idx FROM named WHERE act <> 'score' GROUP BY act HAVING sum(n) > 10)
        SELECT lead_id, act AS activity, idx, n FROM named JOIN i USING (act)""",
)
def activity_vectors(spark, path):
    """Activities of any number in sparse form, read back as (lead, activity, index, count)."""
    df = _activity(Roles(spark, path)).select("lead_id", "reason")
    index = leads.activity_index(df)
    entries = leads.activity_vectors(df, ["lead_id"], index).select("lead_id", F.explode(F.arrays_zip("indices", "counts")).alias("e"))
    return entries.select("lead_id", F.col("e.indices").alias("idx"), F.col("e.counts").alias("n")).join(index.select("activity", "idx"), "idx")


@query(
    "latest_trial_per_lead",
    """SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def latest_trial_per_lead(spark, path):
    e = Roles(spark, path).table("events").select("event_id", "user_id", "event_type", "value")
    return leads.latest_by(e, "user_id", "value", "event_id")


_LEADS_SQL = """SELECT c_custkey AS lead_id,
  CASE WHEN c_acctbal < 0 THEN 'unknown' WHEN c_nationkey < 10 THEN '+4' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') ELSE '05' || c_custkey END AS phone,
  CASE WHEN n_regionkey = 2 THEN 'APAC' ELSE 'EMEA' END AS territory, n_name AS country,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Webinar' WHEN 'FURNITURE' THEN 'Gated Content' ELSE c_mktsegment END AS leadsource,
  'u' || c_custkey || CASE WHEN c_nationkey < 5 THEN '@x.edu' WHEN c_nationkey < 8 THEN '@y.ac.uk' ELSE '@z.com' END AS email,
  c_custkey % 7 AS days_to_mql, c_nationkey AS days_to_decision, c_custkey % 11 AS n_reasons, c_custkey % 5 AS number_of_attempts, c_nationkey % 4 AS number_of_engagements,
  c_custkey % 3 AS total_form, c_custkey % 4 AS total_web, c_nationkey % 3 AS "CS-click" FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _leads(r):
    c, n = r.table("customer"), r.table("nation")
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    text = k.cast("string")
    return c.join(n, nk == F.col("n_nationkey")).select(
        k.alias("lead_id"),
        F.when(F.col("c_acctbal") < 0, "unknown")
        .when(nk < 10, F.concat(F.lit("+4"), F.lpad(text, 9, "0")))
        .otherwise(F.concat(F.lit("05"), text))
        .alias("phone"),
        F.when(F.col("n_regionkey") == 2, "APAC").otherwise("EMEA").alias("territory"),
        F.col("n_name").alias("country"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Webinar")
        .when(F.col("c_mktsegment") == "FURNITURE", "Gated Content")
        .otherwise(F.col("c_mktsegment"))
        .alias("leadsource"),
        F.concat(F.lit("u"), text, F.when(nk < 5, "@x.edu").when(nk < 8, "@y.ac.uk").otherwise("@z.com")).alias("email"),
        (k % 7).alias("days_to_mql"),
        nk.alias("days_to_decision"),
        (k % 11).alias("n_reasons"),
        (k % 5).alias("number_of_attempts"),
        (nk % 4).alias("number_of_engagements"),
        (k % 3).alias("total_form"),
        (k % 4).alias("total_web"),
        (nk % 3).alias("CS-click"),
    )


_PHONE = """CASE WHEN phone = 'unknown' THEN 'Phone number was not provided' WHEN regexp_full_match(phone, '\\+[1-9][0-9]{6,14}') THEN 'valid' ELSE 'invalid' END"""
_RATE = lambda n, d: f"round(CASE WHEN {d} = 0 THEN 0 ELSE CAST({n} AS DOUBLE) / {d} END, 6)"


@query(
    "lead_features",
    f"""WITH leads AS ({_LEADS_SQL}) SELECT lead_id, territory, days_to_mql, days_to_decision, n_reasons, number_of_attempts, number_of_engagements, total_form, total_web,
        CASE WHEN "CS-click" > 0 THEN 1 ELSE 0 END AS "CS-click", {_PHONE} AS has_valid_phone, CASE WHEN territory = 'APAC' THEN 'APAC' ELSE country END AS "country/territory",
        CASE WHEN leadsource IN ('other', 'Webinar', 'Gated Content') THEN 'other' ELSE leadsource END AS lead_source,
        CASE WHEN email LIKE '%.edu%' OR email LIKE '%.ac%' OR email LIKE '%.college%' THEN 1 ELSE 0 END AS is_student_email,
        {_RATE('n_reasons', 'days_to_mql')} AS "n_reasons / time to mql", {_RATE('number_of_attempts', 'days_to_decision')} AS "n_attempts / time in mql",
        {_RATE('number_of_engagements', 'days_to_decision')} AS "n_engagements / time in mql", CASE WHEN total_form >= total_web THEN 'total_form' ELSE 'total_web' END AS leading_analytics FROM leads""",
)
def lead_features(spark, path):
    df = leads.lead_features(_leads(Roles(spark, path)))
    rates = [c for c in df.columns if " / " in c]
    return df.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c in rates else F.col(f"`{c}`") for c in df.columns])


@query("phone_status", f"WITH leads AS ({_LEADS_SQL}) SELECT lead_id, {_PHONE} AS has_valid_phone FROM leads")
def phone_status(spark, path):
    return _leads(Roles(spark, path)).select("lead_id", tx.phone_status(F.col("phone")).alias("has_valid_phone"))


@query(
    "trial_usage_features",
    TECH_CTE
    + f"""SELECT account_id, relevant_date, {' + '.join(f'CASE WHEN {c} <> 0 THEN 1 ELSE 0 END' for c in PACKAGES)} AS n_tech,
       round(list_stddev_pop([{', '.join(PACKAGES)}]), 6) AS n_tech_std, {_LEAD} AS leading_tech,
       round(CASE WHEN promo__m1 = 0 THEN 0 ELSE promo / promo__m1 END, 6) + 0 AS "a_size_avg/b_size_avg", round(CASE WHEN n_env__m1 = 0 THEN 0 ELSE n_env / n_env__m1 END, 6) + 0 AS "a_count_avg/b_count_avg" FROM tech""",
)
def trial_usage_features(spark, path):
    df = tech_frame(Roles(spark, path)).select(
        "account_id",
        "relevant_date",
        *PACKAGES,
        F.col("promo").alias("a_size_avg"),
        F.col("promo__m1").alias("b_size_avg"),
        F.col("n_env").alias("a_count_avg"),
        F.col("n_env__m1").alias("b_count_avg"),
    )
    df = leads.trial_features(df, list(PACKAGES))
    outs = ["n_tech_std", "a_size_avg/b_size_avg", "a_count_avg/b_count_avg"]
    return df.select(
        "account_id", "relevant_date", "n_tech", "leading_tech", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in outs]
    )


@query(
    "domain_validity",
    """SELECT c_custkey, CASE WHEN regexp_full_match(u, '[0-9]+') OR u LIKE '%tests%' THEN 0 WHEN is_general <> 0 THEN 1 ELSE coalesce(is_valid, 0) END AS domain_is_valid FROM
       (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey AS VARCHAR) WHEN c_custkey % 7 = 0 THEN 'tests' || c_custkey ELSE lower(c_name) END AS u,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_general, 'd' || c_nationkey AS domain FROM customer) c
       LEFT JOIN (SELECT 'd' || s_nationkey AS domain, max(CASE WHEN s_acctbal > 7000 THEN 1 ELSE 0 END) AS is_valid FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) d ON c.domain = d.domain""",
)
def domain_validity(spark, path):
    r = Roles(spark, path)
    k = F.col("c_custkey")
    user = (
        F.when(k % 5 == 0, k.cast("string"))
        .when(k % 7 == 0, F.concat(F.lit("tests"), k.cast("string")))
        .otherwise(F.lower("c_name"))
    )
    df = r.table("customer").select(
        "c_custkey",
        F.concat(user, F.lit("@mail")).alias("email"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("is_general"),
        F.concat(F.lit("d"), F.col("c_nationkey").cast("string")).alias("domain"),
    )
    known = r.table("supplier").where("s_acctbal > 5000").select(
        F.concat(F.lit("d"), F.col("s_nationkey").cast("string")).alias("domain"),
        F.when(F.col("s_acctbal") > 7000, 1).otherwise(0).alias("is_valid"),
    )
    return leads.domain_validity(df, known).select("c_custkey", "domain_is_valid")


@query(
    "exclude_known_leads",
    "SELECT c_custkey AS email, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)",
)
def exclude_known_leads(spark, path):
    r = Roles(spark, path)
    trials = r.table("customer").select(F.col("c_custkey").alias("email"), "c_name")
    return leads.exclude_known(trials, r.table("events").select(F.col("user_id").alias("email")))


# ---------------------------------------------------------------- urls, paths, versions

_DOMAIN = """CASE WHEN regexp_matches(url, '^.+?\\..+?\\.') THEN CASE WHEN contains(regexp_extract(url, '^.+?\\..+?\\.(.*)$', 1), '.com') THEN 'com' ELSE regexp_extract(url, '^.+?\\..+?\\.(.*)$', 1) END END"""
_MAIN = "nullif(regexp_extract(url, '^(.*//.*?)/', 1), '')"


@query("url_domain", f"SELECT page_id, {_DOMAIN} AS domain FROM pages")
def url_domain(spark, path):
    return Roles(spark, path).table("pages").select("page_id", tx.url_domain(F.col("url")).alias("domain"))


@query(
    "main_url_distinct",
    f"SELECT lang, count(DISTINCT m) AS n_main_urls FROM (SELECT regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang, {_MAIN} AS m FROM pages) GROUP BY 1",
)
def main_url_distinct(spark, path):
    df = Roles(spark, path).table("pages").select(
        F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"), "url"
    )
    return versions.distinct_main_urls(df, "lang", "url")


@query(
    "main_url_distinct_list",
    """SELECT page_id, CAST(len(list_distinct(list_filter(list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: nullif(regexp_extract(x, '^(.*//.*?)/', 1), '')), lambda x: x IS NOT NULL))) AS INTEGER) AS n_main_urls FROM pages""",
)
def main_url_distinct_list(spark, path):
    urls = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return Roles(spark, path).table("pages").select("page_id", versions.distinct_main_urls_in(urls).alias("n_main_urls"))


_RUNS = "regexp_extract_all(url, '([0-9][0-9._-]*)', 1)"


@query(
    "artifact_path_parts",
    f"""SELECT page_id, file_name, file_type, version, CASE WHEN coalesce(rest, '') = '' THEN 0 ELSE coalesce(try_cast(left(version, 1) || '.' || rest AS DOUBLE), 0) END AS version_number FROM (
        SELECT *, regexp_replace(substr(version, 2), '[-_.]', '', 'g') AS rest FROM (
        SELECT page_id, CASE WHEN contains(url, '/') THEN regexp_extract(url, '([^/]*)$', 1) END AS file_name,
          CASE WHEN contains(url, '.') THEN regexp_extract(url, '([^.]*)$', 1) ELSE 'no file type' END AS file_type,
          list_filter({_RUNS}, lambda x: length(x) = list_max(list_transform({_RUNS}, lambda y: length(y))))[1] AS version FROM pages))""",
)
def artifact_path_parts(spark, path):
    return versions.path_parts(Roles(spark, path).table("pages").select("page_id", "url"), "url").drop("url")


_FILES = """SELECT CAST(l_shipdate AS DATE) AS date, CASE p_name WHEN 'red bolt' THEN 'release bolt' WHEN 'blue ring' THEN 'snapshot ring' WHEN 'small gear' THEN '' ELSE p_name END AS module_name,
  'f' || l_suppkey AS file_name, CASE WHEN l_discount > 0.09 THEN 'xml' ELSE 'jar' END AS file_type, floor(l_quantity / 10) AS version_num_value, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey"""


_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _files(r):
    li, p = r.table("lineitem"), r.table("part")
    name = (
        F.when(F.col("p_name") == "red bolt", "release bolt")
        .when(F.col("p_name") == "blue ring", "snapshot ring")
        .when(F.col("p_name") == "small gear", "")
        .otherwise(F.col("p_name"))
    )
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.col("l_shipdate").cast("date").alias("date"),
        name.alias("module_name"),
        F.concat(F.lit("f"), F.col("l_suppkey").cast("string")).alias("file_name"),
        F.when(F.col("l_discount") > 0.09, "xml").otherwise("jar").alias("file_type"),
        F.floor(F.col("l_quantity") / 10).cast("double").alias("version_num_value"),
        *_TIE,
    )


_WEEKLY = f"""WITH files AS ({_FILES}),
  num AS (SELECT *, row_number() OVER (ORDER BY module_name, date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos, lag(version_num_value) OVER (PARTITION BY module_name ORDER BY date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS prev FROM files),
  seen AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY module_name, file_name ORDER BY pos) = 1 THEN 1 ELSE 0 END AS fresh FROM num),
  run AS (SELECT *, sum(fresh) OVER (PARTITION BY module_name ORDER BY pos) AS so_far, CAST(floor((day(date) - 1) / 7) AS INTEGER) + 1 AS week_num FROM seen),
  good AS (SELECT *, row_number() OVER (PARTITION BY module_name, week_num ORDER BY pos) AS k FROM run WHERE pos > 1 AND module_name <> '' AND day(date) <= 28 AND file_type <> 'xml'),
  weekly AS (SELECT module_name, week_num, CAST(sum(CASE WHEN k > 1 AND version_num_value > prev THEN 1 ELSE 0 END) AS BIGINT) AS versioning_up_count,
   CAST(sum(CASE WHEN k > 1 AND version_num_value = prev THEN 1 ELSE 0 END) AS BIGINT) AS versioning_stuck_count,
   CAST(sum(CASE WHEN lower(module_name) LIKE '%release%' THEN 1 ELSE 0 END) AS BIGINT) AS is_release, CAST(sum(CASE WHEN lower(module_name) LIKE '%snapshot%' THEN 1 ELSE 0 END) AS BIGINT) AS is_snapshot,
   CAST(max(so_far) AS BIGINT) AS files_per_module FROM good GROUP BY 1, 2)
"""


@query("weekly_version_activity", _WEEKLY + "SELECT * FROM weekly")
def weekly_version_activity(spark, path):
    return versions.weekly_versions(_files(Roles(spark, path)), _TIE)


@query(
    "module_averages",
    _WEEKLY
    + """SELECT module_name, round(avg(versioning_up_count), 6) AS versioning_up_avg, round(avg(versioning_stuck_count), 6) AS versioning_stuck_avg, round(avg(is_release), 6) AS is_release_avg,
         round(avg(is_snapshot), 6) AS is_snapshot_avg, round(avg(files_per_module), 6) AS files_per_module_avg FROM weekly GROUP BY 1""",
)
def module_averages(spark, path):
    out = versions.module_averages(versions.weekly_versions(_files(Roles(spark, path)), _TIE))
    return rounded(out, [c for c in out.columns if c != "module_name"])


_Z = "abs((o_totalprice - m) / s) < 1.5"


@query(
    "remove_outliers_z",
    f"""SELECT o_orderkey, o_totalprice, csat FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END AS csat, avg(o_totalprice) OVER () AS m, stddev_pop(o_totalprice) OVER () AS s FROM orders)
        WHERE {_Z} OR csat IS NOT NULL""",
)
def remove_outliers_z(spark, path):
    df = Roles(spark, path).table("orders").select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", 1).alias("csat"), F.lit(7).alias("flat")
    )
    return prep.remove_outliers(df, ["o_totalprice", "flat"], score="csat", keep_scored=True, z=1.5).drop("flat")


@query(
    "point_multiplicity",
    "SELECT l_orderkey, l_linenumber, 2 * count(*) OVER (PARTITION BY l_discount, l_tax) AS point_size FROM lineitem",
)
def point_multiplicity(spark, path):
    li = Roles(spark, path).table("lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return prep.multiplicity(li, "l_discount", "l_tax").drop("l_discount", "l_tax")


@query("row_sha1", "SELECT doc_id, sha1(text) AS row_id FROM documents")
def row_sha1(spark, path):
    return Roles(spark, path).table("documents").select("doc_id", tx.sha1_id(F.col("text")).alias("row_id"))
