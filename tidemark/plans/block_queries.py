"""Point-in-time feature blocks on the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, blocks
from ..operators.asof import FIVE_PERIODS, Back, asof_aggregate, four_periods
from .registry import query
from .roles import AS_OF, PACKAGES, STORAGE, TOUCH_DATES, USERS, Roles, cte

_P = "CAST(date_trunc('month', p.relevant_date) AS DATE)"


def back_sql(months: int, start: bool = False, ref: str = "p.relevant_date") -> str:
    base = f"date_trunc('month', {ref})" if start else ref
    return f"CAST({base} - INTERVAL {months} MONTH AS DATE)"


def period_sql(day: str, ref: str = "p.relevant_date", periods=FIVE_PERIODS) -> str:
    arms = []
    for p in periods:
        base = ref if p.anchor is None else f"DATE '{p.anchor}'"
        arms.append(
            f"WHEN {day} BETWEEN CAST({base} - INTERVAL {p.lo} MONTH AS DATE) AND CAST({base} - INTERVAL {p.hi} MONTH AS DATE) THEN '{p.label}'"
        )
    return "CASE " + " ".join(arms) + " END"


def rounded(df, cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- periods and usage

@query(
    "period_bucket",
    cte("pop", "usage")
    + f"""SELECT period, CAST(count(*) AS BIGINT) AS n, min(age) AS min_age, max(age) AS max_age FROM (
      SELECT {period_sql('u.art_create_date')} AS period, date_diff('day', u.art_create_date, p.relevant_date) AS age
      FROM pop p JOIN (SELECT DISTINCT account_id, art_create_date FROM usage) u USING (account_id)) WHERE period IS NOT NULL GROUP BY 1""",
)
def period_bucket(spark, path):
    r = Roles(spark, path)
    days = r.usage().select("account_id", "art_create_date").distinct()
    # the widest window is seven months: meet on (account, month) within it only
    ref = F.col("relevant_date")
    days = days.withColumn("bucket__", asof.month_number(F.col("art_create_date")))
    wanted = asof.with_buckets(r.pop(), F.add_months(ref, -7), ref, 1)
    out = wanted.join(days, ["account_id", "bucket__"]).select(
        asof.period_bucket(F.col("art_create_date"), ref).alias("period"),
        F.datediff(ref, "art_create_date").cast("bigint").alias("age"),
    )
    return out.where("period is not null").groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.min("age").alias("min_age"), F.max("age").alias("max_age")
    )


@query(
    "repo_pivot",
    cte("pop", "usage_part")
    + "SELECT account_id, relevant_date, period, count(*) AS n_env, "
    + ", ".join(f"sum({n}) AS {n}" for n in PACKAGES)
    + f""" FROM (SELECT p.account_id, p.relevant_date, environment_service_id, {period_sql('u.art_create_date')} AS period, """
    + ", ".join(f"max(CASE WHEN package_type = '{t}' THEN avg_repos ELSE 0 END) AS {n}" for n, t in PACKAGES.items())
    + " FROM pop p JOIN usage_part u USING (account_id) GROUP BY 1, 2, 3, 4) WHERE period IS NOT NULL GROUP BY 1, 2, 3",
)
def repo_pivot(spark, path):
    r = Roles(spark, path)
    return blocks.repo_pivot(r.pop(), r.usage(part=True), PACKAGES)


def usage_sql(inner: dict[str, str], outer: dict[str, str] | None = None, periods=FIVE_PERIODS, role="usage") -> str:
    outer = outer or {n: f"round(sum({n}), 6)" for n in inner}
    return (
        cte("pop", role)
        + "SELECT account_id, relevant_date, period, "
        + ", ".join(f"{e} AS {n}" for n, e in outer.items())
        + f" FROM (SELECT p.account_id, p.relevant_date, environment_service_id, {period_sql('u.art_create_date', periods=periods)} AS period, "
        + ", ".join(f"{e} AS {n}" for n, e in inner.items())
        + f" FROM pop p JOIN {role} u USING (account_id) GROUP BY 1, 2, 3, 4) WHERE period IS NOT NULL GROUP BY 1, 2, 3"
    )


@query(
    "storage_usage",
    usage_sql(
        {**{m: f"avg({m})" for m in STORAGE}, "version": "max(left(version, 1))"},
        {**{m: f"round(sum({m}), 6)" for m in STORAGE}, "version": "max(version)"},
        role="usage_part",
    ),
)
def storage_usage(spark, path):
    r = Roles(spark, path)
    return rounded(blocks.storage_usage(r.pop(), r.usage(part=True), STORAGE, version=True), STORAGE)


@query("user_usage", usage_sql({m: f"avg({m})" for m in USERS}))
def user_usage(spark, path):
    r = Roles(spark, path)
    return rounded(blocks.user_usage(r.pop(), r.usage()), USERS)


_REPL = {"pull_replications": "flag = 'A'", "push_replications": "db_type = 'O'", "event_replications": "flag = 'R'"}


@query(
    "replication_usage",
    usage_sql({n: f"avg(CASE WHEN {c} THEN avg_repos ELSE 0 END)" for n, c in _REPL.items()}, periods=four_periods(AS_OF)),
)
def replication_usage(spark, path):
    r = Roles(spark, path)
    flags = {
        "pull_replications": F.col("flag") == "A",
        "push_replications": F.col("db_type") == "O",
        "event_replications": F.col("flag") == "R",
    }
    return rounded(blocks.replication_usage(r.pop(), r.usage(), flags, four_periods(AS_OF)), list(flags))


_ALL = STORAGE + USERS
_SERIES = (
    "SELECT account_id, art_create_date AS snapshot_date, "
    + ", ".join(f"round(sum({m}), 2) AS {m}" for m in _ALL)
    + " FROM usage GROUP BY 1, 2"
)


@query(
    "usage_over_time",
    cte("pop", "usage", also={"series": _SERIES})
    + "SELECT p.account_id, p.relevant_date, p.class, snapshot_date, "
    + ", ".join(_ALL)
    + " FROM pop p JOIN series s ON p.account_id = s.account_id AND snapshot_date <= p.relevant_date",
)
def usage_over_time(spark, path):
    r = Roles(spark, path)
    return rounded(asof.over_time(r.pop(), r.usage(), "art_create_date", _ALL), _ALL, 2)


def _change_sql() -> str:
    parts = []
    for m in _ALL:
        parts.append(
            f"""c_{m} AS (SELECT account_id, relevant_date, date_diff('day', max(snapshot_date), relevant_date) AS d FROM
            (SELECT account_id, relevant_date, snapshot_date, {m} AS v,
             first_value({m}) OVER (PARTITION BY account_id, relevant_date ORDER BY snapshot_date DESC) AS latest FROM ot)
            WHERE v <> latest GROUP BY 1, 2)"""
        )
    cols = ", ".join(f"CAST(c_{m}.d AS INTEGER) AS days_from_{m}_change" for m in _ALL)
    joins = " ".join(f"LEFT JOIN c_{m} USING (account_id, relevant_date)" for m in _ALL)
    some = " OR ".join(f"c_{m}.d IS NOT NULL" for m in _ALL)
    head = cte(
        "pop", "usage",
        also={"series": _SERIES, "ot": "SELECT p.account_id, p.relevant_date, s.* EXCLUDE (account_id) FROM pop p JOIN series s ON p.account_id = s.account_id AND snapshot_date <= p.relevant_date"},
    )
    return head + ", " + ",\n".join(parts) + f" SELECT p.account_id, p.relevant_date, {cols} FROM pop p {joins} WHERE {some}"


@query("days_since_last_change", _change_sql())
def days_since_last_change(spark, path):
    r = Roles(spark, path)
    return asof.days_since_change(r.pop(), r.usage(), "art_create_date", _ALL, digits=2)


@query(
    "security_scan_usage",
    cte("pop", "usage")
    + """SELECT p.account_id, p.relevant_date, round(avg(artifacts_count), 6) AS mean_policies, round(avg(artifacts_size), 6) AS mean_violations,
       CAST(date_diff('day', max(art_create_date), p.relevant_date) AS INTEGER) AS days_from_last_scan
       FROM pop p JOIN usage u ON p.account_id = u.account_id AND date_diff('day', art_create_date, p.relevant_date) BETWEEN 0 AND 90 GROUP BY 1, 2""",
)
def security_scan_usage(spark, path):
    """The scan-report family needs no operator of its own: means and recency over 90 days."""
    r = Roles(spark, path)
    out = asof_aggregate(
        r.pop(),
        r.usage(),
        "art_create_date",
        {
            "mean_policies": asof.mean(F.col("artifacts_count")),
            "mean_violations": asof.mean(F.col("artifacts_size")),
            "last_scan": asof.largest(F.col("art_create_date")),
        },
        Back(days=90),
    )
    out = out.withColumn("days_from_last_scan", F.datediff("relevant_date", "last_scan")).drop("last_scan")
    return rounded(out, ["mean_policies", "mean_violations"])


@query(
    "db_flag",
    cte("pop", "usage")
    + f"""SELECT p.account_id, p.relevant_date, max(CASE WHEN db_type = 'O' THEN 1 ELSE 0 END) AS is_db FROM pop p JOIN usage u USING (account_id)
       WHERE art_create_date BETWEEN {back_sql(1)} AND p.relevant_date GROUP BY 1, 2""",
)
def db_flag(spark, path):
    r = Roles(spark, path)
    return blocks.db_flag(r.pop(), r.usage(), "O")


# ---------------------------------------------------------------- support and engagement

@query(
    "support_cases",
    cte("pop")
    + f"""SELECT p.account_id, p.relevant_date,
       count(DISTINCT CASE WHEN md BETWEEN {back_sql(12)} AND p.relevant_date THEN case_id END) AS cases_within_last_year,
       count(DISTINCT CASE WHEN md BETWEEN {back_sql(3)} AND p.relevant_date THEN case_id END) AS cases_within_3_last_months
       FROM (SELECT o_custkey AS account_id, o_orderkey AS case_id, CAST(l_shipdate AS DATE) AS md FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linenumber = 1) c
       JOIN pop p USING (account_id) WHERE md BETWEEN {back_sql(12, True)} AND p.relevant_date GROUP BY 1, 2""",
)
def support_cases(spark, path):
    r = Roles(spark, path)
    moves = r.table("lineitem").select(
        F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("parameter_id"), F.col("l_shipdate").alias("movement_date")
    )
    cases = r.table("orders").select(F.col("o_orderkey").alias("case_id"), F.col("o_custkey").alias("account_id"))
    return blocks.support_cases(r.pop(), moves, cases, 1)


@query(
    "poor_cases",
    cte("pop")
    + f"""SELECT p.account_id, p.relevant_date, CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus <> 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_poor_cases
       FROM orders JOIN pop p ON o_custkey = p.account_id WHERE o_orderdate BETWEEN {back_sql(12)} AND p.relevant_date GROUP BY 1, 2""",
)
def poor_cases(spark, path):
    r = Roles(spark, path)
    sat = r.table("orders").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("case_created_date"),
        F.col("o_orderpriority").alias("support_experience"),
        F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")).alias("reason"),
    )
    return blocks.poor_cases(r.pop(), sat, ["1-URGENT", "2-HIGH"])


_TASKS = "tasks AS (SELECT account_id, subject, flag, db_type, opened, art_create_date FROM usage_part)"


@query(
    "case_topics",
    cte("pop", "usage_part")
    + f"""SELECT p.account_id, p.relevant_date,
       CAST(sum(CASE WHEN lower(subject) LIKE '%widget%' OR lower(subject) LIKE '%gear%' THEN 1 ELSE 0 END) AS BIGINT) AS n_security_subject,
       CAST(sum(CASE WHEN subject LIKE '%Ring%' OR lower(subject) LIKE '%ring%' THEN 1 ELSE 0 END) AS BIGINT) AS n_ha_subject,
       CAST(sum(CASE WHEN lower(subject) LIKE '%bolt%' THEN 1 ELSE 0 END) AS BIGINT) AS n_docker_subject,
       round(avg(CASE WHEN db_type = 'F' THEN date_diff('day', CAST(opened AS DATE), art_create_date) END), 6) AS avg_resolution_days
       FROM pop p JOIN usage_part u USING (account_id) WHERE CAST(opened AS DATE) BETWEEN {back_sql(12, True)} AND p.relevant_date GROUP BY 1, 2""",
)
def case_topics(spark, path):
    r = Roles(spark, path)
    cases = r.usage(part=True).select(
        "account_id",
        "subject",
        F.col("db_type").alias("status"),
        F.col("opened").alias("createddate"),
        F.lit(None).cast("date").alias("resolved_time"),
        F.col("art_create_date").alias("closeddate"),
    )
    out = blocks.case_topics(r.pop(), cases, ["widget", "gear"], "Ring", ["ring"], ["bolt"], ["F"])
    return rounded(out, ["avg_resolution_days"])


@query(
    "issue_tracker_cases",
    cte("pop")
    + """SELECT p.account_id, p.relevant_date, count(*) AS n_issue_cases,
       CAST(sum(CASE WHEN o_orderstatus IN ('P', 'O') THEN 1 ELSE 0 END) AS BIGINT) AS unresolved_issue_cases
       FROM pop p JOIN customer ON p.account_id = c_custkey JOIN orders ON o_custkey = c_custkey
       WHERE date_diff('month', CAST(o_orderdate AS DATE), p.relevant_date) <= 12 AND p.relevant_date >= CAST(o_orderdate AS DATE) GROUP BY 1, 2""",
)
def issue_tracker_cases(spark, path):
    r = Roles(spark, path)
    issues = r.table("orders").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("account_name"),
        F.col("o_orderdate").alias("created"),
        F.col("o_orderstatus").alias("status"),
    )
    return blocks.issue_tracker_cases(r.pop(), r.accounts(), issues, ["P", "O"])


@query(
    "sessions",
    cte("pop", "usage_part")
    + f"""SELECT p.account_id, p.relevant_date, count(*) AS total_sessions_past_year,
       CAST(sum(CASE WHEN lower(subject) LIKE '%widget%' THEN 1 ELSE 0 END) AS BIGINT) AS named_sessions_past_year,
       CAST(sum(CASE WHEN flag = 'A' OR db_type = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS product_sessions_past_year
       FROM pop p JOIN usage_part u USING (account_id) WHERE art_create_date BETWEEN {back_sql(12, True)} AND p.relevant_date GROUP BY 1, 2""",
)
def sessions(spark, path):
    r = Roles(spark, path)
    facts = r.usage(part=True).select(
        "account_id",
        F.col("subject").alias("session_name"),
        F.col("flag").alias("primary_product"),
        F.col("db_type").alias("secondary_product"),
        F.col("art_create_date").alias("session_createddate"),
    )
    return blocks.sessions(r.pop(), facts, ["widget"], "A")


def _trainings(r):
    return r.table("orders").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderpriority").alias("record_type"),
        F.col("o_orderstatus").alias("stage"),
        F.col("o_orderdate").alias("createddate"),
    )


@query(
    "training",
    cte("pop")
    + f"""SELECT p.account_id, p.relevant_date, count(DISTINCT o_orderdate) AS n_training FROM pop p JOIN orders ON o_custkey = p.account_id
       WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus <> 'P' AND o_orderdate BETWEEN {back_sql(24, True)} AND p.relevant_date GROUP BY 1, 2""",
)
def training(spark, path):
    r = Roles(spark, path)
    return blocks.training(r.pop(), _trainings(r), "3-MEDIUM", "P")


@query(
    "training_all",
    cte("pop")
    + """SELECT p.account_id, p.relevant_date, count(DISTINCT o_orderdate) AS n_training FROM pop p JOIN orders ON o_custkey = p.account_id
       WHERE o_orderpriority = '3-MEDIUM' AND o_orderdate <= p.relevant_date GROUP BY 1, 2""",
)
def training_all(spark, path):
    r = Roles(spark, path)
    return blocks.training(r.pop(), _trainings(r), "3-MEDIUM", back=None)


@query(
    "trials",
    cte("pop_touch")
    + f"""SELECT p.account_id, p.relevant_date, count(DISTINCT CAST(ts AS DATE)) AS n_trials,
       count(DISTINCT CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS n_ent_trials
       FROM pop_touch p JOIN events ON user_id = p.account_id WHERE ts BETWEEN {back_sql(24, True)} AND p.relevant_date GROUP BY 1, 2""",
)
def trials(spark, path):
    r = Roles(spark, path)
    rows = r.touch().select("account_id", F.col("ts").alias("createddate"), F.col("event_type").alias("subscription_type"))
    return blocks.trials(r.pop_touch(), rows, "purchase")


@query(
    "trials_dedup",
    cte("pop_touch")
    + f"""SELECT p.account_id, p.relevant_date, count(*) AS total_trials FROM
       (SELECT user_id AS account_id, CAST(ts - INTERVAL 7 HOUR AS DATE) AS local_day,
        row_number() OVER (PARTITION BY user_id, event_type, date_trunc('month', ts) ORDER BY ts, event_id) AS rn FROM events) t
       JOIN pop_touch p USING (account_id) WHERE rn = 1 AND local_day BETWEEN {back_sql(12, True)} AND p.relevant_date GROUP BY 1, 2""",
)
def trials_dedup(spark, path):
    r = Roles(spark, path)
    rows = r.touch().select(
        "account_id",
        F.col("account_id").alias("who_id"),
        F.col("event_type").alias("product"),
        F.col("ts").alias("createddate"),
        F.col("event_id").alias("trial_id"),
    )
    return blocks.trials_dedup(r.pop_touch(), rows, -7)


def _people(r):
    return r.table("orders").select(
        F.col("o_custkey").alias("account_id"), F.col("o_orderdate").alias("createddate"), F.col("o_orderpriority").alias("title")
    )


@query(
    "contacts",
    cte("pop")
    + """SELECT account_id, relevant_date, n_contacts, n_security_contacts, round(CAST(n_security_contacts AS DOUBLE) / n_contacts, 6) AS security_contacts_prop FROM
       (SELECT p.account_id, p.relevant_date, count(DISTINCT o_orderdate) AS n_contacts,
        CAST(sum(CASE WHEN lower(o_orderpriority) LIKE '%urgent%' OR lower(o_orderpriority) LIKE '%high%' THEN 1 ELSE 0 END) AS BIGINT) AS n_security_contacts
        FROM pop p JOIN orders ON o_custkey = p.account_id WHERE o_orderdate <= p.relevant_date GROUP BY 1, 2)""",
)
def contacts(spark, path):
    r = Roles(spark, path)
    return rounded(blocks.contacts(r.pop(), _people(r), ["urgent", "high"]), ["security_contacts_prop"])


@query(
    "days_since_contact",
    cte("pop")
    + """SELECT p.account_id, p.relevant_date, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), p.relevant_date) AS INTEGER) AS days_from_contact_added
       FROM pop p JOIN orders ON o_custkey = p.account_id WHERE o_orderdate <= p.relevant_date GROUP BY 1, 2""",
)
def days_since_contact(spark, path):
    r = Roles(spark, path)
    return blocks.days_since_contact(r.pop(), _people(r))


@query(
    "contracts_active",
    cte("pop", "contracts")
    + """SELECT p.account_id, p.relevant_date, count(DISTINCT CASE WHEN p.relevant_date <= enddate THEN startdate END) AS n_active_contracts,
       max(CASE WHEN status = 'P' AND p.relevant_date >= enddate THEN 1 ELSE 0 END) AS is_cotermed,
       count(DISTINCT CASE WHEN tier LIKE '%U%' AND p.relevant_date <= enddate THEN startdate END) AS count_ent,
       count(DISTINCT CASE WHEN tier = '2-HIGH' AND p.relevant_date <= enddate THEN startdate END) AS count_prox,
       count(DISTINCT CASE WHEN tier = '5-LOW' AND p.relevant_date <= enddate THEN startdate END) AS count_pro
       FROM pop p JOIN contracts c USING (account_id) WHERE p.relevant_date >= date_trunc('month', startdate) GROUP BY 1, 2""",
)
def contracts_active(spark, path):
    r = Roles(spark, path)
    tiers = {
        "count_ent": F.col("tier").contains("U"),
        "count_prox": F.col("tier") == "2-HIGH",
        "count_pro": F.col("tier") == "5-LOW",
    }
    return blocks.contracts_active(r.pop(), r.contracts(), "P", tiers)


@query(
    "server_interval_stab",
    cte("pop", "contracts")
    + f"""SELECT *, max_servers - min_servers AS servers_diff, max_product_servers - min_product_servers AS product_servers_diff FROM
       (SELECT p.account_id, p.relevant_date, max(s) AS max_servers, min(s) AS min_servers, max(q) AS max_product_servers, min(q) AS min_product_servers
        FROM (SELECT account_id, coalesce(startdate, DATE '2012-01-01') AS a,
              CASE WHEN status = 'P' THEN coalesce(cotermed_date, enddate) WHEN status = 'F' THEN coalesce(enddate, DATE '{AS_OF}')
                   WHEN status = 'O' THEN coalesce(cancellation_date, enddate) END AS b,
              coalesce(servers, product_servers) AS s, coalesce(product_servers, servers) AS q FROM contracts) c
        JOIN pop p USING (account_id) WHERE p.relevant_date BETWEEN a AND b GROUP BY 1, 2)""",
)
def server_interval_stab(spark, path):
    r = Roles(spark, path)
    labels = {"cotermed": "P", "expired": "F", "activated": "A", "canceled": "O"}
    return blocks.server_interval_stab(r.pop(), r.contracts(), AS_OF, labels)


@query(
    "qoe_exact",
    cte("pop_month")
    + """SELECT p.account_id, p.relevant_date, qoe_score FROM pop_month p JOIN
       (SELECT o_custkey AS account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(floor(max(o_totalprice) / 50000) AS INTEGER) AS qoe_score,
        min(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END) AS is_fictive FROM orders GROUP BY 1, 2) s
       ON p.account_id = s.account_id AND p.relevant_date = m WHERE is_fictive = 0""",
)
def qoe_exact(spark, path):
    r = Roles(spark, path)
    scores = r.table("orders").groupBy(
        F.col("o_custkey").alias("account_id"), F.trunc("o_orderdate", "month").alias("create_date_monthly")
    ).agg(
        F.floor(F.max("o_totalprice") / 50000).cast("int").alias("qoe_score"),
        F.min(F.when(F.col("o_orderstatus") == "P", 0).otherwise(1)).alias("is_fictive"),
    )
    return blocks.qoe_exact(r.pop_month(), scores)


@query(
    "firmographics",
    """SELECT c_custkey AS account_id, max(p_type) AS industry_group, max(p_size) AS founded_year, max(l_quantity) AS total_employees, max(p_brand) AS total_employees_range,
       count(DISTINCT l_partkey) AS total_employees_with_details,
       count(DISTINCT CASE WHEN p_type IN ('SMALL', 'LARGE') OR l_returnflag = 'R' THEN l_partkey END) AS developers,
       count(DISTINCT CASE WHEN p_type = 'PROMO' THEN l_partkey END) AS devops_engineers,
       count(DISTINCT CASE WHEN p_type LIKE '%M%' OR l_returnflag LIKE '%A%' THEN l_orderkey END) AS engineers
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1""",
)
def firmographics(spark, path):
    r = Roles(spark, path)
    li, p = r.table("lineitem"), r.table("part")
    people = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.col("l_orderkey").alias("person_id"),
        F.col("l_partkey").alias("email"),
        F.col("l_returnflag").alias("title"),
        F.col("p_type").alias("role"),
        "p_size",
        "l_quantity",
        "p_brand",
    )
    links = r.table("orders").select(F.col("o_orderkey").alias("person_id"), F.col("o_custkey").alias("account_id"))
    return blocks.firmographics(
        people,
        links,
        r.table("customer").select(F.col("c_custkey").alias("account_id")),
        {"industry_group": "role", "founded_year": "p_size", "total_employees": "l_quantity", "total_employees_range": "p_brand"},
        {
            "developers": F.col("role").isin("SMALL", "LARGE") | (F.col("title") == "R"),
            "devops_engineers": F.col("role") == "PROMO",
        },
        ("engineers", F.col("role").contains("M") | F.col("title").contains("A")),
    )


_VIEWS = {"pricing_views": "/purchase", "product_views": "/view", "support_views": "/click/", "knowledge_views": "/error"}


@query(
    "page_views",
    cte("pop_nation_touch")
    + "SELECT account_id, relevant_date, "
    + ", ".join(f"max({n}) AS {n}" for n in _VIEWS)
    + " FROM (SELECT p.account_id, p.relevant_date, c_custkey, "
    + ", ".join(f"CAST(sum(CASE WHEN path LIKE '%{v}%' THEN pageviews ELSE 0 END) AS BIGINT) AS {n}" for n, v in _VIEWS.items())
    + """ FROM pop_nation_touch p JOIN customer ON c_nationkey = p.account_id
       JOIN (SELECT user_id, CAST(ts AS DATE) AS d, '/' || event_type || CASE WHEN value > 20 THEN '/' ELSE '' END AS path, CAST(floor(value) AS BIGINT) AS pageviews FROM events) e ON user_id = c_custkey
       WHERE date_diff('day', d, p.relevant_date) BETWEEN 0 AND 90 GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
def page_views(spark, path):
    r = Roles(spark, path)
    people = r.table("customer").select(
        F.col("c_nationkey").alias("account_id"), F.col("c_custkey").alias("contact_id"), F.col("c_custkey").alias("device_id")
    )
    ev = r.table("events")
    visits = ev.select(F.col("event_id").alias("session_id"), F.col("user_id").alias("device_id"))
    views = ev.select(
        F.col("event_id").alias("session_id"),
        F.col("ts").cast("date").alias("view_date"),
        F.concat(F.lit("/"), "event_type", F.when(F.col("value") > 20, F.lit("/")).otherwise(F.lit(""))).alias("path"),
        F.floor("value").alias("pageviews"),
    )
    return blocks.page_views(r.pop_nation(TOUCH_DATES), people, visits, views, _VIEWS)


@query(
    "cloud_subscription",
    cte("pop_nation")
    + """SELECT p.account_id, p.relevant_date, 1 AS have_cloud_subscription FROM pop_nation p JOIN customer ON c_nationkey = p.account_id
       JOIN orders ON o_custkey = c_custkey WHERE o_orderdate <= p.relevant_date AND o_orderstatus <> 'P' GROUP BY 1, 2""",
)
def cloud_subscription(spark, path):
    r = Roles(spark, path)
    people = r.table("customer").select(F.col("c_nationkey").alias("account_id"), F.col("c_custkey").alias("email"))
    servers = r.table("orders").select(
        F.col("o_custkey").alias("owner_email"), F.col("o_orderdate").alias("created"), F.col("o_orderstatus").alias("server_type")
    )
    return blocks.cloud_subscription(r.pop_nation(), people, servers, "P")


_CASE_WORDS = {"n_ha_mentioned": ["1-URGENT", "2-HIGH"], "n_ent_mentioned": ["3-MEDIUM"], "n_bad_mentioned": ["5-LOW", "4-NOT SPECIFIED"]}


def mentions_sql(words, source, term, day, months):
    fams = ", ".join(
        f"count(DISTINCT CASE WHEN {term} IN ({', '.join(repr(w) for w in ws)}) THEN {day} END) AS {n}" for n, ws in words.items()
    )
    return f"SELECT p.account_id, p.relevant_date, {fams} FROM pop p JOIN {source} u USING (account_id) WHERE {day} BETWEEN {back_sql(months)} AND p.relevant_date GROUP BY 1, 2"


@query(
    "keyword_mentions_cases",
    cte("pop", "contracts") + mentions_sql(_CASE_WORDS, "contracts", "tier", "startdate", 4),
)
def keyword_mentions_cases(spark, path):
    r = Roles(spark, path)
    rows = r.contracts().select(
        "account_id", F.col("tier").alias("term"), F.date_format("startdate", "MM/dd/yyyy").alias("day_text")
    )
    return blocks.keyword_mentions(r.pop(), rows, _CASE_WORDS)


# every two-word part name is one term
_TERMS = {
    f"n_{a}_{b}_mentioned": [f"{a} {b}"] for a in ("red", "blue", "small", "large") for b in ("widget", "bolt", "ring", "gear")
}


@query(
    "keyword_mentions_sessions",
    cte("pop", "usage_part", also={"notes": "SELECT * FROM usage_part WHERE flag IN ('A', 'N')"})
    + mentions_sql(_TERMS, "notes", "subject", "art_create_date", 4),
)
def keyword_mentions_sessions(spark, path):
    r = Roles(spark, path)
    rows = r.usage(part=True).where(F.col("flag").isin("A", "N")).select(
        "account_id", F.col("subject").alias("term"), F.date_format("art_create_date", "MM/dd/yyyy").alias("day_text")
    )
    return blocks.keyword_mentions(r.pop(), rows, _TERMS)


def _tasks(r):
    return r.usage(part=True).select(
        "account_id", "subject", F.col("flag").alias("task_type"), F.col("art_create_date").alias("createddate")
    )


@query(
    "email_activity",
    cte("pop", "usage_part")
    + f"""SELECT *, round(CASE WHEN n_sent > 0 THEN CAST(n_replys AS DOUBLE) / n_sent ELSE -1 END, 6) AS replys_to_sent FROM (SELECT p.account_id, p.relevant_date,
       count(DISTINCT CASE WHEN flag = 'R' THEN subject END) AS n_replys,
       count(DISTINCT CASE WHEN flag = 'A' OR subject LIKE '%bolt%' THEN subject END) AS n_sent,
       count(DISTINCT CASE WHEN flag = 'N' THEN subject END) AS n_calls,
       CAST(sum(CASE WHEN lower(subject) LIKE '%widget%' THEN 1 ELSE 0 END) AS BIGINT) AS n_task_topic
       FROM pop p JOIN usage_part u USING (account_id) WHERE art_create_date BETWEEN {back_sql(4)} AND p.relevant_date GROUP BY 1, 2)""",
)
def email_activity(spark, path):
    r = Roles(spark, path)
    return rounded(blocks.email_activity(r.pop(), _tasks(r), "R", "A", "bolt", "N", "widget"), ["replys_to_sent"])


@query(
    "days_since_activity",
    cte("pop", "usage_part")
    + """SELECT p.account_id, p.relevant_date,
       CAST(date_diff('day', max(CASE WHEN flag = 'R' THEN art_create_date END), p.relevant_date) AS INTEGER) AS days_since_reply,
       CAST(date_diff('day', max(CASE WHEN flag = 'A' OR subject LIKE '%bolt%' THEN art_create_date END), p.relevant_date) AS INTEGER) AS days_since_sent,
       CAST(date_diff('day', max(CASE WHEN lower(subject) LIKE '%widget%' THEN art_create_date END), p.relevant_date) AS INTEGER) AS days_since_topic
       FROM pop p JOIN usage_part u USING (account_id) WHERE art_create_date <= p.relevant_date GROUP BY 1, 2""",
)
def days_since_activity(spark, path):
    r = Roles(spark, path)
    return blocks.days_since_activity(r.pop(), _tasks(r), "R", "A", "bolt", "widget")


@query(
    "company_profile",
    """SELECT DISTINCT c_custkey AS company_id, c_mktsegment AS sector, c_nationkey AS employee_count, o_orderstatus AS industry,
       CASE WHEN c_acctbal > 5000 THEN 'public' ELSE 'private' END AS public_or_private
       FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'""",
)
def company_profile(spark, path):
    r = Roles(spark, path)
    c = r.table("customer")
    ids = c.select(F.col("c_custkey").alias("company_id"))
    attrs = c.select(
        F.col("c_custkey").alias("company_id"),
        F.col("c_mktsegment").alias("sector"),
        F.col("c_nationkey").alias("employee_count"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_name")).alias("stock_ticker"),
    )
    industry = r.table("orders").select(
        F.col("o_custkey").alias("company_id"),
        F.col("o_orderstatus").alias("industry"),
        (F.col("o_orderpriority") == "1-URGENT").alias("isprimary"),
    )
    return blocks.company_profile(ids, attrs, industry)


@query(
    "open_pipeline",
    f"""SELECT o_custkey AS account_id, round(sum(o_totalprice - 100000), 4) AS expected_arr_growth, round(sum(o_totalprice / 2), 4) AS related_contracts_arr, round(sum(o_totalprice), 4) AS expected_arr
       FROM orders WHERE o_orderdate >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 13 MONTH AND o_orderstatus = 'O' GROUP BY 1""",
)
def open_pipeline(spark, path):
    r = Roles(spark, path)
    opps = r.table("orders").select(
        F.col("o_custkey").alias("account_id"),
        (F.col("o_totalprice") - 100000).alias("arr_growth"),
        (F.col("o_totalprice") / 2).alias("previous_arr"),
        F.col("o_totalprice").alias("arr"),
        F.col("o_orderdate").alias("contract_expiry"),
        F.when(F.col("o_orderstatus") == "O", "false").otherwise("true").alias("isclosed"),
    )
    out = blocks.open_pipeline(opps, AS_OF)
    return rounded(out, [c for c in out.columns if c != "account_id"], 4)


_LADDER = ("MACHINERY", "FURNITURE", "BUILDING", "AUTOMOBILE")


@query(
    "top_subscription",
    cte("accounts")
    + """SELECT a.logo, n_regionkey AS number_of_accounts,
       CASE min(CASE top_subscription WHEN 'MACHINERY' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'BUILDING' THEN 3 WHEN 'AUTOMOBILE' THEN 4 END)
         WHEN 1 THEN 'MACHINERY' WHEN 2 THEN 'FURNITURE' WHEN 3 THEN 'BUILDING' WHEN 4 THEN 'AUTOMOBILE' END AS top_sub
       FROM accounts a JOIN nation ON a.logo = n_name GROUP BY 1, 2""",
)
def top_subscription(spark, path):
    r = Roles(spark, path)
    return blocks.top_subscription(r.accounts(), r.logos(), _LADDER)


@query(
    "failed_opportunities",
    cte("pop")
    + """SELECT p.account_id, p.relevant_date, count(DISTINCT o_orderdate) AS n_fail_opp FROM pop p JOIN orders ON o_custkey = p.account_id
       WHERE o_orderstatus = 'O' AND lower(o_orderpriority) NOT LIKE '%low%' AND lower(o_orderpriority) LIKE '%i%' AND o_orderpriority <> '3-MEDIUM'
       AND p.relevant_date >= o_orderdate GROUP BY 1, 2""",
)
def failed_opportunities(spark, path):
    r = Roles(spark, path)
    opps = r.table("orders").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("createddate"),
        F.when(F.col("o_orderstatus") == "O", "false").otherwise("true").alias("iswon"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderpriority").alias("type"),
    )
    return blocks.failed_opportunities(r.pop(), opps, "false", "low", "i", "3-MEDIUM")


def _visits(r):
    text = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return r.touch().select(F.col("account_id").alias("client_id"), "event_type", text.alias("time_stamp"))


def _visits_sql(kind: str, name: str) -> str:
    return (
        cte("pop_touch")
        + f"""SELECT p.account_id, p.relevant_date, count(DISTINCT v) AS {name} FROM
       (SELECT user_id AS account_id, make_timestamp(CAST(left(CAST(epoch_ms(ts) AS VARCHAR), 10) AS BIGINT) * 1000000) AS v FROM events WHERE event_type {kind}) e
       JOIN pop_touch p USING (account_id) WHERE p.relevant_date >= v GROUP BY 1, 2"""
    )


@query("site_visits_private", _visits_sql("<> 'view'", "count_visits_private"))
def site_visits_private(spark, path):
    r = Roles(spark, path)
    who = r.table("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_custkey").alias("client_id"))
    return blocks.site_visits(r.pop_touch(), who, _visits(r).where("event_type <> 'view'"), "count_visits_private")


@query("site_visits_public", _visits_sql("= 'view'", "count_visits_public"))
def site_visits_public(spark, path):
    r = Roles(spark, path)
    who = r.table("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_custkey").alias("client_id"))
    return blocks.site_visits(r.pop_touch(), who, _visits(r).where("event_type = 'view'"), "count_visits_public")


@query("site_visits", _visits_sql("IS NOT NULL", "count_visits"))
def site_visits(spark, path):
    r = Roles(spark, path)
    who = r.table("customer").select(F.col("c_custkey").alias("account_id"), F.col("c_custkey").alias("client_id"))
    return blocks.site_visits(r.pop_touch(), who, _visits(r))
