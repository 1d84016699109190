"""Cohorts and the wide matrix on the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble as wide
from ..operators import asof, blocks, cohort
from ..operators.asof import FIVE_PERIODS
from ..session import cut_lineage, handed_over
from .block_queries import back_sql, period_sql, rounded
from .registry import query
from .roles import AS_OF, PACKAGES, STORAGE, USERS, Roles, cte

BASE, MIDS, UPPERS = "ECONOMY", ("SMALL", "MEDIUM"), ("LARGE", "PROMO")
LABELS = {1: "mid", 2: "base", 3: "Pure Upsell"}

_UPSELL = """SELECT account_id, event_month, CASE WHEN r = 1 THEN 'mid' WHEN r = 2 THEN 'base' ELSE 'Pure Upsell' END AS previous_product FROM (
  SELECT account_id, min(CASE WHEN prev_product_name IN ('SMALL', 'MEDIUM') THEN 1 WHEN prev_product_name = 'ECONOMY' THEN 2 ELSE 3 END) AS r,
  max(event_month) AS event_month FROM history
  WHERE ((new_product_name IN ('LARGE', 'PROMO') AND prev_product_name IN ('ECONOMY', 'SMALL', 'MEDIUM'))
      OR (pure_upsell_flag = 1 AND prev_product_name IN ('LARGE', 'PROMO'))) AND prev_product_name <> new_product_name GROUP BY 1)"""
_FIRST_UP = """SELECT account_id, territory, 1 AS class, CAST(date_trunc('month', min(event_month)) - INTERVAL 3 MONTH AS DATE) AS relevant_date
  FROM history WHERE prev_product_name = 'ECONOMY' AND new_product_name IN ('LARGE', 'PROMO') GROUP BY 1, 2"""
_NON = """SELECT DISTINCT h.account_id, h.territory, 0 AS class FROM history h LEFT JOIN first_up f ON h.account_id = f.account_id
  WHERE prev_product_name = 'ECONOMY' AND new_product_name = 'ECONOMY' AND f.account_id IS NULL"""
_DRAWN = f"""SELECT account_id, CAST(date_trunc('month', lo + CAST(floor(u * date_diff('day', lo, hi)) AS INTEGER)) AS DATE) AS relevant_date FROM (
  SELECT account_id, lo, CAST(DATE '{AS_OF}' - INTERVAL 3 MONTH AS DATE) AS hi, u, row_number() OVER (PARTITION BY account_id ORDER BY pick) AS rn FROM (
    SELECT h.account_id, CAST(('0x' || left(sha1(CAST(event_id AS VARCHAR) || '|0'), 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u, sha1('pick0|' || event_id) AS pick,
      CASE WHEN c4 IS NULL THEN CAST(first_event_month + INTERVAL 4 MONTH AS DATE) WHEN c4 < first_event_month THEN first_event_month ELSE c4 END AS lo
    FROM history h LEFT JOIN (SELECT account_id, CAST(customer_since + INTERVAL 4 MONTH AS DATE) AS c4 FROM accounts) a ON h.account_id = a.account_id)) WHERE rn = 1"""
_ASSIGNED = f"""SELECT h.account_id, sales_business_unit, territory,
  CASE WHEN ua.event_month IS NOT NULL THEN CAST(date_trunc('month', ua.event_month) - INTERVAL 3 MONTH AS DATE) ELSE d.relevant_date END AS relevant_date,
  CASE WHEN ua.event_month IS NOT NULL THEN 1 ELSE 0 END AS upgraded, max(pbid) AS pbid
  FROM history h LEFT JOIN upsell ua ON ua.account_id = h.account_id LEFT JOIN drawn d ON d.account_id = h.account_id AND d.relevant_date <= DATE '{AS_OF}'
  GROUP BY 1, 2, 3, 4, 5"""


def _with(**also) -> str:
    return cte("history", "accounts", also=also)


def _upsell(r):
    return cohort.upsell_accounts(r.history(), MIDS, BASE, UPPERS, LABELS)


def _assigned(r):
    h = r.history()
    return cohort.assign_reference(h, _upsell(r), cohort.random_reference_month(h, r.accounts(), AS_OF), AS_OF)


@query("contract_history", cte("history") + "SELECT * FROM history")
def contract_history(spark, path):
    return Roles(spark, path).history()


@query("upsell_accounts", _with(upsell=_UPSELL) + "SELECT * FROM upsell")
def upsell_accounts(spark, path):
    return _upsell(Roles(spark, path))


@query("first_upgrades", _with(first_up=_FIRST_UP) + "SELECT * FROM first_up")
def first_upgrades(spark, path):
    return cohort.first_upgrades(Roles(spark, path).history(), BASE, UPPERS)


@query("non_upsell_anti", _with(first_up=_FIRST_UP) + _NON)
def non_upsell_anti(spark, path):
    h = Roles(spark, path).history()
    return cohort.non_upsell(h, cohort.first_upgrades(h, BASE, UPPERS), BASE)


@query("random_reference_month", _with(drawn=_DRAWN) + "SELECT * FROM drawn")
def random_reference_month(spark, path):
    r = Roles(spark, path)
    return cohort.random_reference_month(r.history(), r.accounts(), AS_OF)


@query("reference_date_assign", _with(upsell=_UPSELL, drawn=_DRAWN) + _ASSIGNED)
def reference_date_assign(spark, path):
    return _assigned(Roles(spark, path))


@query(
    "add_control_rows",
    _with(upsell=_UPSELL, drawn=_DRAWN, assigned=_ASSIGNED)
    + """SELECT * FROM assigned UNION SELECT a.account_id, sales_business_unit, a.territory,
       CASE WHEN customer_since + INTERVAL 3 MONTH < relevant_date - INTERVAL 12 MONTH THEN CAST(relevant_date - INTERVAL 12 MONTH AS DATE)
            ELSE CAST(customer_since + INTERVAL 3 MONTH AS DATE) END, 0, pbid
       FROM assigned a LEFT JOIN accounts c ON a.account_id = c.account_id WHERE upgraded = 1""",
)
def add_control_rows(spark, path):
    r = Roles(spark, path)
    return cohort.add_controls(_assigned(r), r.accounts())


@query(
    "cohort_union_all",
    _with(first_up=_FIRST_UP, non=_NON, drawn=_DRAWN)
    + """SELECT DISTINCT n.account_id, territory, class, relevant_date FROM non n LEFT JOIN drawn d ON n.account_id = d.account_id
       UNION ALL SELECT account_id, territory, class, relevant_date FROM first_up""",
)
def cohort_union_all(spark, path):
    r = Roles(spark, path)
    h = r.history()
    up = cohort.first_upgrades(h, BASE, UPPERS)
    return cohort.union_cohorts(up, cohort.non_upsell(h, up, BASE), cohort.random_reference_month(h, r.accounts(), AS_OF))


_OPPS = """SELECT 'A' || lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS account_id, p0.p_type AS original_product, p1.p_type AS product, o_orderdate AS createddate,
  o_orderdate AS closedate, o_orderstatus AS iswon, o_orderpriority AS type FROM orders
  JOIN (SELECT l_orderkey, min(l_partkey) AS a, max(l_partkey) AS b FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
  JOIN part p0 ON p0.p_partkey = a JOIN part p1 ON p1.p_partkey = b"""


def _opps(r):
    e = r.events_of_contract()
    old = r.products().select("product_id", F.col("product_name").alias("original_product"))
    new = r.products().select(F.col("product_id").alias("product_renewal_id"), F.col("product_name").alias("product"))
    return (
        e.join(old, "product_id")
        .join(new, "product_renewal_id")
        .select(
            F.concat(F.lit("A"), F.lpad(F.col("account_id").cast("string"), 14, "0")).alias("account_id"),
            "original_product",
            "product",
            F.col("event_month").alias("createddate"),
            F.col("event_month").alias("closedate"),
            F.col("sales_team").alias("iswon"),
            F.col("sales_business_unit").alias("type"),
        )
    )


def _union_cohort(r):
    full = r.accounts().select(
        F.concat(F.lit("A"), F.lpad(F.col("account_id").cast("string"), 14, "0"), F.lit("XYZ")).alias("account_id_full"), "territory"
    )
    return cohort.cohort_union(_opps(r), full, "ECONOMY", "SMALL", 1996, "F", "low")


_UNION = """SELECT a.account_id, class, relevant_date, territory FROM (
  SELECT account_id, 0 AS class, CAST(date_trunc('month', closedate) - INTERVAL 3 MONTH AS DATE) AS relevant_date FROM opps
   WHERE product = 'ECONOMY' AND original_product = 'ECONOMY' AND year(createddate) >= 1996 AND iswon = 'F'
  UNION SELECT account_id, 1, CAST(date_trunc('month', closedate) - INTERVAL 3 MONTH AS DATE) FROM opps
   WHERE product = 'SMALL' AND original_product = 'ECONOMY' AND year(createddate) >= 1996 AND iswon = 'F' AND lower(type) NOT LIKE '%low%') a
  JOIN (SELECT 'A' || lpad(CAST(account_id AS VARCHAR), 14, '0') || 'XYZ' AS full_id, territory FROM accounts) c ON a.account_id = left(full_id, length(full_id) - 3)
  WHERE relevant_date IS NOT NULL"""


@query("opportunity_cohort_union", cte("accounts", also={"opps": _OPPS}) + _UNION)
def opportunity_cohort_union(spark, path):
    return _union_cohort(Roles(spark, path))


@query(
    "drop_contradicting_labels",
    """WITH raw AS (SELECT o_custkey AS account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS relevant_date, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS class, o_orderkey FROM orders)
       SELECT a.* FROM raw a JOIN (SELECT account_id FROM (SELECT account_id, relevant_date, count(DISTINCT class) AS n FROM raw GROUP BY 1, 2)
       GROUP BY 1 HAVING max(CASE WHEN n > 1 THEN 1 ELSE 0 END) = 0) b ON a.account_id = b.account_id""",
)
def drop_contradicting_labels(spark, path):
    raw = Roles(spark, path).table("orders").select(
        F.col("o_custkey").alias("account_id"),
        F.trunc("o_orderdate", "month").alias("relevant_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("class"),
        "o_orderkey",
    )
    return cohort.drop_contradictions(raw)


@query(
    "opportunity_cohort_v4",
    cte("contract_events", "accounts")
    + """SELECT o.account_id, territory, event_month - 90 AS relevant_date, CASE WHEN np.p_type NOT IN ('ECONOMY', 'SMALL') THEN 1 ELSE 0 END AS class FROM
       (SELECT DISTINCT account_id, event_id, product_id, product_renewal_id, event_month FROM contract_events
        WHERE sales_business_unit <> '5-LOW' AND isclosed = 'true' AND iswon = 'true' AND event_month >= DATE '1996-01-01') o
       JOIN part pp ON pp.p_partkey = o.product_id AND pp.p_type IN ('ECONOMY', 'SMALL')
       JOIN part np ON np.p_partkey = o.product_renewal_id AND np.p_brand <> 'Brand#1' AND lower(np.p_name) NOT LIKE '%gear%'
       JOIN accounts da ON da.account_id = o.account_id""",
)
def opportunity_cohort_v4(spark, path):
    r = Roles(spark, path)
    old = r.products().where(F.col("product_name").isin("ECONOMY", "SMALL")).withColumnRenamed("product_id", "old_id")
    e = r.events_of_contract()
    opps = e.join(old, e["product_id"] == old["old_id"]).select(
        "account_id",
        "event_id",
        F.col("product_renewal_id").alias("product_id"),
        F.when(F.col("sales_business_unit") == "5-LOW", "New Business").otherwise("Renewal").alias("type"),
        "iswon",
        "isclosed",
        F.col("event_month").alias("closedate"),
    )
    licences = (
        r.table("part")
        .where((F.col("p_brand") != "Brand#1") & ~F.lower(F.col("p_name")).contains("gear"))
        .select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("new_product"))
    )
    return cohort.cohort_v4(opps, F.lit(True), licences, r.accounts(), ["ECONOMY", "SMALL"], "1996-01-01")


@query(
    "scoring_cohort",
    cte("accounts") + f"SELECT account_id, territory, DATE '{AS_OF}' AS relevant_date, 0 AS class FROM accounts WHERE top_subscription = 'MACHINERY'",
)
def scoring_cohort(spark, path):
    return cohort.scoring_cohort(Roles(spark, path).accounts(), "MACHINERY", AS_OF)


@query(
    "time_from_renewal",
    cte("pop", "history")
    + """SELECT account_id, relevant_date, CASE WHEN max(d) > 0 THEN min(CASE WHEN d > 0 THEN d END) ELSE 12 + max(d) END AS tfr FROM
       (SELECT p.account_id, p.relevant_date, CAST(date_diff('month', event_month, p.relevant_date) AS INTEGER) AS d FROM pop p LEFT JOIN history h ON h.account_id = p.account_id) GROUP BY 1, 2""",
)
def time_from_renewal(spark, path):
    r = Roles(spark, path)
    return cohort.time_from_renewal(r.pop(), r.history())


@query(
    "months_from_renewal",
    cte("pop")
    + """SELECT p.account_id, p.relevant_date, CAST(date_diff('month', CAST(max(o_orderdate) AS DATE), p.relevant_date) AS INTEGER) AS months_from_renewal
       FROM pop p JOIN orders ON o_custkey = p.account_id WHERE o_orderdate <= p.relevant_date GROUP BY 1, 2""",
)
def months_from_renewal(spark, path):
    r = Roles(spark, path)
    opps = r.table("orders").select(F.col("o_custkey").alias("account_id"), F.col("o_orderdate").alias("closedate"))
    return cohort.months_from_renewal(r.pop(), opps)


_WINS = """SELECT o_custkey AS account_id, o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS relevant_date, o_totalprice AS price,
  CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END AS class FROM orders"""


def _wins(r):
    return r.table("orders").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderdate").cast("date").alias("relevant_date"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_totalprice") > 450000, 1).otherwise(0).alias("class"),
    )


_LOST = """SELECT account_id, row_id, price, class FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY sha1('2|' || row_id)) AS rn
  FROM wins WHERE account_id IN (SELECT account_id FROM wins GROUP BY 1 HAVING sum(class) = 0)) WHERE rn = 1"""


@query(
    "consolidate_wins",
    f"WITH wins AS ({_WINS}) SELECT account_id, min(row_id) AS row_id, min(price) AS price, min(class) AS class FROM wins WHERE class = 1 GROUP BY 1 UNION ALL {_LOST}",
)
def consolidate_wins(spark, path):
    return cohort.consolidate_wins(_wins(Roles(spark, path)), ["row_id", "price", "class"])


@query(
    "consolidate_wins_earliest",
    f"""WITH wins AS ({_WINS}) SELECT account_id, row_id, price, class FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY relevant_date, row_id) AS rn
        FROM wins WHERE class = 1) WHERE rn = 1 UNION ALL {_LOST}""",
)
def consolidate_wins_earliest(spark, path):
    return cohort.consolidate_wins(_wins(Roles(spark, path)), ["row_id", "price", "class"], mode="earliest")


@query(
    "latest_per_account",
    f"WITH wins AS ({_WINS}) SELECT * FROM wins w WHERE relevant_date = (SELECT max(relevant_date) FROM wins x WHERE x.account_id = w.account_id)",
)
def latest_per_account(spark, path):
    return cohort.latest_per_account(_wins(Roles(spark, path)))


# ---------------------------------------------------------------- wide assembly

_SUF = {p.label: ("" if i == 0 else f"__{p.label}") for i, p in enumerate(FIVE_PERIODS)}


def _wide_cols(cols, alias):
    return ", ".join(
        f"max(CASE WHEN period = '{p}' THEN {alias}{c} END) AS {c}{s}" for p, s in _SUF.items() for c in cols
    )


def _matrix_sql(full: bool) -> str:
    inner = ", ".join(f"avg({m}) AS {m}" for m in STORAGE + USERS) + ", " + ", ".join(
        f"max(CASE WHEN package_type = '{t}' THEN avg_repos ELSE 0 END) AS {n}" for n, t in PACKAGES.items()
    )
    outer = ", ".join(f"round(sum({m}), 6) AS {m}" for m in [*STORAGE, *USERS, *PACKAGES]) + ", count(*) AS n_env"
    cols = [*STORAGE, *USERS, *PACKAGES, "n_env"]
    also = {
        "per_env": f"SELECT p.account_id, p.relevant_date, environment_service_id, {period_sql('u.art_create_date')} AS period, {inner} FROM pop p JOIN usage_part u USING (account_id) GROUP BY 1, 2, 3, 4",
        "use": f"SELECT account_id, relevant_date, period, {outer} FROM per_env WHERE period IS NOT NULL GROUP BY 1, 2, 3",
        "use_wide": f"SELECT account_id, relevant_date, count(DISTINCT period) AS n_windows, {_wide_cols(cols, '')} FROM use GROUP BY 1, 2",
        "people": """SELECT p.account_id, p.relevant_date, count(DISTINCT o_orderdate) AS n_contacts,
            CAST(sum(CASE WHEN lower(o_orderpriority) LIKE '%urgent%' THEN 1 ELSE 0 END) AS BIGINT) AS n_security_contacts
            FROM pop p JOIN orders ON o_custkey = p.account_id WHERE o_orderdate <= p.relevant_date GROUP BY 1, 2""",
        "mail": f"""SELECT p.account_id, p.relevant_date, count(DISTINCT CASE WHEN flag = 'R' THEN subject END) AS n_replys,
            count(DISTINCT CASE WHEN flag = 'A' OR subject LIKE '%bolt%' THEN subject END) AS n_sent, count(DISTINCT CASE WHEN flag = 'N' THEN subject END) AS n_calls
            FROM pop p JOIN usage_part u USING (account_id) WHERE art_create_date BETWEEN {back_sql(4)} AND p.relevant_date GROUP BY 1, 2""",
        "since": """SELECT p.account_id, p.relevant_date, CAST(date_diff('day', max(CASE WHEN flag = 'R' THEN art_create_date END), p.relevant_date) AS INTEGER) AS days_since_reply
            FROM pop p JOIN usage_part u USING (account_id) WHERE art_create_date <= p.relevant_date GROUP BY 1, 2""",
        "deals": """SELECT p.account_id, p.relevant_date, count(DISTINCT CASE WHEN p.relevant_date <= enddate THEN startdate END) AS n_active_contracts,
            count(DISTINCT CASE WHEN tier = '1-URGENT' AND p.relevant_date <= enddate THEN startdate END) AS count_ent,
            count(DISTINCT CASE WHEN tier = '2-HIGH' AND p.relevant_date <= enddate THEN startdate END) AS count_prox
            FROM pop p JOIN contracts c USING (account_id) WHERE p.relevant_date >= date_trunc('month', startdate) GROUP BY 1, 2""",
    }
    usage_cols = ", ".join(f"{c}{s}" for s in _SUF.values() for c in cols)
    return (
        cte("pop", "usage_part", "contracts", "accounts", also=also)
        + f"""SELECT p.account_id, p.relevant_date, p.class, coalesce(territory, 'unknown') AS territory, coalesce(n_windows, 0) AS n_windows, {usage_cols},
          coalesce(n_contacts, 0) AS n_contacts, coalesce(n_security_contacts, 0) AS n_security_contacts,
          coalesce(n_replys, 0) AS n_replys, coalesce(n_sent, 0) AS n_sent, coalesce(n_calls, 0) AS n_calls,
          coalesce(round(CASE WHEN n_sent > 0 THEN CAST(n_replys AS DOUBLE) / n_sent ELSE -1 END, 6), -1) AS replys_to_sent,
          coalesce(days_since_reply, 1000) AS days_since_reply, n_active_contracts, count_ent, count_prox
          FROM pop p LEFT JOIN use_wide USING (account_id, relevant_date) LEFT JOIN people USING (account_id, relevant_date)
          LEFT JOIN mail USING (account_id, relevant_date) LEFT JOIN since USING (account_id, relevant_date)
          LEFT JOIN deals USING (account_id, relevant_date) LEFT JOIN accounts USING (account_id)"""
        + (" WHERE n_windows = 5 AND count_ent = 0 AND count_prox = 0" if full else "")
    )


HELD = ["count_ent", "count_prox"]


def _usage_windows(pop, snaps):
    """Storage, users and repositories share environment, account and day: one block."""
    inner = {m: asof.mean(F.col(m)) for m in STORAGE + USERS}
    inner |= {
        n: asof.largest(F.when(F.col("package_type") == t, F.col("avg_repos")).otherwise(F.lit(0.0))) for n, t in PACKAGES.items()
    }
    use = asof.usage_block(pop, snaps, "environment_service_id", "art_create_date", inner, n_env="n_env")
    return asof.widen_periods(rounded(use, list(inner)), [*inner, "n_env"], flag="n_windows")


def _active(pop, contracts):
    tiers = {"count_ent": F.col("tier") == "1-URGENT", "count_prox": F.col("tier") == "2-HIGH"}
    return blocks.contracts_active(pop, contracts, "P", tiers).drop("is_cotermed")


def feature_frame(r: Roles, full: bool = False):
    """Population with usage, contacts, mail, recency and contract blocks.

    Lines meet their orders and parts once, in a written table, and each narrow block is written before
    the next begins: a step's shuffle files go with it. Usage, the wide block, stays in the last step,
    where it is already grouped by the join key.

    With `full`, rows need all usage windows and no active contract of the named tiers. These
    filters come first, contracts before usage, and what they leave reduces the population and the
    facts of all other blocks.
    """
    pop, snaps = r.pop(), r.usage(part=True)
    people = r.table("orders").select(
        F.col("o_custkey").alias("account_id"), F.col("o_orderdate").alias("createddate"), F.col("o_orderpriority").alias("title")
    )
    deals, required = _active(pop, r.contracts()), []
    if full:
        key, account = ["account_id", "relevant_date"], ["account_id"]
        free = cut_lineage(wide.require_full_history(deals, None, 0, HELD))
        held = free.select(*account).distinct()
        pop = pop.join(free.select(*key), key, "left_semi")
        use_wide = _usage_windows(pop, r.usage(part=True, accounts=held))
        required = [cut_lineage(wide.require_full_history(use_wide.join(free, key), "n_windows", 5, HELD))]
        held = required[0].select(*account).distinct()
        pop = pop.join(required[0].select(*key), key, "left_semi")
        snaps, people = r.usage(part=True, accounts=held), people.join(held, account, "left_semi")
    else:
        snaps = handed_over(snaps.select("account_id", "environment_service_id", "art_create_date", "avg_repos", *STORAGE, *USERS, "package_type", "subject", "flag"))
    tasks = snaps.select("account_id", "subject", F.col("flag").alias("task_type"), F.col("art_create_date").alias("createddate"))
    if full:
        tasks = cut_lineage(tasks)  # few accounts are left: three blocks read them, lines are read once
    mail = rounded(blocks.email_activity(pop, tasks, "R", "A", "bolt", "N", "widget"), ["replys_to_sent"])
    since = blocks.days_since_activity(pop, tasks, "R", "A", "bolt", "widget")
    zero = {c: 0 for c in ("n_windows", "n_contacts", "n_security_contacts", "n_replys", "n_sent", "n_calls")}
    defaults = {**zero, "replys_to_sent": -1.0, "days_since_reply": 1000, "territory": "unknown"}
    others = [
        blocks.contacts(pop, people, ["urgent"]).drop("security_contacts_prop"),
        mail.drop("n_task_topic"),
        since.select("account_id", "relevant_date", "days_since_reply"),
    ]
    if not full:
        others = [*map(handed_over, [*others, deals]), _usage_windows(pop, snaps)]
    return wide.assemble(pop, others, defaults, [r.accounts().select("account_id", "territory")], required=required)


@query("feature_matrix", _matrix_sql(False))
def feature_matrix(spark, path):
    return feature_frame(Roles(spark, path))


@query("require_full_history", _matrix_sql(True))
def require_full_history(spark, path):
    return feature_frame(Roles(spark, path), full=True)


_FLAGS = """SELECT p.account_id, p.relevant_date, p.class, a.top_subscription, u.previous_product, q.qoe_score, d.count_pro, d.count_ent, w.artifacts_count, w.artifacts_count__m1,
  p.class AS n_a, CASE WHEN q.qoe_score IS NOT NULL THEN q.qoe_score END AS n_b FROM pop p
  LEFT JOIN accounts a ON a.account_id = p.account_id
  LEFT JOIN upsell u ON u.account_id = p.account_id
  LEFT JOIN (SELECT o_custkey AS account_id, CAST(o_orderdate AS DATE) AS d, CAST(max(floor(o_totalprice / 40000)) AS INTEGER) AS qoe_score FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2) q
    ON q.account_id = p.account_id AND q.d = p.relevant_date + 90
  LEFT JOIN (SELECT account_id, CAST(sum(CASE WHEN tier = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS count_pro, CAST(sum(CASE WHEN tier = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS count_ent FROM contracts GROUP BY 1) d ON d.account_id = p.account_id
  LEFT JOIN (SELECT account_id, relevant_date, max(CASE WHEN period = 'm0' THEN s END) AS artifacts_count, max(CASE WHEN period = 'm1' THEN s END) AS artifacts_count__m1 FROM (
     SELECT account_id, relevant_date, period, sum(m) AS s FROM (SELECT p.account_id, p.relevant_date, environment_service_id, """ + period_sql("u.art_create_date") + """ AS period, max(artifacts_count) AS m
     FROM pop p JOIN usage u USING (account_id) GROUP BY 1, 2, 3, 4) WHERE period IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2) w ON w.account_id = p.account_id AND w.relevant_date = p.relevant_date"""

_DERIVED = """SELECT *, CASE WHEN product = 'mid' AND qoe_score = 10 THEN 4 WHEN product = 'mid' AND qoe_score < 10 AND qoe_score >= 7 THEN 3 WHEN product = 'mid' AND qoe_score < 7 THEN 2 ELSE 1 END AS qoe_score_cat,
  CASE WHEN count_pro > 0 AND product = 'mid' THEN 1 ELSE 0 END AS upgraded_to_top,
  CASE WHEN artifacts_count IS NULL OR artifacts_count__m1 IS NULL THEN 0 ELSE 1 END AS call_home_flag, coalesce(n_a + n_b, 0) AS total_mentions
  FROM (SELECT *, CASE WHEN coalesce(previous_product, top_subscription) = 'AUTOMOBILE' THEN 'BUILDING' ELSE coalesce(previous_product, top_subscription) END AS product FROM flags)"""


def _flag_frame(r):
    pop = r.pop()
    o = r.table("orders")
    scores = (
        o.where("o_orderstatus = 'P'")
        .groupBy(F.col("o_custkey").alias("account_id"), F.date_sub(F.col("o_orderdate").cast("date"), 90).alias("relevant_date"))
        .agg(F.max(F.floor(F.col("o_totalprice") / 40000)).cast("int").alias("qoe_score"))
    )
    deals = r.contracts().groupBy("account_id").agg(
        F.count(F.when(F.col("tier") == "5-LOW", 1)).alias("count_pro"), F.count(F.when(F.col("tier") == "1-URGENT", 1)).alias("count_ent")
    )
    use = asof.usage_block(pop, r.usage(), "environment_service_id", "art_create_date", {"artifacts_count": asof.largest(F.col("artifacts_count"))})
    use = asof.widen_periods(use, ["artifacts_count"]).select("account_id", "relevant_date", "artifacts_count", "artifacts_count__m1")
    df = wide.assemble(
        pop, [scores, use], None, [r.accounts().select("account_id", "top_subscription"), _upsell(r).drop("event_month"), deals]
    )
    df = df.withColumn("n_a", F.col("class")).withColumn("n_b", F.col("qoe_score"))
    return wide.derive_flags(df, "mid", "AUTOMOBILE", "BUILDING", ["artifacts_count", "artifacts_count__m1"], ["n_a", "n_b"])


_FLAG_CTE = cte("pop", "usage", "history", "contracts", also={"upsell": _UPSELL.replace("SELECT account_id, event_month, CASE", "SELECT account_id, CASE"), "flags": _FLAGS, "derived": _DERIVED})


@query("derived_product_flags", _FLAG_CTE + "SELECT * FROM derived")
def derived_product_flags(spark, path):
    return _flag_frame(Roles(spark, path))


@query(
    "business_exclusions",
    _FLAG_CTE
    + """SELECT * FROM (SELECT *, CASE WHEN class = 1 THEN NULL ELSE CAST(year(relevant_date) - 1996 AS INTEGER) END AS company_age,
         qoe_score - 3 AS seniority, top_subscription AS sales_business_unit FROM derived)
       WHERE sales_business_unit <> 'FURNITURE' AND top_subscription IS NOT NULL AND top_subscription <> '' AND NOT (class = 0 AND product LIKE '%mid%')
       AND (company_age IS NULL OR company_age >= 0) AND (seniority > 0 OR seniority IS NULL) AND (previous_product IS NULL OR previous_product <> 'Pure Upsell')
       AND lower(top_subscription) NOT LIKE '%mob%' AND count_ent = 0""",
)
def business_exclusions(spark, path):
    df = _flag_frame(Roles(spark, path)).select(
        "*",
        F.when(F.col("class") != 1, wide.company_age(F.lit(1996), F.col("relevant_date"))).alias("company_age"),
        (F.col("qoe_score") - 3).alias("seniority"),
        F.col("top_subscription").alias("sales_business_unit"),
    )
    return wide.apply_exclusions(df, "FURNITURE", "mid", "Pure Upsell", ["mob"])
