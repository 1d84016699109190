"""The given tables in the roles the feature operators expect.

`Roles(spark, path)` gives DataFrames; `CTE` holds the same definitions as SQL for
the statements the queries are compared with. `cte("pop", ...)` opens a statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import load_tables

STORAGE = ["artifacts_count", "artifacts_size", "binaries_count", "binaries_size", "items_count"]
USERS = ["number_of_permissions", "internal_groups", "number_of_users"]
# reference dates for facts that only cover one month
TOUCH_DATES = ("2024-01-10", "2024-01-20", "2024-01-30")
NATION_DATES = ("1996-03-01", "1998-07-15", "2000-12-31")
PACKAGES = {"economy": "ECONOMY", "small": "SMALL", "medium": "MEDIUM", "standard": "STANDARD", "large": "LARGE", "promo": "PROMO"}
AS_OF = "2001-08-01"


class Roles:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Each table is opened once per query: a second read would list its files again."""
        if name not in self._tables:
            self._tables.update(load_tables(self.spark, self.path, [name]))
        return self._tables[name]

    # ---- populations
    def pop(self) -> DataFrame:
        o = self.table("orders")
        return o.groupBy(
            F.col("o_custkey").alias("account_id"),
            F.date_sub(F.col("o_orderdate").cast("date"), 90).alias("relevant_date"),
        ).agg(F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("class"))

    def pop_touch(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("account_id"),
            F.explode(F.array(*[F.lit(d).cast("date") for d in TOUCH_DATES])).alias("relevant_date"),
        )

    def pop_nation(self, dates=NATION_DATES) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("account_id"),
            F.explode(F.array(*[F.lit(d).cast("date") for d in dates])).alias("relevant_date"),
        )

    def pop_month(self) -> DataFrame:
        return (
            self.table("orders")
            .select(F.col("o_custkey").alias("account_id"), F.trunc("o_orderdate", "month").alias("relevant_date"))
            .distinct()
        )

    # ---- facts
    def usage(self, part: bool = False, accounts: DataFrame | None = None) -> DataFrame:
        """Usage snapshots from lines; of the given accounts only, if there are any, whose orders are picked before they meet lines."""
        li, o = self.table("lineitem"), self.table("orders")
        if accounts is not None:
            o = o.join(accounts.select(F.col("account_id").alias("o_custkey")), "o_custkey", "left_semi")
        df = li.join(o, li["l_orderkey"] == o["o_orderkey"])
        cols = [
            F.col("o_custkey").alias("account_id"),
            F.col("l_suppkey").alias("environment_service_id"),
            F.col("l_shipdate").cast("date").alias("art_create_date"),
            F.col("l_quantity").alias("avg_repos"),
            F.col("l_quantity").alias("artifacts_count"),
            F.col("l_extendedprice").alias("artifacts_size"),
            F.col("l_linenumber").cast("double").alias("binaries_count"),
            F.round(F.col("l_extendedprice") / 7, 2).alias("binaries_size"),
            (F.col("l_quantity") + F.col("l_linenumber")).alias("items_count"),
            F.col("l_linenumber").cast("double").alias("number_of_users"),
            F.floor(F.col("l_quantity") / 10).cast("double").alias("internal_groups"),
            F.col("l_quantity").alias("number_of_permissions"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("db_type"),
        ]
        if part:
            p = self.table("part")
            df = df.join(p, df["l_partkey"] == p["p_partkey"])
            cols += [
                F.col("p_type").alias("package_type"),
                F.col("p_name").alias("subject"),
                F.col("p_brand").alias("version"),
                F.col("o_orderdate").alias("opened"),
            ]
        return df.select(*cols)

    def touch(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("account_id"), "event_id", "ts", "event_type", "value"
        )

    def contracts(self) -> DataFrame:
        """Contracts from orders: yearly terms, some without an end."""
        o = self.table("orders")
        start = F.col("o_orderdate").cast("date")
        return o.select(
            F.col("o_custkey").alias("account_id"),
            F.col("o_orderkey").alias("contract_id"),
            start.alias("startdate"),
            F.when(F.col("o_totalprice") < 400000, F.add_months(start, 12)).alias("enddate"),
            F.when(F.col("o_totalprice") < 200000, F.add_months(start, 6)).alias("cotermed_date"),
            F.when(F.col("o_totalprice") < 100000, F.add_months(start, 3)).alias("cancellation_date"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("tier"),
            F.when(F.col("o_totalprice") > 50000, F.floor(F.col("o_totalprice") / 50000).cast("int")).alias("servers"),
            F.when(F.col("o_totalprice") < 300000, F.floor(F.col("o_totalprice") / 20000).cast("int")).alias("product_servers"),
        )

    def events_of_contract(self) -> DataFrame:
        """Contract events: an old and a new product per order, by its lines."""
        o = self.table("orders")
        lines = self.table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("product_id"), F.max("l_partkey").alias("product_renewal_id")
        )
        return o.join(lines, o["o_orderkey"] == lines["l_orderkey"]).select(
            F.col("o_custkey").alias("account_id"),
            F.col("o_orderkey").alias("event_id"),
            F.col("o_orderpriority").alias("sales_business_unit"),
            F.col("o_orderstatus").alias("sales_team"),
            "product_id",
            "product_renewal_id",
            (F.col("o_totalprice") - 200000).alias("net_new_arr"),
            F.when(F.col("o_orderstatus") == "P", F.lit("Customer Success")).otherwise(F.lit("Sales")).alias("event_type"),
            F.col("o_orderdate").cast("date").alias("event_month"),
            F.when(F.col("o_orderstatus") == "O", "false").otherwise("true").alias("isclosed"),
            F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "O", "false").alias("iswon"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_name"))

    def accounts(self) -> DataFrame:
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        since = F.when(
            F.col("c_acctbal") >= 0, F.date_add(F.lit("1995-01-01").cast("date"), F.floor(F.col("c_acctbal") / 10).cast("int"))
        )
        return (
            c.join(n, c["c_nationkey"] == n["n_nationkey"])
            .join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(
                F.col("c_custkey").alias("account_id"),
                F.col("n_name").alias("logo"),
                F.col("r_name").alias("territory"),
                F.col("c_mktsegment").alias("top_subscription"),
                since.alias("customer_since"),
                F.col("c_name").alias("name"),
            )
        )

    def logos(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_name").alias("logo"), F.col("n_nationkey").alias("pbid"), F.col("n_regionkey").alias("number_of_accounts")
        )

    def history(self) -> DataFrame:
        from ..operators.cohort import contract_history

        return contract_history(
            self.events_of_contract(), self.products(), self.accounts(), self.logos(), AS_OF, cloud_unit="5-LOW"
        )

    def scored(self) -> DataFrame:
        """Scored rows: a binary class and a score on a coarse grid (many ties)."""
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("class"),
            F.round(F.col("l_discount") * 5 + F.col("l_tax") * 5 + F.col("l_linenumber") / 100, 2).alias("score"),
            F.col("l_suppkey").alias("fold_key"),
        )


_DATES = lambda ds: ", ".join(f"(DATE '{d}')" for d in ds)

CTE = {
    "pop": (
        (),
        """SELECT o_custkey AS account_id, CAST(o_orderdate AS DATE) - 90 AS relevant_date,
           max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS class FROM orders GROUP BY 1, 2""",
    ),
    "pop_touch": (
        (),
        f"SELECT c_custkey AS account_id, d AS relevant_date FROM customer CROSS JOIN (VALUES {_DATES(TOUCH_DATES)}) v(d)",
    ),
    "pop_nation": (
        (),
        f"SELECT n_nationkey AS account_id, d AS relevant_date FROM nation CROSS JOIN (VALUES {_DATES(NATION_DATES)}) v(d)",
    ),
    "pop_nation_touch": (
        (),
        f"SELECT n_nationkey AS account_id, d AS relevant_date FROM nation CROSS JOIN (VALUES {_DATES(TOUCH_DATES)}) v(d)",
    ),
    "pop_month": (
        (),
        "SELECT DISTINCT o_custkey AS account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS relevant_date FROM orders",
    ),
    "usage": (
        (),
        """SELECT o_custkey AS account_id, l_suppkey AS environment_service_id, CAST(l_shipdate AS DATE) AS art_create_date,
           l_quantity AS avg_repos, l_quantity AS artifacts_count, l_extendedprice AS artifacts_size,
           CAST(l_linenumber AS DOUBLE) AS binaries_count, round(l_extendedprice / 7, 2) AS binaries_size,
           l_quantity + l_linenumber AS items_count, CAST(l_linenumber AS DOUBLE) AS number_of_users,
           CAST(floor(l_quantity / 10) AS DOUBLE) AS internal_groups, l_quantity AS number_of_permissions,
           l_returnflag AS flag, l_linestatus AS db_type, l_partkey AS partkey, o_orderdate AS opened
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "usage_part": (
        ("usage",),
        "SELECT u.*, p_type AS package_type, p_name AS subject, p_brand AS version FROM usage u JOIN part ON partkey = p_partkey",
    ),
    "contracts": (
        (),
        """SELECT o_custkey AS account_id, o_orderkey AS contract_id, CAST(o_orderdate AS DATE) AS startdate,
           CASE WHEN o_totalprice < 400000 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) END AS enddate,
           CASE WHEN o_totalprice < 200000 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 6 MONTH AS DATE) END AS cotermed_date,
           CASE WHEN o_totalprice < 100000 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) END AS cancellation_date,
           o_orderstatus AS status, o_orderpriority AS tier,
           CASE WHEN o_totalprice > 50000 THEN CAST(floor(o_totalprice / 50000) AS INTEGER) END AS servers,
           CASE WHEN o_totalprice < 300000 THEN CAST(floor(o_totalprice / 20000) AS INTEGER) END AS product_servers
           FROM orders""",
    ),
    "contract_events": (
        (),
        """SELECT o_custkey AS account_id, o_orderkey AS event_id, o_orderpriority AS sales_business_unit,
           o_orderstatus AS sales_team, product_id, product_renewal_id, o_totalprice - 200000 AS net_new_arr,
           CASE WHEN o_orderstatus = 'P' THEN 'Customer Success' ELSE 'Sales' END AS event_type,
           CAST(o_orderdate AS DATE) AS event_month,
           CASE WHEN o_orderstatus = 'O' THEN 'false' ELSE 'true' END AS isclosed,
           CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'false' END AS iswon
           FROM orders JOIN (SELECT l_orderkey, min(l_partkey) AS product_id, max(l_partkey) AS product_renewal_id
                             FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey""",
    ),
    "accounts": (
        (),
        """SELECT c_custkey AS account_id, n_name AS logo, r_name AS territory, c_mktsegment AS top_subscription,
           CASE WHEN c_acctbal >= 0 THEN DATE '1995-01-01' + CAST(floor(c_acctbal / 10) AS INTEGER) END AS customer_since,
           c_name AS name
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "history": (
        ("contract_events", "accounts"),
        f"""SELECT ca.account_id, ca.event_id, sales_business_unit, sales_team, np.p_type AS new_product_name, pp.p_type AS prev_product_name,
           CASE WHEN net_new_arr > 0 AND event_type = 'Customer Success' THEN 1 ELSE 0 END AS pure_upsell_flag,
           event_month, territory, n_nationkey AS pbid,
           max(event_month) OVER (PARTITION BY ca.account_id) AS last_event_month,
           min(event_month) OVER (PARTITION BY ca.account_id) AS first_event_month
           FROM contract_events ca LEFT JOIN part pp ON pp.p_partkey = ca.product_id
           LEFT JOIN part np ON np.p_partkey = ca.product_renewal_id
           LEFT JOIN accounts da ON da.account_id = ca.account_id LEFT JOIN nation ON da.logo = n_name
           WHERE isclosed = 'true' AND (iswon = 'true' OR iswon IS NULL) AND sales_business_unit <> '5-LOW'
           AND event_month <= DATE '{AS_OF}'""",
    ),
    "scored": (
        (),
        """SELECT l_orderkey * 10 + l_linenumber AS row_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS class,
           round(l_discount * 5 + l_tax * 5 + CAST(l_linenumber AS DOUBLE) / 100, 2) AS score, l_suppkey AS fold_key FROM lineitem""",
    ),
}


def cte(*names: str, also: dict[str, str] | None = None) -> str:
    """'WITH a AS (...), b AS (...)' with what the named roles build on."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        needs, body = CTE[name]
        for n in needs:
            add(n)
        done.setdefault(name, body)

    for n in names:
        add(n)
    done.update(also or {})
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in done.items()) + "\n"
