"""Sources and sinks on the given tables, with their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import tables as src
from .registry import query
from .roles import Roles


@query("load_tables", "SELECT * FROM orders")
def load_tables(spark, path):
    return src.load_tables(spark, path, ["orders"])["orders"]


@query(
    "csv_roundtrip",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_orderpriority || ';"x' AS o_orderpriority__1 FROM orders""",
)
def csv_roundtrip(spark, path):
    df = src.load_tables(spark, path, ["orders"])["orders"]
    twice = df.select("*", F.concat("o_orderpriority", F.lit(';"x')).alias("o_orderpriority"))
    at = scratch_dir(spark)
    src.write_csv(twice, at)
    schema = twice.toDF(*src.suffix_duplicates(twice.columns)).schema
    return src.read_csv(spark, at, schema)


@query("stage_csv", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1")
def stage_csv(spark, path):
    def step(df):
        return df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("spent"))

    return src.run_stage(src.load_tables(spark, path, ["orders"])["orders"], step, scratch_dir(spark))


@query("export_scores", "SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS class_pred FROM customer")
def export_scores(spark, path):
    c = src.load_tables(spark, path, ["customer"])["customer"]
    at = scratch_dir(spark)
    src.export(c.select("c_custkey", F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("class_pred")), at, "parquet")
    return spark.read.parquet(at)


@query("snapshot_cache", "SELECT c_custkey, 1 AS loads FROM customer")
def snapshot_cache(spark, path):
    """Loaded on day 0, reused on day 6: one load in all."""
    c = src.load_tables(spark, path, ["customer"])["customer"]
    at, loads = scratch_dir(spark), []

    def loader():
        loads.append(1)
        return c.select("c_custkey")

    src.cached(spark, at, "accounts", loader, dt.date(2024, 1, 1))
    again = src.cached(spark, at, "accounts", loader, dt.date(2024, 1, 7))
    return again.withColumn("loads", F.lit(len(loads)))


@query("temp_materialize", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def temp_materialize(spark, path):
    o = Roles(spark, path).table("orders")
    return src.materialize(o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), "orders_per_account")


@query("head_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 7")
def head_n(spark, path):
    o = Roles(spark, path).table("orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("neg"))
    return src.head_n(o, ["neg", "o_orderkey"], 7).drop("neg")
