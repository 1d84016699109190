"""What the wide matrix and the runs on it need of the disk."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof
from tidemark.plans import cohort_queries, flow_queries
from tidemark.plans.roles import Roles
from tidemark.session import handed_over

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_mb(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")) / 1e6


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """40 accounts with orders, lines and parts of their own."""
    at = str(tmp_path_factory.mktemp("tables"))
    orders = spark.range(600).selectExpr(
        "id AS o_orderkey", "id % 40 AS o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 + 1 as int)) AS o_orderstatus", "cast(id * 997 % 500000 as double) AS o_totalprice",
        "cast(date_add(DATE'1996-01-01', cast(id * 3 as int)) as timestamp_ntz) AS o_orderdate", "element_at(array('1-URGENT', '2-HIGH', '5-LOW'), cast(id % 3 + 1 as int)) AS o_orderpriority",
    )
    lines = spark.range(2400).selectExpr(
        "id % 600 AS l_orderkey", "id % 50 AS l_partkey", "id % 7 AS l_suppkey", "cast(id % 7 + 1 as int) AS l_linenumber", "cast(id % 50 + 1 as double) AS l_quantity", "cast(id % 901 as double) AS l_extendedprice",
        "0.0D AS l_discount", "0.0D AS l_tax", "element_at(array('R', 'A', 'N'), cast(id % 3 + 1 as int)) AS l_returnflag", "'F' AS l_linestatus",
        "cast(date_add(DATE'1996-01-01', cast(id % 600 * 3 - id % 200 as int)) as timestamp_ntz) AS l_shipdate",
    )
    parts = spark.range(50).selectExpr("id AS p_partkey", "concat('part ', id % 20, ' bolt') AS p_name", "'Brand' AS p_brand", "element_at(array('ECONOMY', 'SMALL', 'PROMO'), cast(id % 3 + 1 as int)) AS p_type", "1 AS p_size", "1.0D AS p_retailprice")
    customers = spark.range(40).selectExpr("id AS c_custkey", "'n' AS c_name", "cast(id % 2 as int) AS c_nationkey", "1.0D AS c_acctbal", "'MACHINERY' AS c_mktsegment")
    nation = spark.range(2).selectExpr("cast(id as int) AS n_nationkey", "concat('nation ', id) AS n_name", "0 AS n_regionkey")
    region = spark.range(1).selectExpr("0 AS r_regionkey", "'region' AS r_name")
    for name, df in dict(orders=orders, lineitem=lines, part=parts, customer=customers, nation=nation, region=region).items():
        df.write.parquet(f"{at}/{name}.parquet")
    return at


def test_shuffle_files_go_with_the_step(spark):
    before = spark.conf.get(CLEANUP, "false")
    df = spark.range(300000).groupBy((F.col("id") * 7 % 100003).alias("k")).agg(F.sum("id").alias("s"))
    held = shuffle_mb(spark)
    out = handed_over(df)
    until = time.time() + 20
    while shuffle_mb(spark) > held + 0.2 and time.time() < until:
        time.sleep(0.2)
    assert shuffle_mb(spark) <= held + 0.2 and spark.conf.get(CLEANUP) == before
    assert out.exceptAll(df).isEmpty() and df.exceptAll(out).isEmpty() and out.schema == df.schema


def test_lines_meet_their_orders_once(spark, tables):
    frame = cohort_queries.feature_frame(Roles(spark, tables))
    assert not any("lineitem.parquet" in f or "part.parquet" in f for f in frame.inputFiles())
    assert frame.count() == Roles(spark, tables).pop().count() and frame.where("n_windows > 0 and n_replys > 0").count() > 20


def test_usage_features_read_the_written_lines(spark, tables):
    df = flow_queries.usage_features(spark, tables)
    assert not any("lineitem.parquet" in f for f in df.inputFiles())
    assert df.count() == Roles(spark, tables).pop().count() and df.where("n_tech > 0").count() > 0


def test_totals_and_distinct_counts_share_one_pass(spark):
    """Facts are read once; rows without a value still count as rows."""
    seen = spark.sparkContext.accumulator(0)

    def one(x):
        seen.add(1)
        return x

    day = dt.date(2020, 1, 1)
    facts = spark.range(300).select((F.col("id") % 3).alias("account_id"), F.date_add(F.lit(day), (F.col("id") % 90).cast("int")).alias("ts"), F.col("id").alias("x"), F.when(F.col("id") % 4 > 0, F.col("id") % 11).alias("v"))
    pop = spark.range(3).select(F.col("id").alias("account_id"), F.explode(F.array(*[F.lit(day + dt.timedelta(n)) for n in (0, 20, 45, 130, 500)])).alias("relevant_date"))
    marked = facts.withColumn("x", F.udf(one, "long").asNondeterministic()("x"))
    measures = {"n": asof.count(), "rows": asof.total(F.col("x")), "all": asof.distinct(), "few": asof.distinct(where=F.col("x") % 2 == 0, late=asof.Back(days=10))}
    got = asof.asof_aggregate(pop, marked, "ts", measures, asof.Back(days=30), F.col("v")).collect()
    assert seen.value == 300
    near = pop.join(facts, "account_id").where("ts between date_sub(relevant_date, 30) and relevant_date")
    few = F.count_distinct(F.when((F.col("x") % 2 == 0) & (F.col("ts") >= F.date_sub("relevant_date", 10)), F.col("v")))
    want = near.groupBy("account_id", "relevant_date").agg(F.count(F.lit(1)), F.sum("x"), F.count_distinct("v"), few).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 6


def test_model_input_reads_the_written_lines(spark, tables):
    frame = flow_queries.model_frame(Roles(spark, tables))
    assert not any("lineitem.parquet" in f for f in frame.inputFiles()) and "class" in frame.columns
