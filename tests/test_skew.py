"""Hot keys: a third of all rows on one key must neither change results nor pile up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, leads
from tidemark.operators.skew import hot_keys, spread_join


def hot(spark, n=9000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200 + 1).cast("int").alias("account_id"), F.col("id").alias("x")
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_a_plain_join(spark, how):
    facts = hot(spark)
    single = spark.range(150).select(F.col("id").cast("int").alias("account_id"), (F.col("id") * 2).alias("y"))
    a = spread_join(facts, single, "account_id", "x", how)
    b = facts.join(single, "account_id", how)
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_keys_are_found_and_sized(spark):
    few = hot(spark, 90000)
    cuts = hot_keys(few, ["account_id"], least=100)
    key = few.where("account_id = 0").select(F.xxhash64("account_id").alias("h")).first()["h"]
    assert cuts == {key: 3}  # four partitions, half a partition's share in each part: 30,000 / 11,250
    assert hot_keys(few, ["account_id"], 25_000) == {key: 2} and hot_keys(few.limit(0), ["account_id"]) == {}
    assert hot_keys(few.withColumn("account_id", F.lit(None).cast("int")), ["account_id"], 100) != {}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_largest_task_of_a_spread_join(spark, how):
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = hot(spark, 90000)
        few = spark.range(150).select(F.col("id").cast("int").alias("account_id"), (F.col("id") * 2).alias("y"))
        few = few.unionByName(few.withColumn("y", F.lit(-1).cast("long")))  # two rows a key
        out = spread_join(facts, few, "account_id", "x", how, hot_keys(facts, ["account_id"], 100))
        plain = facts.join(few, "account_id", how)
        assert out.columns == plain.columns and out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
        most = lambda d: d.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        # the hot key alone holds 60,000 rows of the join
        assert most(plain) >= 60000 and most(out) < 60000 / 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_usage_of_a_busy_account_with_many_environments(spark):
    ref = dt.date(2020, 6, 30)
    snaps = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).cast("int").alias("account_id"),
        F.col("id").alias("env"),
        F.date_sub(F.lit(ref), (F.col("id") % 200).cast("int")).alias("day"),
        (F.col("id") % 10).cast("double").alias("v"),
    )
    pop = snaps.select("account_id").distinct().withColumn("relevant_date", F.lit(ref))
    got = asof.usage_block(pop, snaps, "env", "day", {"v": asof.mean(F.col("v"))}, n_env="n")
    want = (
        snaps.join(pop, "account_id")
        .withColumn("period", asof.period_bucket(F.col("day"), F.col("relevant_date")))
        .where("period is not null")
        .groupBy("account_id", "relevant_date", "period")
        .agg(F.sum("v").alias("v"), F.count_distinct("env").alias("n"))
    )
    assert got.select(want.columns).exceptAll(want).isEmpty() and got.count() == want.count()


def test_activities_of_any_number_in_sparse_form(spark):
    """100,000 activities; the same numbers as the wide form for a few of them."""
    df = spark.range(300000).select((F.col("id") % 1000).alias("lead"), F.concat(F.lit("act "), (F.col("id") * 7 % 100000).cast("string")).alias("reason"))
    index = leads.activity_index(df, 2)
    assert index.count() == 100000 and index.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()[:] == (0, 99999, 100000)
    vectors = leads.activity_vectors(df, ["lead"], index)
    assert vectors.count() == 1000 and vectors.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, v: a + v))).first()[0] == 300000
    assert vectors.where(F.sort_array("indices") != F.col("indices")).isEmpty()
    some = [r["activity"] for r in index.where("idx % 20011 = 3").collect()]
    wide = leads.activity_pivot(df.withColumn("activity_date", F.lit(0)), ["lead"], activities=some, prune=False)
    wide = wide.unpivot(["lead"], [f"CS-{a}" for a in some], "activity", "n").where("n > 0")
    long = leads.activity_counts(df, ["lead"], index).join(index.drop("n"), "idx").where(F.col("activity").isin(some))
    long = long.select("lead", F.concat(F.lit("CS-"), "activity").alias("activity"), "n")
    assert wide.count() > 0 and wide.exceptAll(long).isEmpty() and long.exceptAll(wide).isEmpty()


def test_sparse_activities_of_odd_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "score"), (2, "b"), (None, "a"), (3, None), (4, "a")], "activity__ int, reason string")
    index = leads.activity_index(df, 1)
    assert [(r["activity"], r["n"], r["idx"]) for r in index.collect()] == [("a", 4, 0)]
    got = leads.with_sparse_vector(leads.activity_vectors(df, ["activity__"], index), 1)
    assert {r["activity__"]: (r["indices"], r["counts"]) for r in got.collect()} == {1: ([0], [2]), 2: ([], []), None: ([0], [1]), 3: ([], []), 4: ([0], [1])}
    assert {r["activity__"]: list(r["features"].toArray()) for r in got.collect()}[1] == [2.0]
    assert leads.activity_vectors(df.limit(0), ["activity__"], index).count() == 0
    with pytest.raises(ValueError):
        leads.frequent_activities(df, 1, None)
    assert leads.frequent_activities(df, 0, ["a", "b"]) == ["a", "b"]
