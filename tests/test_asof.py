"""Edges of the point-in-time operators on hand-made frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, blocks
from tidemark.operators.asof import Back

D = dt.date


def pop(spark, rows):
    return spark.createDataFrame(rows, "account_id int, relevant_date date")


def test_shared_window_edges_go_to_the_first_window(spark):
    ref = D(2020, 8, 15)
    days = {
        D(2020, 8, 15): "m0", D(2020, 7, 15): "m0", D(2020, 7, 14): "m1", D(2020, 6, 15): "m1", D(2020, 6, 14): "m2",
        D(2020, 5, 15): "q1", D(2020, 5, 16): "m2", D(2020, 4, 15): "q1", D(2020, 4, 14): None, D(2020, 2, 15): "q2",
        D(2020, 1, 15): "q2", D(2020, 1, 14): None, D(2020, 8, 16): None, D(2020, 2, 16): None,
    }
    df = spark.createDataFrame([(k, ref) for k in days], "day date, ref date")
    got = {r["day"]: r["p"] for r in df.select("day", asof.period_bucket(F.col("day"), F.col("ref")).alias("p")).collect()}
    assert got == days


def test_month_end_edges(spark):
    df = spark.createDataFrame([(D(2020, 2, 29), D(2020, 3, 31)), (D(2020, 2, 28), D(2020, 3, 31))], "day date, ref date")
    got = [r["p"] for r in df.orderBy(F.desc("day")).select(asof.period_bucket(F.col("day"), F.col("ref")).alias("p")).collect()]
    assert got == ["m0", "m1"]


def test_moment_on_the_reference_day_counts_only_at_midnight(spark):
    ref = D(2020, 5, 10)
    fact = spark.createDataFrame(
        [(1, dt.datetime(2020, 5, 10)), (1, dt.datetime(2020, 5, 10, 0, 0, 1)), (1, dt.datetime(2019, 5, 10)), (1, dt.datetime(2019, 5, 9, 23, 59))],
        "account_id int, ts timestamp_ntz",
    )
    out = asof.asof_aggregate(pop(spark, [(1, ref), (2, ref)]), fact, "ts", {"n": asof.count()}, Back(months=12)).collect()
    assert [(r["account_id"], r["n"]) for r in out] == [(1, 2)]


def test_null_distinct_values_are_rows_but_no_values(spark):
    fact = spark.createDataFrame(
        [(1, D(2020, 1, 1), None, 5), (1, D(2020, 1, 2), "a", 1), (1, D(2020, 1, 3), "a", 1)], "account_id int, ts date, v string, x int"
    )
    p = pop(spark, [(1, D(2020, 1, 10))])
    m = {"n": asof.distinct(), "s": asof.total(F.col("x"))}
    for out in (
        asof.asof_aggregate(p, fact, "ts", m, Back(months=2), F.col("v")),
        asof.asof_running(p, fact, F.col("ts"), m, F.col("v")),
    ):
        r = out.first()
        assert (r["n"], r["s"]) == (1, 7)


def test_no_fact_after_the_date_and_no_row_without_facts(spark):
    fact = spark.createDataFrame([(1, D(2020, 6, 1))], "account_id int, ts date")
    p = pop(spark, [(1, D(2020, 5, 31)), (1, D(2020, 6, 1)), (2, D(2021, 1, 1))])
    rows = asof.asof_running(p, fact, F.col("ts"), {"n": asof.count()}).collect()
    assert [(r["account_id"], r["relevant_date"]) for r in rows] == [(1, D(2020, 6, 1))]


def brute_changes(points, ref):
    past = sorted((d, v) for d, v in points if d <= ref)
    if not past or past[-1][1] is None:
        return None
    other = [d for d, v in past if v is not None and v != past[-1][1]]
    return (ref - max(other)).days if other else None


def test_days_since_change_against_brute_force(spark):
    rng = random.Random(3)
    day = lambda i: D(2020, 1, 1) + dt.timedelta(days=i)
    series = {
        1: [(day(i), 5.0) for i in range(5)],  # never changes
        2: [(day(0), 1.0), (day(3), 2.0), (day(9), 2.0)],  # changes once
        3: [(day(0), 1.0), (day(2), None), (day(4), 1.0), (day(6), 3.0), (day(8), None)],  # nulls
        4: [(day(i), rng.choice([1.0, 2.0, None])) for i in range(40)],
        5: [(day(0), 1.0), (day(1), 2.0), (day(2), 1.0)],  # returns to an old value
    }
    snaps = spark.createDataFrame([(k, d, v) for k, s in series.items() for d, v in s], "account_id int, day date, m double")
    dates = [day(i) for i in (0, 1, 2, 4, 7, 8, 20, 60)]
    p = pop(spark, [(k, d) for k in series for d in dates])
    got = {
        (r["account_id"], r["relevant_date"]): r["days_from_m_change"]
        for r in asof.days_since_change(p, snaps, "day", ["m"]).collect()
    }
    want = {(k, d): brute_changes(s, d) for k, s in series.items() for d in dates}
    assert got == {k: v for k, v in want.items() if v is not None}


def test_active_contracts_against_brute_force(spark):
    rng = random.Random(5)
    start = lambda: D(2019, 1, 1) + dt.timedelta(days=rng.randrange(400))
    rows = []
    for k in range(6):
        for _ in range(12):
            s = start()
            e = rng.choice([None, s + dt.timedelta(days=rng.randrange(-40, 300))])
            rows.append((k, s, e, rng.choice(["Co-termed", "Live"]), rng.choice(["ent", "pro"])))
    df = spark.createDataFrame(rows, "account_id int, startdate date, enddate date, status string, tier string")
    dates = [D(2019, m, d) for m in (1, 5, 9, 12) for d in (1, 17)]
    out = blocks.contracts_active(pop(spark, [(k, d) for k in range(6) for d in dates]), df, "Co-termed", {"count_ent": F.col("tier") == "ent"})
    got = {(r["account_id"], r["relevant_date"]): (r["n_active_contracts"], r["count_ent"], r["is_cotermed"]) for r in out.collect()}
    want = {}
    for k in range(6):
        for d in dates:
            seen = [r for r in rows if r[0] == k and d >= r[1].replace(day=1)]
            if seen:
                live = [r for r in seen if r[2] is not None and d <= r[2]]
                cot = any(r[3] == "Co-termed" and r[2] is not None and d >= r[2] for r in seen)
                want[k, d] = (len({r[1] for r in live}), len({r[1] for r in live if r[4] == "ent"}), int(cot))
    assert got == want


def test_a_busy_account_meets_its_dates_without_a_join(spark):
    """A third of all facts on one account: they are steps by day, not rows of a join."""
    fact = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("int").alias("account_id"),
        F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("ts"),
        F.col("id").alias("x"),
    )
    p = fact.select("account_id", F.col("ts").alias("relevant_date")).distinct()
    out = asof.asof_aggregate(p, fact, "ts", {"n": asof.count(), "s": asof.total(F.col("x"))}, Back(months=3))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    want = p.join(fact, "account_id").where("ts between add_months(relevant_date, -3) and relevant_date").groupBy("account_id", "relevant_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("s")
    )
    assert out.count() == want.count() and out.exceptAll(want).isEmpty()


@pytest.mark.parametrize("days", [0, 90])
def test_day_window(spark, days):
    fact = spark.createDataFrame([(1, D(2020, 3, 1)), (1, D(2020, 5, 30))], "account_id int, ts date")
    out = asof.asof_aggregate(pop(spark, [(1, D(2020, 5, 30))]), fact, "ts", {"n": asof.count()}, Back(days=days)).first()
    assert out["n"] == (2 if days == 90 else 1)


BACKS = [Back(months=1), Back(months=4), Back(months=12), Back(months=12, from_month_start=True), Back(days=0), Back(days=1), Back(days=90), Back(boundary_months=0), Back(boundary_months=12)]


def month_back(d, m):
    import calendar

    y, n = divmod(d.year * 12 + d.month - 1 - m, 12)
    return D(y, n + 1, min(d.day, calendar.monthrange(y, n + 1)[1]))


def lower_bound(back, ref):
    if back.days is not None:
        return ref - dt.timedelta(days=back.days)
    if back.boundary_months is not None:
        return month_back(ref.replace(day=1), back.boundary_months)
    return month_back(ref.replace(day=1) if back.from_month_start else ref, back.months)


@pytest.mark.parametrize("back", BACKS, ids=str)
def test_windows_against_brute_force(spark, back):
    """A reference date on every day, one account with a third of all facts, gaps, ties and nulls."""
    rng = random.Random(7)
    start = dt.datetime(2019, 1, 1)
    facts = []
    for i in range(900):
        t = start + dt.timedelta(days=rng.randrange(500), hours=rng.choice([0, 0, 0, 13]))
        facts.append((0 if i % 3 == 0 else rng.randrange(1, 9), t, rng.choice(["a", "b", "c", None]), rng.choice([1, 5, -3, None]), rng.random() < 0.5))
    facts += [(None, start, "a", 1, True), (1, None, "a", 1, True), (7, dt.datetime(2020, 2, 29), "x", 9, True), (7, dt.datetime(2019, 2, 28, 1), "x", 9, True), (7, dt.datetime(2019, 3, 31), "y", -9, False)]
    refs = [(k, D(2019, 1, 1) + dt.timedelta(days=i)) for k in (0, 1, 7) for i in range(0, 800, 1 if k != 1 else 3)] + [(99, D(2020, 1, 1))]
    fact = spark.createDataFrame(facts, "account_id int, ts timestamp_ntz, v string, x int, hit boolean")
    short = Back(days=10)
    x, hit = F.col("x"), F.col("hit")
    measures = {
        "n": asof.count(), "n_hit": asof.count(hit), "total": asof.total(x), "avg": asof.mean(x, hit), "kinds": asof.distinct(), "kinds_hit": asof.distinct(hit),
        "kinds_late": asof.distinct(late=short), "top": asof.largest(x), "low": asof.smallest(x, hit),
    }
    got = asof.asof_aggregate(pop(spark, refs), fact, "ts", measures, back, F.col("v"))
    want = set()
    for k, ref in refs:
        mine = [f for f in facts if f[0] == k and f[1] is not None and f[1].date() >= lower_bound(back, ref) and f[1] <= dt.datetime(ref.year, ref.month, ref.day)]
        if mine:
            xs, hs = [f[3] for f in mine if f[3] is not None], [f[3] for f in mine if f[3] is not None and f[4]]
            near = {f[2] for f in mine if f[1].date() >= ref - dt.timedelta(days=10)} - {None}
            want.add((
                k, ref, len(mine), sum(f[4] for f in mine), sum(xs) if xs else None, round(sum(hs) / len(hs), 9) if hs else None,
                len({f[2] for f in mine} - {None}), len({f[2] for f in mine if f[4]} - {None}), len(near), max(xs, default=None), min(hs, default=None),
            ))
    assert {tuple(round(c, 9) if isinstance(c, float) else c for c in r) for r in got.collect()} == want


def test_windows_join_no_dates_with_facts(spark):
    fact = spark.range(1000).select((F.col("id") % 3).cast("int").alias("account_id"), F.lit(D(2020, 1, 1)).alias("ts"), F.col("id").alias("v"))
    p = pop(spark, [(0, D(2020, 1, 2))])
    for m in ({"n": asof.count(), "k": asof.distinct()}, {"top": asof.largest(F.col("v"))}):
        out = asof.asof_aggregate(p, fact, "ts", m, Back(months=12), F.col("v"))
        assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_steps_of_a_hot_account_are_few(spark):
    """A third of all facts on one account: what moves is a row per account and day, not per fact."""
    fact = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 + 1).cast("int").alias("account_id"), F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") % 60).cast("int")).alias("ts")
    )
    refs = spark.range(60).select(F.explode(F.sequence(F.lit(0), F.lit(100))).alias("account_id"), F.date_add(F.lit(D(2020, 1, 1)), F.col("id").cast("int")).alias("relevant_date"))
    out = asof.asof_aggregate(refs, fact, "ts", {"n": asof.count()}, Back(days=20))
    per = out.groupBy("account_id").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).collect()
    assert max(r["rows"] for r in per) == 60
    assert next(r["n"] for r in per if r["account_id"] == 0) == sum(1 for i in range(0, 60_000, 3) if 39 <= i % 60)


def test_usage_moves_facts_once_and_their_folds_once(spark):
    """Facts go to (account, month), folds to (account, date); no grouping in between moves them again."""
    pop = spark.sql("SELECT * FROM VALUES (1, DATE'2020-03-15'), (1, DATE'2020-05-31'), (2, DATE'2020-03-15'), (CAST(NULL AS INT), DATE'2020-03-15'), (2, CAST(NULL AS DATE)) AS t(account_id, relevant_date)")
    snaps = spark.range(400).selectExpr(
        "if(id % 11 = 0, NULL, cast(id % 2 + 1 as int)) AS account_id", "id % 3 AS env",
        "if(id % 13 = 0, NULL, date_add(DATE'2020-01-20', cast(id * 7 % 140 as int))) AS day", "if(id % 5 = 0, NULL, cast(id * 7 % 10 as double)) AS v",
    )
    v = F.col("v")
    inner = {"c": asof.count(v > 3), "t": asof.total(v), "a": asof.mean(v), "hi": asof.largest(v), "lo": asof.smallest(v)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = asof.usage_block(pop, snaps, "env", "day", inner, n_env="n")
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 3
        period = asof.period_bucket(F.col("day"), F.col("relevant_date"))
        per_env = snaps.join(pop, "account_id").withColumn("period", period).where("period is not null").groupBy("account_id", "relevant_date", "period", "env")
        per_env = per_env.agg(F.count(F.when(v > 3, 1)).alias("c"), F.sum("v").alias("t"), F.avg("v").alias("a"), F.max("v").alias("hi"), F.min("v").alias("lo"))
        want = per_env.groupBy("account_id", "relevant_date", "period").agg(*[F.sum(n).alias(n) for n in inner], F.count(F.lit(1)).alias("n"))
        r = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in df.select(want.columns).collect())
        assert r(got) == r(want) and len(r(want)) == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
