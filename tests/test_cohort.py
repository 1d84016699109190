import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import assemble, cohort

D = dt.date


def test_contradicting_labels_remove_the_whole_account(spark):
    rows = [(1, D(2020, 1, 1), 0), (1, D(2020, 1, 1), 1), (1, D(2020, 5, 1), 0), (2, D(2020, 1, 1), 1), (2, D(2020, 2, 1), 0)]
    df = spark.createDataFrame(rows, "account_id int, relevant_date date, class int")
    assert {r["account_id"] for r in cohort.drop_contradictions(df).collect()} == {2}
    assert cohort.drop_contradictions(df).count() == 2


def test_time_from_renewal_cycle(spark):
    pop = spark.createDataFrame(
        [(1, D(2020, 6, 1)), (1, D(2019, 1, 5)), (1, D(2018, 1, 1)), (2, D(2020, 1, 1))], "account_id int, relevant_date date"
    )
    hist = spark.createDataFrame([(1, D(2019, 1, 1)), (1, D(2020, 1, 31))], "account_id int, event_month date")
    got = {(r["account_id"], r["relevant_date"]): r["tfr"] for r in cohort.time_from_renewal(pop, hist).collect()}
    # no positive difference: 12 + the largest one; no event at all: null
    assert got == {(1, D(2020, 6, 1)): 5, (1, D(2019, 1, 5)): 12, (1, D(2018, 1, 1)): 0, (2, D(2020, 1, 1)): None}


def test_random_month_is_repeatable_and_within_bounds(spark):
    hist = spark.range(300).select(
        (F.col("id") % 40).cast("int").alias("account_id"), F.col("id").alias("event_id"), F.lit("2015-03-01").cast("date").alias("first_event_month")
    )
    acc = spark.range(40).select(F.col("id").cast("int").alias("account_id"), F.lit(None).cast("date").alias("customer_since"))
    a = cohort.random_reference_month(hist, acc, "2020-01-01").collect()
    b = cohort.random_reference_month(hist.repartition(7), acc, "2020-01-01").collect()
    assert sorted(a) == sorted(b) and len(a) == 40
    assert all(D(2015, 7, 1) <= r["relevant_date"] <= D(2019, 10, 1) for r in a)
    assert len({r["relevant_date"] for r in a}) > 10
    seeded = cohort.random_reference_month(hist, acc, "2020-01-01", seed=1, method="rand")
    assert seeded.count() == 40


def test_controls_collapse_duplicates(spark):
    a = spark.createDataFrame(
        [(1, "u", "t", D(2020, 1, 1), 1, "p"), (2, "u", "t", D(2020, 1, 1), 0, "p")],
        "account_id int, sales_business_unit string, territory string, relevant_date date, upgraded int, pbid string",
    )
    acc = spark.createDataFrame([(1, D(2018, 5, 5))], "account_id int, customer_since date")
    out = cohort.add_controls(a.unionByName(a), acc).collect()
    assert len(out) == 3
    assert [r["relevant_date"] for r in out if r["account_id"] == 1 and r["upgraded"] == 0] == [D(2019, 1, 1)]


def test_exclusions_follow_three_valued_logic(spark):
    cols = "account_id int, sales_business_unit string, top_subscription string, class int, product string, company_age int, seniority int, previous_product string, count_ent int"
    ok = [1, "EU", "pro", 0, "pro", None, None, None, 0]
    rows = [ok]
    for i, change in enumerate([{1: "Cloud"}, {2: ""}, {4: "Enterprise+"}, {5: -1}, {6: 0}, {7: "Pure Upsell"}, {8: None}, {8: 1}, {2: "x mp"}, {1: None}]):
        r = list(ok)
        r[0] = i + 2
        for k, v in change.items():
            r[k] = v
        rows.append(r)
    rows.append([20, "EU", "pro", 1, "Enterprise+", 3, 2, "base", 0])
    out = assemble.apply_exclusions(spark.createDataFrame([tuple(r) for r in rows], cols), "Cloud", "Enterprise", "Pure Upsell", ["mp"])
    assert sorted(r["account_id"] for r in out.collect()) == [1, 20]


def test_assembly_keeps_one_row_per_key(spark):
    pop = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2020, 1, 1))], "account_id int, relevant_date date")
    block = spark.createDataFrame([(1, D(2020, 1, 1), 7)], "account_id int, relevant_date date, n int")
    out = assemble.assemble(pop, [block], {"n": 0}).orderBy("account_id").collect()
    assert [r["n"] for r in out] == [7, 0]
