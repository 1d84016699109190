"""Weekly versions against a walk over the sorted rows; a module's day spread over many stretches."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import versions
from tidemark.operators.order import numbered

SCHEMA = "module_name string, date date, file_name string, file_type string, version_num_value double, tie int"


@pytest.fixture(autouse=True)
def many_stretches(spark):
    """Small tables are one stretch unless their partitions are left as they are."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def walk(rows):
    """The same, row after row: (module, week) -> ups, repeats, releases, snapshots, files so far."""
    out, seen, prev = {}, {}, {}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[5]))
    for i, (m, day, f, kind, v, _) in enumerate(rows):
        if m is None:
            continue
        last = prev.get(m)
        prev[m] = (v,)
        seen.setdefault(m, set()).add(f)
        if i == 0 or m == "" or day.day > 28 or kind == "xml":
            continue
        week = (day.day - 1) // 7 + 1
        step = [int(last is not None and None not in (v, last[0]) and v > last[0]), int(last is not None and None not in (v, last[0]) and v == last[0])]
        low = m.lower()
        if (m, week) not in out:
            out[m, week] = [0, 0, 0, 0, 0]
        else:
            out[m, week][0] += step[0]
            out[m, week][1] += step[1]
        out[m, week][2] += "release" in low
        out[m, week][3] += "snapshot" in low
        out[m, week][4] = len(seen[m])
    return out


def made(seed, n, hot, gaps=True):
    g = random.Random(seed)
    rows = []
    for i in range(n):
        m = "hot-release" if g.random() < hot else g.choice(["a", "B-Snapshot", "", None] if gaps else ["a", "b"])
        day = dt.date(2024, 3, 5) if m == "hot-release" and g.random() < 0.7 else dt.date(2024, 3, g.randint(1, 31))
        rows.append((m, day, f"f{g.randint(0, 60)}", g.choice(["jar", "jar", "xml"]), g.choice([1.0, 2.0, 3.0, None]), i))
    return rows


def run(spark, rows):
    got = versions.weekly_versions(spark.createDataFrame(rows, SCHEMA), ["tie"]).collect()
    return {(r["module_name"], r["week_num"]): [r["versioning_up_count"], r["versioning_stuck_count"], r["is_release"], r["is_snapshot"], r["files_per_module"]] for r in got}


def test_weekly_versions_equal_a_walk_over_the_rows(spark):
    for seed, hot in ((1, 0.4), (2, 0.9)):
        rows = made(seed, 1500, hot)
        assert run(spark, rows) == walk(rows)


def test_very_first_row_is_skipped_where_it_has_a_module(spark):
    rows = made(3, 400, 0.5, gaps=False)
    assert run(spark, rows) == walk(rows)


def test_a_module_day_is_spread_over_stretches(spark):
    df = spark.createDataFrame(made(4, 4000, 1.0), SCHEMA).where("date = '2024-03-05'")
    rows = [(r["at__"], r["tie"]) for r in numbered(df, ["module_name"], [F.col("date"), F.col("tie")], ["tie"], "at__").collect()]
    sizes = Counter(at >> 33 for at, _ in rows)
    assert len(sizes) > 1 and max(sizes.values()) < 0.75 * len(rows)
    assert [t for _, t in sorted(rows)] == sorted(t for _, t in rows)


def test_empty_input(spark):
    assert versions.weekly_versions(spark.createDataFrame([], SCHEMA), ["tie"]).collect() == []
