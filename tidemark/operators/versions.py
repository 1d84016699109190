"""File deployments per module and week of month, and URL counts per group."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import file_name, file_type, main_url, version_number, version_token
from .order import PART, numbered


def path_parts(df: DataFrame, col: str) -> DataFrame:
    token = version_token(F.col(col))
    return df.select(
        "*",
        file_name(F.col(col)).alias("file_name"),
        file_type(F.col(col)).alias("file_type"),
        token.alias("version"),
        version_number(token).alias("version_number"),
    )


def distinct_main_urls(df: DataFrame, group: str, url: str, name: str = "n_main_urls") -> DataFrame:
    """Distinct scheme+host per group: distinct first, so a hot group is counted in parts."""
    return (
        df.select(group, main_url(F.col(url)).alias("m"))
        .distinct()
        .groupBy(group)
        .agg(F.count("m").alias(name))
    )


def distinct_main_urls_in(urls: Column) -> Column:
    """The same for an array of URLs in one row; 0 for an empty or missing list."""
    hosts = F.filter(F.transform(urls, main_url), lambda u: u.isNotNull())
    return F.coalesce(F.size(F.array_distinct(hosts)), F.lit(0))


def weekly_versions(df: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Per module and week of month: version ups and repeats, releases, snapshots, files so far.

    Input: date, module_name, file_name, file_type, version_num_value and the tie
    columns; the input order is (module_name, date, tie). A row is skipped if it is
    the very first, has no module, lies after day 28 or is xml; it still is the row
    the next one is compared with. The first row of a module's week only opens it.

    The input is read twice: for range bounds, and to be partitioned by them in the input order and
    written with each row's number in
    it, so a module or a module's day of any size is spread over stretches. The row before is
    looked up inside the stretch, and for its first row from the last row of the module's stretch
    before; files are counted by their first row, whole stretches by their totals. Rows without
    module are left out, but may be the very first.
    """
    keep = ["module_name", "date", "file_name", "file_type", "version_num_value"]
    base = numbered(df, ["module_name"], [F.col(c).asc_nulls_first() for c in ("date", *tie)], keep, "at__")
    first = base.agg(F.min("at__").alias("first__"))
    base = base.where("module_name is not null").withColumn(PART, F.shiftright("at__", 33))
    inside = Window.partitionBy("module_name", PART).orderBy("at__")
    rows = base.withColumn("prev__", F.lag(F.struct("version_num_value")).over(inside))
    state = base.groupBy("module_name", PART).agg(F.max_by(F.struct("version_num_value"), "at__").alias("last__"))
    by_part = Window.partitionBy("module_name").orderBy(PART)  # one row per stretch
    carried = state.select("module_name", PART, F.lag("last__").over(by_part).alias("before__"))
    rows = rows.join(carried, ["module_name", PART]).join(first)
    prev = F.coalesce("prev__", "before__")["version_num_value"]
    ok = (
        (F.col("at__") > F.col("first__"))
        & (F.col("module_name") != "")
        & (F.dayofmonth("date") <= 28)
        & (F.col("file_type") != "xml")
    )
    low = F.lower("module_name")
    v = F.col("version_num_value")
    good = rows.where(ok).select(
        "module_name",
        F.floor((F.dayofmonth("date") - 1) / 7 + 1).cast("int").alias("week_num"),
        "at__",
        F.when(v > prev, 1).otherwise(0).alias("up"),
        F.when(v == prev, 1).otherwise(0).alias("stuck"),
        F.when(low.contains("release"), 1).otherwise(0).alias("rel"),
        F.when(low.contains("snapshot"), 1).otherwise(0).alias("snap"),
    )
    weeks = good.groupBy("module_name", "week_num").agg(
        # the opening row does not count as up or repeat
        (F.sum("up") - F.min_by("up", "at__")).alias("versioning_up_count"),
        (F.sum("stuck") - F.min_by("stuck", "at__")).alias("versioning_stuck_count"),
        F.sum("rel").alias("is_release"),
        F.sum("snap").alias("is_snapshot"),
        F.max("at__").alias("end__"),
    )
    # files seen by the week's last row: whole stretches before its own by their totals, and
    # the files that begin in its own up to it (a module has four weeks)
    debut = base.groupBy("module_name", "file_name").agg(F.min("at__").alias("at__")).withColumn(PART, F.shiftright("at__", 33))
    ends = weeks.select("module_name", "week_num", "end__", F.shiftright("end__", 33).alias(PART))
    begun = debut.groupBy("module_name", F.col(PART).alias("early__")).agg(F.count(F.lit(1)).alias("n"))
    before = ends.join(begun, "module_name").where(F.col("early__") < F.col(PART)).select("module_name", "week_num", "n")
    own = (
        ends.join(debut, ["module_name", PART])
        .where(F.col("at__") <= F.col("end__"))
        .groupBy("module_name", "week_num")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    files = before.unionByName(own).groupBy("module_name", "week_num").agg(F.sum("n").alias("files_per_module"))
    return weeks.drop("end__").join(files, ["module_name", "week_num"], "left").withColumn(
        "files_per_module", F.coalesce("files_per_module", F.lit(0))
    )


def module_averages(weekly: DataFrame) -> DataFrame:
    cols = {
        "versioning_up_avg": "versioning_up_count",
        "versioning_stuck_avg": "versioning_stuck_count",
        "is_release_avg": "is_release",
        "is_snapshot_avg": "is_snapshot",
        "files_per_module_avg": "files_per_module",
    }
    return weekly.groupBy("module_name").agg(*[F.avg(src).alias(dst) for dst, src in cols.items()])
