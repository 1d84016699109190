"""Order statistics without a global sort in one task.

A running total over all rows of a frame would put them in a single partition. Here rows are
reduced to one per distinct value and sorted by sampling: a range partitioning by (group, value)
gives every task a stretch of about equal size, whether that is many small groups or part of a
large one. The stretches are written once; their totals (a row per group and stretch) are
scanned for the offset of each, and the exact running sum happens inside. There is one way for every
size, and rows whose group is null are a group.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

PART = "stretch__"


def same(cols: Sequence[str], left: str, right: str) -> Column:
    """Equality of columns of two aliased frames, null equal to null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in cols])


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the further columns of their group; a null is a group like others."""
    if not by:
        return rows.join(groups, how="inner")  # one row
    more = [c for c in groups.columns if c not in by]
    return rows.alias("r__").join(groups.alias("g__"), same(by, "r__", "g__")).select("r__.*", *[F.col(f"g__.`{c}`") for c in more])


def stretches(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows range-partitioned by group and order, written, with the number of their stretch.

    Numbers rise with the order. They must not be computed twice (partitions may be joined
    differently), which is why the rows are written.
    """
    lead = [F.col(f"`{c}`").asc_nulls_first() for c in by]
    return cut_lineage(df.repartitionByRange(*lead, *order).withColumn(PART, F.spark_partition_id()))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column], keep: Sequence[str], name: str) -> DataFrame:
    """Columns `keep` of the rows, written in the order of their stretches, with a number that rises with
    (by, order): the stretch in the bits from 33 on, the row inside it below."""
    lead = [F.col(f"`{c}`").asc_nulls_first() for c in by]
    rows = df.repartitionByRange(*lead, *order).sortWithinPartitions(*lead, *order)
    return cut_lineage(rows.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias(name)))


def offsets(placed: DataFrame, by: Sequence[str], sums: Mapping[str, Column], descending: bool = False) -> DataFrame:
    """Per group and stretch the sums over all stretches before it (a row per group and stretch)."""
    lead = F.desc(PART) if descending else F.asc(PART)
    earlier = Window.partitionBy(*[F.col(f"`{c}`") for c in by]).orderBy(lead).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*[F.col(f"`{c}`") for c in by], PART).agg(*[c.alias(f"{n}__t") for n, c in sums.items()])
    return totals.select(*[F.col(f"`{c}`") for c in by], PART, *[F.coalesce(F.sum(f"{n}__t").over(earlier), F.lit(0)).alias(f"{n}__o") for n in sums])


def running_totals(df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], descending: bool = False) -> DataFrame:
    """Add `<c>__cum` for each c in `sums`: the total up to and including the row. One row per (by, order)."""
    placed = stretches(df, by, [F.col(f"`{order}`").asc_nulls_first()])
    before = offsets(placed, by, {c: F.sum(c) for c in sums}, descending)
    row = F.desc(order) if descending else F.asc(order)
    within = Window.partitionBy(*[F.col(f"`{c}`") for c in by], PART).orderBy(row).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = join_groups(placed, before, [*by, PART])
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[(F.sum(c).over(within) + F.col(f"{c}__o")).alias(f"{c}__cum") for c in sums])


def ranks(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add `name`: the row's place in its group by a total order, from 0."""
    placed = stretches(df, by, order)
    before = offsets(placed, by, {"n": F.count(F.lit(1))})
    within = Window.partitionBy(*[F.col(f"`{c}`") for c in by], PART).orderBy(*order)
    out = join_groups(placed.withColumn("at__", F.row_number().over(within)), before, [*by, PART])
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("at__") - 1 + F.col("n__o")).alias(name))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, qs: Mapping[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per group, plus the count `n`; null values are skipped, null groups are not."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(counts, by, value, ["n"])
    src = join_groups(cum, cum.groupBy(*by).agg(F.max("n__cum").alias("total__")), by)

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("n__cum") > rank, F.col(value)))

    picks, outs = [], []
    for name, q in qs.items():
        pos = (F.col("total__") - 1) * F.lit(float(q))
        picks += [at(F.floor(pos)).alias(f"{name}__lo"), at(F.ceil(pos)).alias(f"{name}__hi"), F.max(pos - F.floor(pos)).alias(f"{name}__f")]
        lo, hi, f = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__f")
        outs.append((lo + (hi - lo) * f).alias(name))
    res = src.groupBy(*by).agg(F.max("total__").alias("n"), *picks)
    return res.select(*by, *outs, "n")
