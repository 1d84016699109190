"""Point-in-time aggregation: facts of an account as seen from a reference date.

`pop` is a population with one row per (account_id, relevant_date); make it so
with `unique_population`. All operators return one row per such key that has at
least one matching fact (an inner join in SQL terms).

How the work is spread
----------------------
An account may hold a large share of all facts, so nothing here joins or sorts
on the account alone while raw facts are still around:

* facts are first reduced to one row per (account, day, ...), with map-side
  combining, so that what is left per account is bounded by the calendar;
* bounded look-backs are no joins: a fact is due on one day and leaves the window
  on another, whatever the reference dates are. Both are steps of +x and -x, summed
  by (account, day) before they move, and a running sum merged with the reference
  dates is the window's total. For distinct values the ranges of reference dates
  that the days of one value cover are united first. Extremes, which cannot be
  taken back, come from running extremes inside blocks of days (`windowed_extremes`);
* the two-level usage block joins on (account, month bucket): a population row is
  repeated for the few buckets its windows touch, a fact row never is. Facts travel once, by
  (account, month), and are folded where they meet the dates; folds travel once, by (account, date);
* unbounded look-backs are running sums over those daily rows merged with the
  reference days: linear in both inputs instead of a join of every reference
  date with the whole past.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import day_due, day_floor, month_number

KEY = "account_id"
REF = "relevant_date"


def unique_population(pop: DataFrame, key: str = KEY, ref: str = REF, label: str | None = None) -> DataFrame:
    """One row per (key, ref); a label, if named, is kept as its maximum."""
    if label is None:
        return pop.select(key, ref).distinct()
    return pop.groupBy(key, ref).agg(F.max(label).alias(label))


@dataclass(frozen=True)
class Back:
    """Look-back window ending on the reference date (inclusive on both edges).

    months: whole months back, from the reference day or, with `from_month_start`,
    from the first of its month. days: days back. `boundary_months` keeps facts
    whose count of month boundaries to the reference date is at most that number.
    """

    months: int | None = None
    days: int | None = None
    from_month_start: bool = False
    boundary_months: int | None = None

    def lower(self, ref: Column) -> Column:
        if self.days is not None:
            return F.date_sub(ref, self.days)
        if self.boundary_months is not None:
            return F.add_months(F.trunc(ref, "month"), -self.boundary_months)
        return F.add_months(F.trunc(ref, "month") if self.from_month_start else ref, -self.months)

    def last_reference(self, day: Column) -> Column:
        """The latest reference date whose window still holds the day."""
        if self.days is not None:
            return F.date_add(day, self.days)
        if self.boundary_months is not None or self.from_month_start:
            months = self.months if self.boundary_months is None else self.boundary_months
            return F.last_day(F.add_months(F.trunc(day, "month"), months))
        ahead = F.add_months(day, self.months)
        # the last day of a month stands for all later days of longer months
        return F.when(day == F.last_day(day), F.last_day(ahead)).otherwise(ahead)

    def shortest(self) -> int:
        """The least number of days that the window can have."""
        if self.days is not None:
            return self.days + 1
        return 28 * (self.months if self.boundary_months is None else self.boundary_months) + 1


@dataclass(frozen=True)
class Measure:
    """One output column. `where` limits the rows; `late` is a shorter window than the operator's."""

    kind: str
    expr: Column | None = None
    where: Column | None = None
    late: Back | None = None

    def input(self) -> Column:
        value = F.lit(1) if self.expr is None else self.expr
        return value if self.where is None else F.when(self.where, value)


def count(where: Column | None = None) -> Measure:
    return Measure("count", None, where)


def total(expr: Column, where: Column | None = None) -> Measure:
    return Measure("sum", expr, where)


def mean(expr: Column, where: Column | None = None) -> Measure:
    return Measure("mean", expr, where)


def largest(expr: Column, where: Column | None = None) -> Measure:
    return Measure("max", expr, where)


def smallest(expr: Column, where: Column | None = None) -> Measure:
    return Measure("min", expr, where)


def distinct(where: Column | None = None, late: Back | None = None) -> Measure:
    """Number of distinct values of the operator's `distinct_of` expression."""
    return Measure("distinct", None, where, late)


_FOLD = {"sum": F.sum, "max": F.max, "min": F.min}


def _partial(name: str, m: Measure) -> list[Column]:
    if m.kind == "count":
        return [F.count(m.input()).alias(f"{name}__s")]
    if m.kind == "mean":
        return [F.sum(m.input()).alias(f"{name}__s"), F.count(m.input()).alias(f"{name}__n")]
    if m.kind == "distinct":
        return [F.max(F.when(m.where, True) if m.where is not None else F.lit(True)).alias(f"{name}__f")]
    return [_FOLD[m.kind](m.input()).alias(f"{name}__s")]


def _final(name: str, m: Measure) -> Column:
    if m.kind == "count":
        return F.sum(f"{name}__s").alias(name)
    if m.kind == "mean":
        n = F.sum(f"{name}__n")
        return F.when(n > 0, F.sum(f"{name}__s") / n).alias(name)
    if m.kind == "distinct":
        return F.count(F.when(F.col(f"{name}__f"), 1)).alias(name)
    return _FOLD[m.kind](f"{name}__s").alias(name)


def _merge(name: str, m: Measure) -> list[Column]:
    """Partial results of partial results, under the same names."""
    if m.kind == "distinct":
        return [F.max(f"{name}__f").alias(f"{name}__f")]
    if m.kind == "mean":
        return [F.sum(f"{name}__s").alias(f"{name}__s"), F.sum(f"{name}__n").alias(f"{name}__n")]
    return [(F.sum if m.kind == "count" else _FOLD[m.kind])(f"{name}__s").alias(f"{name}__s")]


def with_buckets(pop: DataFrame, lower: Column, upper: Column, width: int, name: str = "bucket__") -> DataFrame:
    """Repeat each row for every `width`-month bucket between two dates."""
    first = F.floor(month_number(lower) / width).cast("int")
    last = F.floor(month_number(upper) / width).cast("int")
    return pop.withColumn(name, F.explode(F.sequence(first, last)))


def asof_aggregate(
    pop: DataFrame,
    fact: DataFrame,
    ts: str,
    measures: Mapping[str, Measure],
    back: Back,
    distinct_of: Column | None = None,
    key: str = KEY,
    ref: str = REF,
) -> DataFrame:
    """Aggregate facts with `lower(ref) <= ts <= ref` per (key, ref), without a join of dates and facts.

    Distinct counts of several conditions share `distinct_of`. Null values are rows
    but no distinct values. Totals of fractions are differences of running totals, exact up to
    rounding of the account's whole sum.
    """
    rows = fact.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rows = rows.withColumns({"first__": day_floor(F.col(ts)), "due__": day_due(F.col(ts))})
    extremes = {n: m for n, m in measures.items() if m.kind in ("max", "min")}
    stepped = {n: m for n, m in measures.items() if n not in extremes}
    if not stepped:
        return windowed_extremes(pop, rows, extremes, back, key, ref)
    out = windowed_totals(pop, rows, stepped, back, distinct_of, key, ref)
    if extremes:
        out = out.join(windowed_extremes(pop, rows, extremes, back, key, ref), [key, ref])
    return out.select(key, ref, *measures)


def windowed_totals(
    pop: DataFrame, rows: DataFrame, measures: Mapping[str, Measure], back: Back, distinct_of: Column | None, key: str, ref: str
) -> DataFrame:
    """Counts, sums, means and distinct counts of rows (first__, due__) by steps in and out of the window."""
    leaves = F.date_add(back.last_reference(F.col("first__")), 1)
    plain = {n: m for n, m in measures.items() if m.kind != "distinct"}
    uniq = {n: m for n, m in measures.items() if m.kind == "distinct"}

    # a row enters on one day and leaves on another; steps of a day are summed before they move
    inputs = {n: m.input() for n, m in plain.items()}
    if uniq:
        # rows of a value's day are one row from here on, those without a value too
        flags = [F.max(m.where if m.where is not None else F.lit(True)).alias(f"{n}__f") for n, m in uniq.items()]
        sums = [F.count(F.lit(1)).alias("rows__")]
        for n, x in inputs.items():
            sums += [F.count(x).alias(f"{n}__n")] + ([F.sum(x).alias(f"{n}__s")] if plain[n].kind != "count" else [])
        days = rows.withColumn("value__", distinct_of).groupBy(key, "value__", "first__", "due__").agg(*flags, *sums)
        before = Window.partitionBy(key, "value__").orderBy("first__", "due__").rowsBetween(Window.unboundedPreceding, -1)
        starts, ends = [], []
        for n, m in uniq.items():
            end = F.date_add((m.late or back).last_reference(F.col("first__")), 1)
            end = F.least(end, leaves) if m.late else end
            flag = F.col("value__").isNotNull() & F.col(f"{n}__f")
            covered = F.max(F.when(flag, end)).over(before)
            starts.append(F.greatest("due__", covered).alias(f"{n}__in"))
            ends += [end.alias(f"{n}__out"), flag.alias(f"{n}__f")]
        carried = [c for c in days.columns if c == "rows__" or c.removesuffix("__n").removesuffix("__s") in plain]
        spans = days.select(key, *carried, F.col("due__").alias("all____in"), leaves.alias("all____out"), F.lit(True).alias("all____f"), *starts, *ends)
        kinds = [(n, at, sign) for n in ("all__", *uniq) for at, sign in (("in", 1), ("out", -1))]
        runs = lambda n: F.col(f"{n}__f") & (F.col(f"{n}__in") < F.col(f"{n}__out"))
        moves = [F.struct(F.when(runs(n), F.col(f"{n}__{at}")).alias("at__"), F.lit(i).alias("move__")) for i, (n, at, _) in enumerate(kinds)]
        moved = spans.select(key, *carried, F.explode(F.array(*moves)).alias("m__")).select(key, *carried, "m__.*").where("at__ is not null")
        move = lambda n: F.when(F.col("move__") == kinds.index((n, "in", 1)), 1).when(F.col("move__") == kinds.index((n, "out", -1)), -1)
        steps = moved.groupBy(key, "at__").agg(*[F.sum(F.col(c) * move("all__")).alias(c) for c in carried], *[F.sum(move(n)).alias(f"{n}__n") for n in uniq])
    else:
        both = F.array(F.struct(F.col("due__").alias("at__"), F.lit(1).alias("sign__")), F.struct(leaves.alias("at__"), F.lit(-1).alias("sign__")))
        each = rows.where(F.col("due__") < leaves).select(key, F.explode(both).alias("s__"), *[x.alias(f"{n}__x") for n, x in inputs.items()])
        each = each.select(key, "s__.*", *[f"{n}__x" for n in plain])
        sign = F.col("sign__")
        sums = [F.sum(sign).alias("rows__")]
        for n, m in plain.items():
            x = F.col(f"{n}__x")
            sums.append(F.sum(F.when(x.isNotNull(), sign).otherwise(0)).alias(f"{n}__n"))
            if m.kind != "count":
                sums.append(F.sum(x * sign).alias(f"{n}__s"))
        steps = each.groupBy(key, "at__").agg(*sums)

    # at most a row per day and source for each key: bounded by the calendar
    marks = pop.select(key, F.col(ref).alias("at__"), F.lit(1).alias("asked__"))
    past = Window.partitionBy(key).orderBy("at__", F.coalesce("asked__", F.lit(0))).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = lambda c: F.coalesce(F.sum(c).over(past), F.lit(0))
    outs = [held("rows__").alias("rows__")]
    for n, m in measures.items():
        there = held(f"{n}__n")
        if m.kind in ("count", "distinct"):
            outs.append(there.alias(n))
        else:
            value = F.sum(f"{n}__s").over(past)
            outs.append(F.when(there > 0, value / there if m.kind == "mean" else value).alias(n))
    line = steps.unionByName(marks, allowMissingColumns=True).select(key, F.col("at__").alias(ref), "asked__", *outs)
    return line.where("asked__ = 1 and rows__ > 0").drop("asked__", "rows__")


def windowed_extremes(pop: DataFrame, rows: DataFrame, measures: Mapping[str, Measure], back: Back, key: str, ref: str) -> DataFrame:
    """Largest and smallest values of rows (first__, due__) inside the window, by blocks of days.

    Blocks are as long as the shortest window, so a window is the end of one block, whole
    blocks, and the beginning of another: look-ups of running extremes inside blocks, taken from both
    sides. A key's days are cut by block; no date is joined with days.
    """
    # two places a day: a moment after midnight is due on the day after it
    wide = 2 * back.shortest()
    place = (2 * F.unix_date("first__") + F.when(F.col("due__") > F.col("first__"), 1).otherwise(0)).alias("place__")
    folds = {"seen__": F.max, **{n: _FOLD[m.kind] for n, m in measures.items()}}
    points = rows.groupBy(key, place).agg(F.lit(1).alias("seen__"), *[folds[n](m.input()).alias(n) for n, m in measures.items()])
    points = points.withColumn("block__", F.floor(F.col("place__") / wide))

    low, high = 2 * F.unix_date(back.lower(F.col(ref))), 2 * F.unix_date(F.col(ref))
    asked = pop.select(key, ref, low.alias("low__"), high.alias("high__"))
    asked = asked.withColumns({"b0__": F.floor(F.col("low__") / wide), "b1__": F.floor(F.col("high__") / wide)})
    mark = lambda block, at, upto: F.struct(block.cast("long").alias("block__"), at.cast("int").alias("place__"), F.lit(upto).alias("upto__"))
    one, two = F.col("b0__"), F.col("b1__")
    inner = F.when(two - one > 1, F.transform(F.sequence(one + 1, F.greatest(two - 1, one + 1)), lambda b: mark(b, (b + 1) * wide - 1, True)))
    every = F.concat(
        F.array(mark(two, F.col("high__"), True)),
        F.when(one < two, F.array(mark(one, F.col("low__"), False))).otherwise(F.array().cast("array<struct<block__:bigint,place__:int,upto__:boolean>>")),
        F.coalesce(inner, F.array().cast("array<struct<block__:bigint,place__:int,upto__:boolean>>")),
    )
    marks = asked.select(key, ref, F.explode(every).alias("m__")).select(key, ref, "m__.*")
    line = points.unionByName(marks, allowMissingColumns=True)
    last = F.coalesce(F.col("upto__").isNotNull(), F.lit(False))  # points before marks at the same place
    up = Window.partitionBy(key, "block__").orderBy("place__", last).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(key, "block__").orderBy(F.desc("place__"), last).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = line.select(key, ref, "upto__", *[F.when(F.col("upto__"), f(n).over(up)).otherwise(f(n).over(down)).alias(n) for n, f in folds.items()])
    out = found.where("upto__ is not null").groupBy(key, ref).agg(*[f(n).alias(n) for n, f in folds.items()])
    return out.where("seen__ = 1").select(key, ref, *measures)


def asof_running(
    pop: DataFrame,
    fact: DataFrame,
    ts: Column,
    measures: Mapping[str, Measure],
    distinct_of: Column | None = None,
    key: str = KEY,
    ref: str = REF,
) -> DataFrame:
    """Aggregate ALL facts with `ts <= ref` per (key, ref), without a range join.

    Supports count, sum, max, min and distinct (no `late`). Facts become one row
    per (key, day); a distinct value is counted on the day it is first due.
    """
    rows = fact.where(F.col(key).isNotNull() & ts.isNotNull()).withColumn("due__", day_due(ts))
    plain = {n: m for n, m in measures.items() if m.kind != "distinct"}
    uniq = {n: m for n, m in measures.items() if m.kind == "distinct"}
    daily = rows.groupBy(key, "due__").agg(
        F.lit(1).alias("seen__"), *[p for n, m in plain.items() for p in _partial(n, m)]
    )
    if uniq:
        firsts = (
            rows.withColumn("value__", distinct_of)
            .where(F.col("value__").isNotNull())
            .groupBy(key, "value__")
            .agg(*[F.min(F.when(m.where, F.col("due__")) if m.where is not None else F.col("due__")).alias(n) for n, m in uniq.items()])
        )
        steps = firsts.select(
            key,
            F.explode(
                F.array(
                    *[
                        F.struct(F.col(n).alias("due__"), *[F.lit(int(n == o)).alias(f"{o}__s") for o in uniq])
                        for n in uniq
                    ]
                )
            ).alias("s"),
        ).select(key, "s.*").where("due__ is not null")
        gains = steps.groupBy(key, "due__").agg(*[F.sum(f"{n}__s").alias(f"{n}__s") for n in uniq])
        daily = daily.unionByName(gains, allowMissingColumns=True)
    marks = pop.select(key, F.col(ref).alias("due__"), F.lit(1).alias("asked__"))
    line = daily.unionByName(marks, allowMissingColumns=True)
    # at most one row per day and source for each key: bounded by the calendar
    past = (
        Window.partitionBy(key)
        .orderBy("due__", F.coalesce("asked__", F.lit(0)))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    outs = [F.max("seen__").over(past).alias("seen__")]
    for n, m in measures.items():
        fold = F.sum if m.kind in ("count", "sum", "distinct") else _FOLD[m.kind]
        value = fold(f"{n}__s").over(past)
        outs.append((F.coalesce(value, F.lit(0)) if m.kind in ("count", "distinct") else value).alias(n))
    return (
        line.select(key, F.col("due__").alias(ref), "asked__", *outs)
        .where("asked__ = 1 and seen__ = 1")
        .drop("asked__", "seen__")
    )


def asof_latest(
    pop: DataFrame,
    series: DataFrame,
    day: str,
    cols: Sequence[str],
    key: str = KEY,
    ref: str = REF,
) -> DataFrame:
    """Columns of the series row at the greatest `day <= ref` (one row per key and day)."""
    packed = series.select(key, F.col(day).alias("due__"), F.struct(day, *cols).alias("row__"))
    marks = pop.select(key, F.col(ref).alias("due__"), F.lit(1).alias("asked__"))
    past = (
        Window.partitionBy(key)
        .orderBy("due__", F.coalesce("asked__", F.lit(0)))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        packed.unionByName(marks, allowMissingColumns=True)
        .withColumn("row__", F.last("row__", ignorenulls=True).over(past))
        .where("asked__ = 1 and row__ is not null")
        .select(key, F.col("due__").alias(ref), *[F.col(f"row__.{c}").alias(c) for c in [day, *cols]])
    )


@dataclass(frozen=True)
class Period:
    """Month window [ref-lo, ref-hi], or around a fixed day when `anchor` is given."""

    label: str
    lo: int
    hi: int
    anchor: str | None = None

    def edges(self, ref: Column) -> tuple[Column, Column]:
        base = ref if self.anchor is None else F.lit(self.anchor).cast("date")
        return F.add_months(base, -self.lo), F.add_months(base, -self.hi)


# fixed values: the five windows, in the order in which shared edges are resolved
FIVE_PERIODS = (
    Period("m0", 1, 0),
    Period("q1", 4, 3),
    Period("q2", 7, 6),
    Period("m1", 2, 1),
    Period("m2", 3, 2),
)


def four_periods(as_of: str) -> tuple[Period, ...]:
    """Three trailing months and a window that ends on `as_of` itself."""
    return (Period("m0", 1, 0), Period("m1", 2, 1), Period("m2", 3, 2), Period("current", 1, 0, as_of))


def period_bucket(day: Column, ref: Column, periods: Sequence[Period] = FIVE_PERIODS) -> Column:
    """Label of the first window that holds the day; null outside all of them."""
    out = None
    for p in periods:
        lo, hi = p.edges(ref)
        hit = day.between(lo, hi)
        out = F.when(hit, F.lit(p.label)) if out is None else out.when(hit, F.lit(p.label))
    return out


def usage_block(
    pop: DataFrame,
    snaps: DataFrame,
    env: str,
    ts: str,
    inner: Mapping[str, Measure],
    periods: Sequence[Period] = FIVE_PERIODS,
    outer: Mapping[str, str] | None = None,
    n_env: str | None = None,
    key: str = KEY,
    ref: str = REF,
) -> DataFrame:
    """Two-level usage: fold each environment within a period, then fold environments.

    `inner` measures are mean, sum, count, max or min per (environment, period);
    `outer` maps a column to sum (default) or max. One row per (key, ref, period).
    """
    outer = outer or {}
    day = day_floor(F.col(ts))
    parts = [p for n, m in inner.items() for p in _partial(n, m)]
    # moved once, to the tasks where they meet the dates: no grouping below moves them again
    daily = (
        snaps.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .withColumn("day__", day)
        .withColumn("bucket__", month_number(F.col("day__")))
        .repartition(key, "bucket__")
        .groupBy(key, "bucket__", env, "day__")
        .agg(*parts)
    )
    # only months that some window touches
    months = [F.sequence(month_number(lo), month_number(hi)) for lo, hi in (p.edges(F.col(ref)) for p in periods)]
    wanted = pop.select(key, ref).withColumn(
        "bucket__", F.explode(F.array_distinct(reduce(lambda a, b: F.concat(a, b), months)))
    )
    per_env = (
        wanted.join(daily, [key, "bucket__"])
        .withColumn("period", period_bucket(F.col("day__"), F.col(ref), periods))
        .where("period is not null")
        .groupBy(key, "bucket__", ref, "period", env)
        .agg(*[c for n, m in inner.items() for c in _merge(n, m)])
        .repartition(key, ref)
        .groupBy(key, ref, "period", env)
        .agg(*[_final(n, m) for n, m in inner.items()])
    )
    aggs = [(F.max if outer.get(n) == "max" else F.sum)(n).alias(n) for n in inner]
    if n_env:
        aggs.append(F.count(F.lit(1)).alias(n_env))
    return per_env.groupBy(key, ref, "period").agg(*aggs)


def widen_periods(
    block: DataFrame,
    cols: Sequence[str],
    periods: Sequence[Period] = FIVE_PERIODS,
    flag: str | None = None,
    key: str = KEY,
    ref: str = REF,
) -> DataFrame:
    """One row per (key, ref), columns `<col>` for the first window and `<col>__<label>`
    for the others: the five period-filtered self-joins as a single grouping.

    Each period's columns travel as one struct (a key has one row per period, so max
    just picks it): five aggregates instead of periods x columns, whose generated
    code would be too large to be compiled. The sort-based result is already
    ordered by (key, ref) for the joins that follow.
    """
    packed = F.struct(*cols)
    picks = [F.max(F.when(F.col("period") == p.label, packed)).alias(f"p{i}__") for i, p in enumerate(periods)]
    out = [
        F.col(f"p{i}__.{c}").alias(c if i == 0 else f"{c}__{p.label}") for i, p in enumerate(periods) for c in cols
    ]
    if flag:
        picks.append(F.count(F.when(F.col("period").isin([p.label for p in periods]), 1)).alias(flag))
        out.append(F.col(flag))
    return block.groupBy(key, ref).agg(*picks).select(key, ref, *out)


def over_time(
    pop: DataFrame, snaps: DataFrame, ts: str, measures: Sequence[str], key: str = KEY, ref: str = REF
) -> DataFrame:
    """Daily sums over environments for every snapshot day up to the reference date.

    Every (population row, earlier snapshot day) pair IS the result here, so the
    output is large by definition; the days-since-change operator does not use it.
    """
    daily = daily_sums(snaps, ts, measures, key)
    return pop.select(key, ref, *[c for c in pop.columns if c == "class"]).join(daily, key).where(
        F.col("snapshot_date") <= F.col(ref)
    )


def daily_sums(snaps: DataFrame, ts: str, measures: Sequence[str], key: str = KEY) -> DataFrame:
    return (
        snaps.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(key, day_floor(F.col(ts)).alias("snapshot_date"))
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def days_since_change(
    pop: DataFrame,
    snaps: DataFrame,
    ts: str,
    measures: Sequence[str],
    prefix: str = "days_from_",
    key: str = KEY,
    ref: str = REF,
    digits: int | None = None,
) -> DataFrame:
    """Days from the last snapshot whose value differs from the latest one.

    All measures in one pass over the daily series. Null where a measure never
    changed (or is null in the latest snapshot); rows where no measure changed are
    left out. A null value never counts as different. `digits` rounds the daily
    sums first, so that equal totals added in another order stay equal.
    """
    series = daily_sums(snaps, ts, measures, key)
    if digits is not None:
        series = series.select(key, "snapshot_date", *[F.round(m, digits).alias(m) for m in measures])
    by_day = Window.partitionBy(key).orderBy("snapshot_date")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # previous non-null value and its day, per measure (bounded by days per key)
    series = series.select(
        "*",
        *[
            F.last(F.when(F.col(m).isNotNull(), F.struct(F.col(m).alias("v"), F.col("snapshot_date").alias("d"))), True)
            .over(before)
            .alias(f"{m}__p")
            for m in measures
        ],
    )
    series = series.select(
        key,
        "snapshot_date",
        *[
            F.when(
                F.col(m).isNotNull(),
                F.last(F.when(F.col(m) != F.col(f"{m}__p.v"), F.col(f"{m}__p.d")), True).over(upto),
            ).alias(m)
            for m in measures
        ],
    )
    hits = asof_latest(pop, series, "snapshot_date", list(measures), key, ref)
    out = hits.select(
        key, ref, *[F.datediff(F.col(ref), F.col(m)).alias(f"{prefix}{m}_change") for m in measures]
    )
    return out.where(reduce(lambda a, b: a | b, [F.col(f"{prefix}{m}_change").isNotNull() for m in measures]))
