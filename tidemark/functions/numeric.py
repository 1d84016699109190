"""Guarded arithmetic as column expressions."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, functions as F


def safe_ratio(num: Column, den: Column, when_zero: float = 0.0) -> Column:
    """num/den, with a constant where the denominator is zero."""
    return F.when(den == 0, F.lit(when_zero)).otherwise(num.cast("double") / den)


def open_ratio(num: Column, den: Column) -> Column:
    """num/den without a guard in the source data: null where den is zero."""
    return F.try_divide(num.cast("double"), den)


def relative_step(prev: Column, cur: Column) -> Column:
    """(cur-prev)/prev with 0/0 -> 0, +inf -> 1, -inf kept; nulls give 0 as well."""
    p, c = prev.cast("double"), cur.cast("double")
    step = (
        F.when(p != 0, (c - p) / p)
        .when(c == p, F.lit(0.0))
        .when(c > p, F.lit(1.0))
        .otherwise(F.lit(float("-inf")))
    )
    return F.when(p.isNull() | c.isNull(), F.lit(0.0)).otherwise(step)


def mean_of(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) / F.lit(float(len(columns)))


def nonzero_count(columns: Sequence[Column]) -> Column:
    """How many of the columns differ from zero; a null differs."""
    flags = [F.when(c == 0, 0).otherwise(1) for c in columns]
    return reduce(lambda a, b: a + b, flags)


def row_sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])


def row_std(columns: Sequence[Column]) -> Column:
    """Population standard deviation across columns of one row, nulls skipped."""
    held = F.filter(F.array(*[c.cast("double") for c in columns]), lambda v: v.isNotNull())
    n = F.size(held)
    mean = F.aggregate(held, F.lit(0.0), lambda a, v: a + v) / n
    sq = F.aggregate(held, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
    return F.when(n > 0, F.sqrt(sq / n))


def argmax_name(names: Sequence[str], columns: Sequence[Column]) -> Column:
    """Name of the row maximum, the first one on ties, null if all are null."""
    top = F.greatest(*columns) if len(columns) > 1 else columns[0]
    out = F.when(columns[0] == top, F.lit(names[0]))
    for name, col in zip(names[1:], columns[1:]):
        out = out.when(col == top, F.lit(name))
    return out


def hash_fraction(*parts: Column) -> Column:
    """Repeatable stand-in for a uniform draw in [0,1): 32 bits of a SHA-1."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha1(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
