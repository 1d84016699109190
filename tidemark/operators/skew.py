"""Joining many facts of one key with that key's few rows."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

HOT = "hot__"
SALT = "salt__"
# a key of fewer rows than this never needs cutting
LEAST = 10_000
# the summary of frequent items holds at most 1 / support entries
FINEST = 2e-4


def hot_keys(facts: DataFrame, keys: Sequence[str], least: int = LEAST) -> dict[int, int]:
    """Hashes of the keys that hold more than half a shuffle partition's share of all rows, with the
    number of parts that each should be cut into, by its counted size.

    A mergeable summary of frequent items, of bounded size, is taken in one pass and names
    every such key; its few candidates are then counted exactly. Neither moves rows. Two keys of
    one hash would both be cut, which changes no result.
    """
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    support = max(1 / (2 * parts), FINEST)
    hashes = facts.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias(HOT))
    seen = hashes.stat.freqItems([HOT], support).first()[0] or []
    candidates = F.when(F.col(HOT).isin(seen), F.col(HOT)) if seen else F.lit(None).cast("long")
    counts = {r["h"]: r["n"] for r in hashes.groupBy(candidates.alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = max(sum(counts.values()) * support, least)
    return {h: math.ceil(n / share) for h, n in counts.items() if h is not None and n > share}


def spread_join(
    facts: DataFrame, few: DataFrame, keys: str | Sequence[str], by: str | Sequence[str], how: str = "left", hot: dict[int, int] | None = None
) -> DataFrame:
    """Join facts with a table of few rows per key ("left" or "inner"), cutting each hot key.

    Adaptive skew handling steps back when an aggregation on the same key follows the
    join, as it would need another shuffle. Here the rows of a hot key get a salt, taken from the
    content of the columns `by` (so a retried task gives the same parts; rows equal in all of them
    stay together), and that key's rows of the other table are repeated once per salt. All
    other keys are joined as they are. `hot` may come from `hot_keys` of an earlier form of the facts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = [by] if isinstance(by, str) else list(by)
    hot = hot_keys(facts, keys) if hot is None else hot
    if not hot:
        return facts.join(few, keys, how)
    sizes = F.create_map(*[F.lit(v) for pair in hot.items() for v in pair])  # at most 1 / support entries
    cuts = F.coalesce(F.try_element_at(sizes, F.xxhash64(*[F.col(f"`{k}`") for k in keys])), F.lit(1))
    salted = facts.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), cuts).cast("int"))
    copies = few.withColumn(SALT, F.explode(F.sequence(F.lit(0), cuts - 1)))
    return salted.join(copies, [*keys, SALT], how).drop(SALT)
