"""Mixing sources to target weights by capped water-filling.

Weights share out a total; a source that would be seen more often than `max_epochs` times
is clamped there and the excess goes to the others in proportion to their weights, round
by round, until none is above its clamp. Each source's target is then met by whole
repetitions of all its documents plus one more of a seeded part of them: documents are
put in a hash order and taken up to the point nearest to the target, so a source misses
its target by half a document at most.

Defined cases: a null source is a source like others (ordered last); null texts have size
0 and get the whole repetitions of their source; rows with equal key columns are neighbours
in the order; a source of size 0 has target 0; an empty table gives an empty mix.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import Scratch, aside, free_name, offsets

RESULTS = ("size", "source_size", "target", "repeats")
CELLS = 4096


def water_fill(sources: DataFrame, max_epochs: float, total: float | None = None) -> DataFrame:
    """Add `target` to a table with `size` (words of a source) and `weight`, one row per source.

    Each round is one aggregation that returns two numbers; clamps only ever get more.
    """
    cap = F.col("size") * F.lit(float(max_epochs))
    if total is None:
        total = sources.agg(F.sum("size").alias("t")).first()["t"] or 0
    level, clamped = 0.0, None
    while True:
        over = cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(over, cap)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("open"), F.count_if(over).alias("n")
        ).first()
        if row["n"] == clamped or not row["open"]:
            break
        clamped, level = row["n"], max(level, (float(total) - float(row["full"] or 0)) / float(row["open"]))
    if not row["open"]:
        return sources.withColumn("target", cap)
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def cyclic_weights(sources: DataFrame, by: str, weights: Sequence[float]) -> DataFrame:
    """Add `weight`: the given ones in turn to the sources in code-point order, null last.

    Ranks come from a count of the sources before: the sources are range-partitioned,
    ranked inside partitions, and shifted by the partitions' counts.
    """
    scratch = Scratch(sources.sparkSession)
    order = [F.asc_nulls_last(by)]
    cut = scratch.keep(sources.repartitionByRange(*order).withColumn("part__", F.spark_partition_id().cast("long")))
    before = offsets(cut.groupBy("part__").agg(F.count(F.lit(1)).alias("n__")), "part__", ["n__"]).select("part__", "n____before")
    inside = F.row_number().over(Window.partitionBy("part__").orderBy(*order)) - 1
    rank = (F.col("n____before") + inside).cast("int")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return cut.join(before, "part__").withColumn("weight", F.get(turn, F.pmod(rank, F.lit(len(weights))))).drop("part__", "n____before")


def mix(docs: DataFrame, sources: DataFrame, size: Column, by: str = "source", key: Sequence[str] = ("doc_id",), seed: int = 0) -> DataFrame:
    """The rows of `docs` with `size` (long), `source_size`, `target` and `repeats` (int).

    `sources` has `by`, `size` and `target`. The order inside a source is a seeded hash of
    `key` and the size. Sums over 4,096 ranges of that hash say in which range each source's
    cut lies; only documents of that one range are put in order.
    """
    docs = aside(docs.withColumn("words__", size.cast("long")), RESULTS)
    scratch = Scratch(docs.sparkSession)
    spot, cell = free_name(docs.columns, "spot__"), free_name(docs.columns, "cell__")
    hashed = docs.withColumnRenamed("words__", "size").withColumn(spot, F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in key], "size"))
    hashed = hashed.withColumn(cell, F.pmod(F.shiftrightunsigned(F.col(spot), 20), F.lit(CELLS)).cast("long"))
    goal = sources.select(
        F.col(by).alias("by__"),
        F.col("size").alias("source_size"),
        "target",
        F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size") + 1e-12)).otherwise(0).alias("whole__"),
    ).withColumn("need__", F.col("target") - F.col("whole__") * F.col("source_size"))
    sums = hashed.groupBy(F.col(by).alias("of__"), F.col(cell).alias("cell__")).agg(F.sum("size").alias("n__"))
    earlier = Window.partitionBy("of__").orderBy("cell__").rowsBetween(Window.unboundedPreceding, -1)  # CELLS rows a source
    cells = sums.withColumn("before__", F.coalesce(F.sum("n__").over(earlier), F.lit(0)))
    passed = cells.join(goal, F.col("of__").eqNullSafe(F.col("by__"))).where("need__ > 0 AND before__ + n__ > need__")
    cut = passed.groupBy("of__").agg(F.min("cell__").alias("cut__"), F.min_by("before__", "cell__").alias("from__"))
    goal = goal.join(cut, F.col("of__").eqNullSafe(F.col("by__")), "left").drop("of__").fillna({"cut__": -1, "from__": 0})
    rows = hashed.join(scratch.keep(goal), F.col(f"`{by}`").eqNullSafe(F.col("by__")))
    # ranges before the cut are taken whole, later ones not at all; one range per source is ordered
    place = Window.partitionBy("by__").orderBy(spot).rowsBetween(Window.unboundedPreceding, -1)
    out = [*[F.col(f"`{c}`") for c in docs.columns if c != "words__"], "size", "source_size", "target"]
    more = (F.col(cell) < F.col("cut__")).cast("int")
    plain = rows.where(F.col(cell) != F.col("cut__")).select(*out, (F.col("whole__") + more).cast("int").alias("repeats"))
    at = F.col("from__") + F.coalesce(F.sum("size").over(place), F.lit(0))
    ordered = rows.where(F.col(cell) == F.col("cut__")).withColumn("at__", at)
    more = (F.col("at__") + F.col("size") / 2 <= F.col("need__")).cast("int")
    return plain.unionByName(ordered.select(*out, (F.col("whole__") + more).cast("int").alias("repeats")))


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as `repeats` says, without the mixing columns."""
    n = free_name(mixed.columns, "copy__")
    out = mixed.where(F.col("repeats") > 0).withColumn(n, F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    return out.drop(n, "size", "source_size", "target", "repeats")
