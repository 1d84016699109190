"""Connected components of a link table, by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import Scratch

PART = 1024


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, comp) for every id in `links` (a, b): comp is the smallest id reachable.

    Each round takes the smallest label among the neighbours, reduced before it moves, and
    then the label of that label, so chains halve; a written table ends each round. Ids and
    links stay in the executors; the driver sees how many labels changed. The links of a hub
    are dealt into parts of about `PART` and meet copies of its label.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("to")))
    edges = scratch.keep(both.where("id != to").distinct())
    hubs = scratch.keep(edges.groupBy("to").agg(F.ceil(F.count(F.lit(1)) / PART).alias("deals")).where("deals > 1"))
    dealt = scratch.keep(edges.join(hubs, "to", "left").select("id", "to", F.pmod(F.xxhash64("id"), F.coalesce("deals", F.lit(1))).alias("deal")))
    scratch.drop(edges)
    edges = dealt
    labels = scratch.keep(edges.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("comp")))
    while True:
        told = labels.withColumnRenamed("id", "to").join(hubs, "to", "left")
        told = told.select("to", "comp", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("deals", F.lit(1)) - 1)).alias("deal"))
        near = edges.join(told, ["to", "deal"]).groupBy("id").agg(F.min("comp").alias("m"))
        low = scratch.keep(labels.join(near, "id").select("id", F.least("comp", "m").alias("comp"), F.col("comp").alias("was")))
        up = low.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        new = scratch.keep(low.join(up, "comp", "left").select("id", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "was"))
        changed = new.agg(F.count_if(F.col("comp") != F.col("was")).alias("n")).first()["n"]
        scratch.drop(labels, low)
        labels = new
        if not changed:
            return labels.select("id", "comp")
