"""Hand-over tables and small distributed helpers shared by the corpus operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import drop_folder, scratch_dir


class Scratch:
    """Tables written during one operator call, under the shared checkpoint folder.

    Written tables cut lineage: a lost executor re-reads files and recomputes nothing
    before them. `drop` removes a table once nothing reads it any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, scratch_dir(spark), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        at = f"{self.root}/{self.n}"
        df.write.option("compression", "zstd").parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out.kept_at = at
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            drop_folder(self.spark, t.kept_at)


def free_name(taken: Sequence[str], name: str) -> str:
    """`name`, with underscores until no column is called so (whatever the case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def aside(docs: DataFrame, results: Sequence[str]) -> DataFrame:
    """Input columns called like a result (whatever the case) move to `<name>__in`."""
    low = {r.lower() for r in results}
    return docs.withColumnsRenamed({c: free_name(docs.columns, f"{c}__in") for c in docs.columns if c.lower() in low})


def restored(out: DataFrame, columns: Sequence[str], results: Sequence[str]) -> DataFrame:
    """The input's columns of an operator's output, under their own names."""
    low = {r.lower() for r in results}
    return out.select(*[F.col(f"`{free_name(columns, f'{c}__in')}`").alias(c) if c.lower() in low else F.col(f"`{c}`") for c in columns])


def offsets(totals: DataFrame, part: str, counts: Sequence[str], wide: int = 1024) -> DataFrame:
    """For each numbered part the sums over all parts before it, as `<c>__before`.

    A two-level prefix scan: parts are summed in blocks of `wide` neighbours, the blocks'
    sums (one row per `wide` parts) are scanned, then each block on its own.
    """
    block = F.floor(F.col(part) / wide).alias("block__")
    blocks = totals.groupBy(block).agg(*[F.sum(c).alias(f"{c}__s") for c in counts])
    far = Window.orderBy("block__").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("block__", *[F.coalesce(F.sum(f"{c}__s").over(far), F.lit(0)).alias(f"{c}__b") for c in counts])
    near = Window.partitionBy("block__").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    rows = totals.withColumn("block__", F.floor(F.col(part) / wide)).join(base, "block__")
    sums = [(F.col(f"{c}__b") + F.coalesce(F.sum(c).over(near), F.lit(0))).alias(f"{c}__before") for c in counts]
    return rows.select(part, *counts, *sums)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
