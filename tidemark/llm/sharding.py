"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly into buckets small enough for memory, by a seeded
hash of the whole record. Pass two loads one bucket at a time, puts it into a canonical
order, shuffles it with a Fisher-Yates permutation and writes it. Buckets follow one
another, so a record's place in the whole order is its bucket's offset plus its place
inside, and shards are equal cuts of that order: their counts differ by one at most.

Defined cases: nulls are hashed like values, a null text has the size of an empty one;
rows equal in every column are interchangeable and share a bucket; with fewer rows than
shards the last shards are empty; an empty table gives empty shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .store import Scratch, aside, free_name, offsets, parts

RESULTS = ("shard", "slot")
BUCKET_BYTES = 16 << 20


def shuffle_shards(docs: DataFrame, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> DataFrame:
    """The rows of `docs` with `shard` (int, 0 to shards - 1) and `slot` (long, gapless from 0
    in each shard), in a seeded random order that depends on the rows alone.

    `docs` is read twice; the number of buckets follows its measured size.
    """
    docs = aside(docs, RESULTS)
    key, bucket, place = (free_name(docs.columns, c) for c in ("key__", "bucket__", "place__"))
    hashed = docs.withColumn(key, F.xxhash64(F.lit(seed), *[F.xxhash64(F.col(f"`{c}`"), F.isnull(F.col(f"`{c}`"))) for c in docs.columns]))
    size = F.coalesce(F.sum(F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 64), F.lit(0)).alias("bytes")
    total = docs.agg(size).first()["bytes"]
    n_buckets = max(1, 4 * parts(docs.sparkSession), -(-total // bucket_bytes))
    scattered = hashed.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(n_buckets)))

    def permute(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [(key, "ascending")]))
        n = table.num_rows
        rng = np.random.Generator(np.random.PCG64([seed, table.column(bucket)[0].as_py()]))
        table = table.take(pa.array(rng.permutation(n)))  # numpy's permutation is a Fisher-Yates shuffle
        return table.append_column(place, pa.array(np.arange(n), pa.int64()))

    shuffled = scattered.groupBy(bucket).applyInArrow(permute, StructType([*scattered.schema, StructField(place, LongType())]))
    counts = scattered.groupBy(bucket).agg(F.count(F.lit(1)).alias("n__"))
    counts = Scratch(docs.sparkSession).keep(offsets(counts, bucket, ["n__"]))
    n = counts.agg(F.coalesce(F.sum("n__"), F.lit(0)).alias("n")).first()["n"]
    # the first `more` shards hold `least + 1` rows, the others `least`
    least, more = divmod(n, shards)
    at = F.col("n____before") + F.col(place)
    early = at < F.lit(more * (least + 1))
    wide, narrow = F.lit(least + 1), F.lit(max(least, 1))
    rest = at - F.lit(more * (least + 1))
    shard = F.when(early, F.floor(at / wide)).otherwise(more + F.floor(rest / narrow)).cast("int")
    slot = F.when(early, F.pmod(at, wide)).otherwise(F.pmod(rest, narrow)).cast("long")
    placed = shuffled.join(counts.select(bucket, "n____before"), bucket)
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], shard.alias("shard"), slot.alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """Write shards as folders `shard=0`, ... below `path`; the table read back from there.
    A bucket lies in one shard or on the border of two, so each task writes few files."""
    sharded.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return sharded.sparkSession.read.schema(sharded.schema).parquet(path)
