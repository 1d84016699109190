"""Sources and sinks: named tables, JDBC, delimited files, stages, snapshots."""

from __future__ import annotations

import datetime as dt
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def load_tables(
    spark: SparkSession, path: str, names: Sequence[str], jdbc: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Named tables from parquet files under `path`, or over JDBC when options are given.

    JDBC options may carry partitionColumn / lowerBound / upperBound / numPartitions,
    so that a large table is read by many tasks.
    """
    if jdbc is not None:
        return {n: spark.read.format("jdbc").options(**jdbc, dbtable=n).load() for n in names}
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}.parquet") for n in names}


def suffix_duplicates(names: Sequence[str]) -> list[str]:
    """Second and later uses of a name become name__1, name__2, ..."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen.get(n, 0)
        seen[n] = k + 1
        out.append(n if k == 0 else f"{n}__{k}")
    return out


# one text form for times without a zone, in both directions
_CSV = {"header": True, "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """Directory of delimited part files with a header; duplicate names get suffixes."""
    named = df.toDF(*suffix_duplicates(df.columns))
    named.write.mode("overwrite").format("csv").options(sep=sep, **_CSV).save(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ";") -> DataFrame:
    return spark.read.format("csv").options(sep=sep, **_CSV).schema(schema).load(path)


def run_stage(df: DataFrame, step: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """Apply a step, hand its result over as comma-separated files, return it re-read."""
    out = step(df)
    write_csv(out, path, sep=",")
    return read_csv(df.sparkSession, path, out.schema, sep=",")


def export(df: DataFrame, uri: str, fmt: str = "csv") -> None:
    """Final result to any URI Spark can write (local, s3a://, hdfs://...)."""
    if fmt == "csv":
        write_csv(df, uri, sep=",")
    else:
        df.write.mode("overwrite").format(fmt).save(uri)


def cached(
    spark: SparkSession,
    root: str,
    key: str,
    loader: Callable[[], DataFrame],
    today: dt.date,
    max_age_days: int = 7,
) -> DataFrame:
    """Latest snapshot of `key` younger than `max_age_days`, else load and keep a new one.

    Snapshots are parquet folders by date; the folder listing is read through
    Spark's own file system, so any storage it knows will do.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{key}")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = []
    if fs.exists(base):
        for st in fs.listStatus(base):
            name = st.getPath().getName()
            if name.startswith("day=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                days.append(dt.date.fromisoformat(name[4:]))
    usable = [d for d in days if d <= today]
    if usable and (today - max(usable)).days < max_age_days:
        return spark.read.parquet(f"{root.rstrip('/')}/{key}/day={max(usable).isoformat()}")
    target = f"{root.rstrip('/')}/{key}/day={today.isoformat()}"
    loader().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Named intermediate, kept for reuse (spills to disk; rebuilt if an executor goes)."""
    df.createOrReplaceTempView(name)
    df.sparkSession.catalog.cacheTable(name)
    return df.sparkSession.table(name)


def head_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows by a key: a top-n, not a full sort."""
    return df.orderBy(*[F.col(c) for c in order]).limit(n)
