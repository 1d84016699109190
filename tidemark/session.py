"""Session helpers: sensible defaults for tests, cluster settings left alone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; if none is named, one beside the warehouse's
    tables, which every executor reaches as well."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/tidemark-checkpoints")
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint folder, for written hand-overs."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"


def handed_over(df: DataFrame) -> DataFrame:
    """The rows as a written table, compressed by column. The shuffle files that were needed for it go as
    soon as it is written, so that steps handed over one after the other need the disk of the largest."""
    spark, at, name = df.sparkSession, scratch_dir(df.sparkSession), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        df.write.option("compression", "zstd").parquet(at)
    finally:
        spark.conf.set(name, was)
    return spark.read.schema(df.schema).parquet(at)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a hand-over folder made by `scratch_dir`, through Spark's own file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
