"""Shared working storage and size guards.

Everything that has to outlive one plan goes to a folder below
``spark.checkpoint.dir``.  On a cluster that setting names storage every
executor can reach, so a lost executor never loses a written table.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}  # by application, for local sessions without a folder


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, taken from the session.

    Only a session that names no folder (a local test) gets a temporary one.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        application = spark.sparkContext.applicationId
        if application not in _local_roots:
            _local_roots[application] = tempfile.mkdtemp(prefix="corpuslab-")
        root = _local_roots[application]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one run; two runs never share it."""
    return f"{shared_root(spark)}/corpuslab/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once, write it to shared storage and read it back.

    Used where a result is read several times, and to cut lineage.  The plan
    behind it runs once, and later reads prune columns as any Parquet scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collect_bounded(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table that must be small; more than ``limit`` rows is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows")
    return rows


def deal(df: DataFrame, key: str) -> DataFrame:
    """All rows of a key in one partition, so that grouping by the key and more columns needs no further exchange.

    Deal whole texts before they are cut into words: their words are many
    times as large.  The number of partitions is fixed, as merged ones would
    hold more words than a task can count in memory.
    """
    spark = df.sparkSession
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(fewest, 4 * spark.sparkContext.defaultParallelism), key)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition a scan with fewer splits than cores; leave all others alone.

    A single small file is one split, which would run costly text functions on
    one core.  A big table has many splits and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
