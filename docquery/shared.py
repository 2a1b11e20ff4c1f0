"""Shared-folder tables: how a plan is cut so that work is not repeated."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_TASKS_PER_CORE = 3


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; a cluster
    without one is an error, since executors could not see a driver-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="docquery-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage so that several consumers do not recompute it, and survives
    the loss of executors (unlike cached blocks).
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.__dict__["_stored_at"] = path
    return stored


def discard(stored: DataFrame) -> None:
    """Remove the files of a materialized table that nothing will read any more."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.__dict__["_stored_at"])
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for costly row-local work when the input has fewer partitions than cores.

    A scan of a large table has far more partitions than cores and passes unchanged,
    without a shuffle; a few small files would otherwise leave most cores idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(_TASKS_PER_CORE * cores) if df.rdd.getNumPartitions() < cores else df


# A key is hot above this many rows, and at most so many keys may count as hot: that
# bounds what is broadcast, however large the table.
HOT_ROWS = 1_000_000
MOST_HOT_KEYS = 100_000


def hot_keys(counts: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """The stored `(key)` rows of `counts(key, n)` that make up too much of their table for one task."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = materialize(counts.filter(F.col("n") > hot_rows).select(key, "n"), "hot")
    while hot.limit(MOST_HOT_KEYS + 1).count() > MOST_HOT_KEYS:
        hot_rows = 10 * max(hot_rows, 1)
        hot = hot.filter(F.col("n") > hot_rows)
    return hot.select(key)


def join_around_hot(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join of `rows` with `table`, which has one row per key, without gathering a hot key.

    An aggregate on the join key afterwards would keep the join from being rebalanced
    at run time. So the rows of hot keys are joined where they lie, against the few
    table rows they need, and only the others are shuffled.
    """
    if hot.head() is None:
        return rows.join(table, key)
    few = F.broadcast(hot)
    for_hot = F.broadcast(table.join(few, key, "left_semi"))
    cold = rows.join(few, key, "left_anti").join(table, key)
    return rows.join(for_hot, key).unionByName(cold)
