"""The approval ledger as a stream: requests freeze durably until a decision arrives and is carried out once.

A micro-batch reads the requests left open by the one before, writes those it decides and those it
leaves open to folders of its own, and then commits itself. So its cost grows with the batch and
the open requests, not with the history; a request leaves the open ones when it is decided and
cannot be decided again; and repeating a batch that failed halfway replaces what it wrote.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docquery.operators.ledger import settle
from docquery.shared import discard, materialize


def _committed(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """The last batch that was committed, before batch `below` if given."""
    try:
        commits = spark.read.schema("batch long").parquet(f"{path}/commits/*")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return commits.filter(F.col("batch") < below if below is not None else F.lit(True)).agg(F.max("batch")).head()[0]


def start_ledger(
    events: DataFrame, path: str, checkpoint: str, carry_out: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Keep the ledger of a stream of events at `path`, which belongs to this `checkpoint` alone.

    `carry_out` gets the requests that a batch decides, each once, and returns what is kept of them
    (`operators.statements.answer_decided`, for one); without it they are kept as they are. The
    trigger is availableNow; use `maxFilesPerTrigger` on the source to bound a batch.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read several times below; a source such as a queue should be read once.
        stored = materialize(batch, "events")
        before = _committed(spark, path, batch_id)
        opened = None if before is None else spark.read.parquet(f"{path}/open/{before}")
        decided, still = settle(stored, opened)
        kept = carry_out(decided) if carry_out else decided
        kept.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/decided/{batch_id}")
        still.write.mode("overwrite").parquet(f"{path}/open/{batch_id}")
        commit = spark.range(batch_id, batch_id + 1, numPartitions=1).select(F.col("id").alias("batch"))
        commit.write.mode("overwrite").parquet(f"{path}/commits/{batch_id}")
        discard(stored)

    return (
        events.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def open_requests(spark: SparkSession, path: str) -> DataFrame | None:
    """`(request_id, at, payload…)` of the requests that wait, or None before the first batch."""
    batch = _committed(spark, path)
    return None if batch is None else spark.read.parquet(f"{path}/open/{batch}")


def decided_requests(spark: SparkSession, path: str) -> DataFrame | None:
    """What was kept of the requests decided so far, each once, with the `batch` that decided it."""
    batch = _committed(spark, path)
    if batch is None:
        return None
    return spark.read.parquet(f"{path}/decided/*").filter(F.col("batch") <= batch)


def current_state(spark: SparkSession, path: str) -> DataFrame:
    """`(request_id, status, created_at)` of the latest request of each id.

    Decisions that arrive in a later batch than a request apply to it in arrival order.
    """
    waiting = open_requests(spark, path).select("request_id", F.lit("pending").alias("status"), F.col("at.ts").alias("created_at"))
    last = decided_requests(spark, path).groupBy("request_id").agg(
        F.max(F.struct("batch", "decided_at", "status", F.col("requested_at.ts").alias("created_at"))).alias("d")
    ).select("request_id", "d.status", "d.created_at")
    return last.join(waiting, "request_id", "left_anti").unionByName(waiting)
