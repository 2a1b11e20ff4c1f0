"""Uniform shuffling into equal shards: a two-pass external shuffle.

Pass one scatters records over memory-sized buckets by a seeded hash; pass two permutes each
bucket (Spark's `shuffle` is a Fisher-Yates shuffle with a seed) and writes it. The buckets in a
row are the shuffled table, and shard `s` of `S` holds its places from `s*n/S` to `(s+1)*n/S`, so
the row counts of shards differ by one at most.

Scattering hashes the record's position in the input, not its content, so no key, source or
group of copies can fill a bucket. Only bucket counts (a row each) are ever gathered.

Defined cases: null or empty texts have the fixed part of the size only; repeated rows are
separate records; columns are kept inside `record`, so no name can clash; a table without rows
gives none; a text longer than a bucket has a bucket that is larger by that text.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.shared import materialize

ROW_BYTES = 16
BUCKET_BYTES = 8 << 20


def shuffled_shards(
    records: DataFrame, n_shards: int, text: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = 17
) -> DataFrame:
    """`(record, size, shard, slot, bucket, place)`, read back from the written buckets.

    `bucket_bytes` should be what a task can hold several times over; at 100 TB use about 1 GB,
    which makes 100,000 buckets.
    """
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_BYTES
    total = records.select(F.sum(size)).head()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))

    scattered = records.select(
        F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record"),
        size.alias("size"),
        F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).alias("draw"),
    ).withColumn("bucket", F.pmod("draw", F.lit(n_buckets)).cast("int"))
    # One bucket is one partition, in an order that a repeated task finds again.
    buckets = scattered.repartitionById(n_buckets, F.col("bucket")).sortWithinPartitions("bucket", "draw")
    permuted = buckets.groupBy("bucket").agg(
        F.collect_list(F.struct("record", "size")).alias("rows")
    ).select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "row"))
    written = materialize(
        permuted.select("bucket", F.col("place").cast("long").alias("place"), "row.record", "row.size"), "buckets"
    )

    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy()).alias("n"),
    )
    at = F.col("start") + F.col("place")
    shard = F.expr(f"(start + place) * {n_shards} div n")
    # A row for each bucket: as small beside the table as a bucket is large.
    return written.join(F.broadcast(starts), "bucket").select(
        "record", "size", shard.cast("int").alias("shard"),
        (at - F.expr(f"(({n_shards - 1} + n * ((start + place) * {n_shards} div n)) div {n_shards})")).alias("slot"),
        "bucket", "place",
    )
