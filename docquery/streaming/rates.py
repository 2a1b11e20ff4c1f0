"""Answer-log metrics over a stream, with a watermark for late rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docquery.operators.telemetry import (
    LATENCY_BOUNDS,
    RATE_WINDOW_SECONDS,
    SLIDE_SECONDS,
    bucket_counts,
    bucket_quantile,
)

LATENESS = "10 minutes"


_EPOCH = "timestamp_ntz '1970-01-01 00:00:00'"


def _timed(log: DataFrame) -> DataFrame:
    """The log with `ts` as an instant, which a watermark needs.

    A wall-clock time counts as UTC, whatever the zone of the session: its windows do not shift, and none
    is lost or doubled, when clocks change.
    """
    if dict(log.dtypes)["ts"] == "timestamp_ntz":
        since = f"(ts - {_EPOCH})"
        parts = " + ".join(f"cast(extract({part} from {since}) as decimal(20,6)) * {n}" for part, n in
                           (("day", 86400), ("hour", 3600), ("minute", 60), ("second", 1)))
        log = log.withColumn("ts", F.expr(f"timestamp_micros(cast(({parts}) * 1000000 as bigint))"))
    return log.withWatermark("ts", LATENESS)


def _wall_clock(instant: Column) -> Column:
    """A time as UTC clocks show it."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _over_windows(
    log: DataFrame, keys: list[str], measures: list[Column], sums: list[str], window: int, slide: int
) -> DataFrame:
    """`(window_start, keys, sums)` of sliding windows that have closed.

    Rows are first added up per slide; only the sums of a slide are repeated for the windows it falls into.
    """
    if window % slide:
        raise ValueError(f"a window of {window} s is not made of slides of {slide} s")
    slides = _timed(log).groupBy(F.window("ts", f"{slide} seconds").alias("w"), *keys).agg(*measures)
    within = slides.select(F.window_time("w").alias("t"), *keys, *sums)
    windows = within.groupBy(F.window("t", f"{window} seconds", f"{slide} seconds").alias("w"), *keys)
    return windows.agg(*[F.sum(s).alias(s) for s in sums]).select(
        _wall_clock(F.col("w.start")).alias("window_start"), *keys, *sums
    )


def request_rate_stream(
    log: DataFrame, window: int = RATE_WINDOW_SECONDS, slide: int = SLIDE_SECONDS
) -> DataFrame:
    """`(window_start, route, status, rate)` once each window has closed."""
    keys = ["route", "status"]
    summed = _over_windows(log, keys, [F.count("*").alias("n")], ["n"], window, slide)
    return summed.select("window_start", *keys, F.round(F.col("n") / window, 9).alias("rate"))


def latency_quantile_stream(
    log: DataFrame,
    q: float = 0.95,
    window: int = RATE_WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
) -> DataFrame:
    names = [f"le_{i}" for i in range(len(LATENCY_BOUNDS) + 1)]
    summed = _over_windows(log, [], bucket_counts(F.col("latency"), LATENCY_BOUNDS), names, window, slide)
    p = bucket_quantile([F.col(n) for n in names], LATENCY_BOUNDS, q)
    return summed.select("window_start", F.round(p, 6).alias("p"))


def request_counts_stream(log: DataFrame, window: int = RATE_WINDOW_SECONDS) -> DataFrame:
    """Counters per closed tumbling window, route and status; totals are their sums."""
    w = F.window("ts", f"{window} seconds").alias("w")
    counts = _timed(log).groupBy(w, "route", "status").agg(
        F.count("*").alias("requests"), F.count_if("pii_masked").alias("pii_masked")
    )
    return counts.select(
        _wall_clock(F.col("w.start")).alias("window_start"), "route", "status",
        "requests", "pii_masked",
    )


def start(metrics: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed windows to a parquet table, until what is available has been read."""
    return (
        metrics.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
