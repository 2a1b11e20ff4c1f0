"""Counters, histograms and rates over an answer log.

The log has `(ts, route, status, latency, top_score, pii_masked)`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the histogram buckets; one more bucket takes the rest.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
SCORE_BOUNDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]

RATE_WINDOW_SECONDS = 300
SLIDE_SECONDS = 60


def requests_by_route_status(log: DataFrame) -> DataFrame:
    return log.groupBy("route", "status").agg(F.count("*").alias("requests"))


def requests_by_route(log: DataFrame) -> DataFrame:
    return log.groupBy("route").agg(F.count("*").alias("requests"))


def guard_event_counts(log: DataFrame) -> DataFrame:
    """One row `(blocks, pii_masked, freezes)`."""
    return log.agg(
        F.count_if(F.col("status") == "blocked").alias("blocks"),
        F.count_if("pii_masked").alias("pii_masked"),
        F.count_if(F.col("status") == "frozen").alias("freezes"),
    )


def histogram(rows: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    """`(le, n, total, value_sum)`: cumulative counts per bound, all in one aggregate."""
    v = F.col(value)
    counts = [
        F.struct(F.lit(str(b)).alias("le"), F.count_if(v <= b).alias("n")) for b in bounds
    ]
    rest = F.struct(F.lit("+Inf").alias("le"), F.count(v).alias("n"))
    return rows.agg(
        F.array(*counts, rest).alias("b"),
        F.count(v).alias("total"),
        F.round(F.coalesce(F.sum(v), F.lit(0.0)), 6).alias("value_sum"),
    ).select(F.explode("b").alias("b"), "total", "value_sum").select(
        "b.le", "b.n", "total", "value_sum"
    )


def latency_histogram(log: DataFrame) -> DataFrame:
    return histogram(log, "latency", LATENCY_BOUNDS)


def top_score_histogram(log: DataFrame) -> DataFrame:
    """Only answers that came from documents."""
    answered = log.filter((F.col("route") == "documents") & (F.col("status") == "executed"))
    return histogram(answered, "top_score", SCORE_BOUNDS)


def slide_counts(log: DataFrame, keys: list[str], measures: list[Column], slide: int) -> DataFrame:
    """One row per slide and key: what the sliding windows are added up from."""
    start = F.window("ts", f"{slide} seconds")["start"].alias("slide_start")
    return log.groupBy(start, *keys).agg(*measures)


def over_windows(slides: DataFrame, keys: list[str], sums: list[str], window: int, slide: int) -> DataFrame:
    """Add up the slides of each window.

    The log is first reduced to one row per slide, so the rows that are repeated
    for every window they fall into are the reduced ones.
    """
    if window % slide:
        raise ValueError(f"a window of {window} s is not made of slides of {slide} s")
    back = F.explode(F.sequence(F.lit(0), F.lit(window // slide - 1))).alias("back")
    shifted = slides.select("*", back).withColumn(
        "window_start",
        F.expr(f"slide_start - make_dt_interval(0, 0, 0, back * {slide})"),
    )
    return shifted.groupBy("window_start", *keys).agg(*[F.sum(s).alias(s) for s in sums])


def request_rate(
    log: DataFrame, window: int = RATE_WINDOW_SECONDS, slide: int = SLIDE_SECONDS
) -> DataFrame:
    """`(window_start, route, status, rate)` in requests per second."""
    keys = ["route", "status"]
    slides = slide_counts(log, keys, [F.count("*").alias("n")], slide)
    summed = over_windows(slides, keys, ["n"], window, slide)
    return summed.select("window_start", *keys, F.round(F.col("n") / window, 9).alias("rate"))


def bucket_counts(value: Column, bounds: list[float]) -> list[Column]:
    """Cumulative counts `le_0 …` with the last one counting everything."""
    finite = [F.count_if(value <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return [*finite, F.count(value).alias(f"le_{len(bounds)}")]


def bucket_quantile(cumulative: list[Column], bounds: list[float], q: float) -> Column:
    """Quantile from cumulative bucket counts, linear inside the bucket it falls into.

    A rank in the last, unbounded bucket gives the largest finite bound.
    """
    rank = F.lit(q) * cumulative[-1]
    result = F.lit(bounds[-1])
    for i in reversed(range(len(bounds))):
        lower = bounds[i - 1] if i else 0.0
        before = cumulative[i - 1] if i else F.lit(0)
        inside = F.lit(lower) + (bounds[i] - lower) * (
            (rank - before) / F.nullif(cumulative[i] - before, F.lit(0))
        )
        result = F.when(cumulative[i] >= rank, inside).otherwise(result)
    return F.when(cumulative[-1] > 0, result)


def latency_quantile(
    log: DataFrame,
    q: float = 0.95,
    window: int = RATE_WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
) -> DataFrame:
    """`(window_start, p)`: the quantile of the latencies of each sliding window."""
    names = [f"le_{i}" for i in range(len(LATENCY_BOUNDS) + 1)]
    slides = slide_counts(log, [], bucket_counts(F.col("latency"), LATENCY_BOUNDS), slide)
    summed = over_windows(slides, [], names, window, slide)
    p = bucket_quantile([F.col(n) for n in names], LATENCY_BOUNDS, q)
    return summed.select("window_start", F.round(p, 6).alias("p"))
