"""Approval ledger: requests and their decisions from an append-only event table.

Events are `(request_id, at STRUCT<ts, seq>, kind)` with kind `request`, `approve` or `deny`; `at`
orders the events of a request. All other columns are the payload of a request, such as its
question, statement and reasons, and are null on decisions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.shared import hot_keys, join_around_hot, materialize


def _is_request() -> Column:
    return F.col("kind") == "request"


def payload_of(events: DataFrame) -> list[str]:
    return [c for c in events.columns if c not in ("request_id", "at", "kind")]


def latest_requests(events: DataFrame) -> DataFrame:
    """`(request_id, requested_at, created_at, payload…)`: recording again replaces a request.

    A maximum per key, combined on the map side: a key with a third of all events
    reaches the reducer as one row per task.
    """
    latest = events.filter(_is_request()).groupBy("request_id").agg(
        F.max(F.struct("at", *payload_of(events))).alias("latest")
    )
    return latest.select(
        "request_id", F.col("latest.at").alias("requested_at"), F.col("latest.at.ts").alias("created_at"),
        *[F.col("latest")[c].alias(c) for c in payload_of(events)],
    )


def status_of(kind: Column) -> Column:
    return F.when(kind == "approve", "approved").when(kind == "deny", "denied").otherwise("pending")


def first_decisions(
    decisions: DataFrame, latest: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """`(request_id, kind)` of the first decision after the latest request of each id."""
    counts = decisions.groupBy("request_id").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, "request_id", hot_rows)
    since = latest.select("request_id", "requested_at")
    return (
        join_around_hot(decisions.select("request_id", "at", "kind"), since, "request_id", hot)
        .filter(F.col("at") > F.col("requested_at"))
        .groupBy("request_id")
        .agg(F.min(F.struct("at", "kind")).alias("decided"))
        .select("request_id", F.col("decided.kind").alias("kind"))
    )


def resolve(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """`(request_id, payload…, status, created_at)`: the first decision after the latest request, else pending.

    Decisions on unknown requests, and all but the first, have no effect. Aggregates
    and a join around hot ids, so no task goes through the whole history of one request.
    """
    latest = materialize(latest_requests(events), "requests")
    first = first_decisions(events.filter(~_is_request()), latest, hot_rows)
    return latest.join(first, "request_id", "left").select(
        "request_id", *payload_of(events), status_of(F.col("kind")).alias("status"), "created_at"
    )


def pending(state: DataFrame) -> DataFrame:
    """What is waiting, oldest first."""
    return state.filter(F.col("status") == "pending").orderBy("created_at", "request_id")


def lookup(state: DataFrame, request_ids: DataFrame) -> DataFrame:
    """The record of each id asked for; nulls where there is no such request."""
    return request_ids.select("request_id").join(state, "request_id", "left")


def settle(events: DataFrame, opened: DataFrame | None = None, span: str = "hour") -> tuple[DataFrame, DataFrame]:
    """The requests that events decide, and those still open after them.

    `opened` are requests `(request_id, at, payload…)` from before, older than all events. The first
    gives `(request_id, requested_at, decided_at, payload…, status)` for each request whose next event
    is a decision, so also for one that was recorded again later; the second is like `opened`. Decisions
    that follow another decision, or no request, have no effect.

    What comes before an event is looked up in two steps, within a `span` of time and then among the last
    events of the spans, so the history of one busy id is divided as well.
    """
    payload = payload_of(events)
    spans = events.withColumn("span", F.date_trunc(span, F.col("at.ts")))
    if opened is not None:
        spans = spans.unionByName(opened.withColumns({"kind": F.lit("request"), "span": F.lit(None).cast("timestamp")}))
    event = F.struct("at", "kind", *payload)
    within = Window.partitionBy("request_id", "span").orderBy("at")
    rows = spans.withColumn("before", F.lag(event).over(within))
    lasts = spans.groupBy("request_id", "span").agg(F.max(event).alias("last"))
    among = Window.partitionBy("request_id").orderBy(F.asc_nulls_first("span"))
    earlier = lasts.select(F.col("request_id").alias("id"), F.col("span").alias("at_span"), F.lag("last").over(among).alias("earlier"))
    first = rows.filter("kind <> 'request' and before is null").drop("before").join(
        earlier, (F.col("request_id") == F.col("id")) & F.col("span").eqNullSafe(F.col("at_span"))
    ).select(*spans.columns, F.col("earlier").alias("before"))
    decisions = rows.filter("kind <> 'request' and before is not null").unionByName(first)
    decided = decisions.filter("before.kind = 'request'").select(
        "request_id", F.col("before.at").alias("requested_at"), F.col("at").alias("decided_at"),
        *[F.col("before")[c].alias(c) for c in payload], status_of(F.col("kind")).alias("status"),
    )
    last = lasts.groupBy("request_id").agg(F.max(F.struct("span", "last")).alias("l")).select("request_id", "l.last.*")
    return decided, last.filter(_is_request()).drop("kind")
