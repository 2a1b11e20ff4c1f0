"""Figures, ledger, evaluation and metrics against small hand-made or brute-force results."""
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docquery.functions.hits import HIT
from docquery.hooks import Hook, offline
from docquery.operators import evaluate, figures, ledger, telemetry
from docquery.operators.statements import answer_decided
from docquery.streaming import ledger as ledger_stream
from docquery.streaming import rates


def test_median_against_brute_force(spark):
    rng = random.Random(1)
    rows = [("hot", float(rng.choice([rng.randint(0, 5000), 7, 7]))) for _ in range(6000)]
    rows += [("one", 3.5), ("two", 1.0), ("two", 4.0), ("same", 2.0)] + [("same", 2.0)] * 50
    rows += [("wide", float(10 ** (i % 9) * (i % 3 - 1))) for i in range(1001)] + [("none", None), (None, 8.0)]
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    frame = spark.createDataFrame(rows, "g string, v double").repartition(6)
    for hot_rows in (None, 100, 0):
        got = {r.g: r.median_value for r in figures.median_per_group(frame, "g", "v", hot_rows).collect()}
        assert got == {g: statistics.median(v) for g, v in groups.items()}


def test_median_narrows_large_groups(spark, monkeypatch):
    """With a wide bracket and few values to rank, groups take several rounds; none ranks more than allowed."""
    rng = random.Random(3)
    rows = [("even", float(i)) for i in range(4000)] + [("odd", float(i * i)) for i in range(3001)]
    rows += [("ties", float(rng.choice([1, 2, 2, 2, 3, 3.5]))) for _ in range(2000)]
    rows += [("skew", 10.0 ** rng.uniform(-300, 300)) for _ in range(5000)] + [("gap", 0.0)] * 500 + [("gap", 1e9)] * 500
    rows += [("small", 4.0), ("small", 5.0)]
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    frame = spark.createDataFrame(rows, "g string, v double").repartition(5)
    monkeypatch.setattr(figures, "_BRACKET", 0.4)
    monkeypatch.setattr(figures, "_SPLITS", 5)
    ranked = []
    real = figures._narrowed

    def watched(*args):
        few = real(*args)
        ranked.append(max(r["count"] for r in few.filter("slot is not null").groupBy("g").count().collect()))
        return few

    monkeypatch.setattr(figures, "_narrowed", watched)
    for hot_rows in (None, 0):
        got = {r.g: r.median_value for r in figures.median_per_group(frame, "g", "v", hot_rows, most=10).collect()}
        assert got == {g: statistics.median(v) for g, v in groups.items()}
    assert max(ranked) <= 10


def test_median_outside_its_bracket_is_an_error(spark, monkeypatch):
    frame = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, v double")
    monkeypatch.setattr(figures, "_narrowed", lambda counted, most, hot: counted.filter("slot is null"))
    with pytest.raises(Exception, match="outside its bracket"):
        figures.median_per_group(frame, "g", "v").collect()


def test_extremes_break_ties_by_key(spark):
    frame = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, None), ("b", 4, -1.0)], "g string, k int, v double")
    top = {r.g: (r.k, r.v) for r in figures.arg_extreme_per_group(frame, "g", "v", "k").collect()}
    low = {r.g: (r.k, r.v) for r in figures.arg_extreme_per_group(frame, "g", "v", "k", highest=False).collect()}
    assert top == low == {"a": (1, 5.0), "b": (4, -1.0)}


def approval_rows(seed, n):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (rng.randint(0, 12), start + timedelta(seconds=rng.randint(0, 400)), i, rng.choice(["request", "approve", "deny", "deny"]))
        for i in range(n)
    ]


def fold(rows):
    state = {}
    for rid, ts, _, kind in rows:
        if kind == "request":
            state[rid] = ("pending", ts)
        elif rid in state and state[rid][0] == "pending":
            state[rid] = ("approved" if kind == "approve" else "denied", state[rid][1])
    return state


def events(spark, rows):
    frame = spark.createDataFrame(rows, "request_id int, ts timestamp, seq int, kind string")
    return frame.select("request_id", F.struct("ts", "seq").alias("at"), "kind")


@pytest.mark.parametrize("seed", range(4))
def test_ledger_is_the_ordered_fold(spark, seed):
    rows = approval_rows(seed, 60)
    for hot_rows in (None, 3):
        state = ledger.resolve(events(spark, rows), hot_rows).collect()
        got = {r.request_id: (r.status, r.created_at) for r in state}
        assert got == fold(sorted(rows, key=lambda r: (r[1], r[2])))


def test_ledger_listing_and_lookup(spark):
    at = datetime(2024, 1, 1)
    state = ledger.resolve(events(spark, [(1, at, 0, "request"), (2, at, 1, "request"), (2, at, 2, "deny"), (9, at, 3, "approve")]))
    assert [r.request_id for r in ledger.pending(state).collect()] == [1]
    asked = spark.createDataFrame([(2,), (9,)], "request_id int")
    assert {r.request_id: r.status for r in ledger.lookup(state, asked).collect()} == {2: "denied", 9: None}


def full_events(spark, rows):
    """Events with a payload: what a request asks."""
    told = [(*r, f"question {r[2]}", f"select {r[2]}", f"reason {r[2]}") if r[3] == "request" else (*r, None, None, None) for r in rows]
    frame = spark.createDataFrame(told, "request_id int, ts timestamp, seq int, kind string, question string, sql string, reasons string")
    return frame.select("request_id", F.struct("ts", "seq").alias("at"), "kind", "question", "sql", "reasons")


def test_latest_payload_wins(spark):
    rows = approval_rows(3, 60)
    last = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        if r[3] == "request":
            last[r[0]] = r
    state = ledger.resolve(full_events(spark, rows))
    assert state.columns == ["request_id", "question", "sql", "reasons", "status", "created_at"]
    got = {r.request_id: (r.question, r.sql, r.reasons, r.created_at) for r in state.collect()}
    assert got == {i: (f"question {n}", f"select {n}", f"reason {n}", ts) for i, (_, ts, n, _) in last.items()}
    asked = spark.createDataFrame([(0,), (99,)], "request_id int")
    assert {r.request_id: r.question for r in ledger.lookup(state, asked).collect()} == {0: got[0][0], 99: None}


def carried_out(rows):
    """Brute force over events in order: every request that a decision followed, and those that wait."""
    waiting, done = {}, []
    for rid, ts, seq, kind in rows:
        if kind == "request":
            waiting[rid] = (rid, ts, seq)
        elif rid in waiting:
            done.append((*waiting.pop(rid), "approved" if kind == "approve" else "denied"))
    return sorted(done), sorted(waiting.values())


def settled(decided, still):
    done = sorted((r.request_id, r.requested_at.ts, r.requested_at.seq, r.status) for r in decided.collect())
    assert all(r.question == f"question {r.requested_at.seq}" for r in decided.collect())
    return done, sorted((r.request_id, r.at.ts, r.at.seq) for r in still.collect())


@pytest.mark.parametrize("seed", range(3))
def test_every_decided_request_is_settled(spark, seed):
    rows = approval_rows(seed, 80)
    in_order = sorted(rows, key=lambda r: (r[1], r[2]))
    for span in ("hour", "minute", "second"):
        assert settled(*ledger.settle(full_events(spark, rows), span=span)) == carried_out(in_order)


def test_ledger_stream_over_several_batches(spark, tmp_path):
    """Each request is carried out once, also when a batch is repeated after it was stored."""
    rows, source = approval_rows(9, 120), tmp_path / "in"
    path, progress = str(tmp_path / "ledger"), str(tmp_path / "progress")
    batches = [rows[i : i + 30] for i in (0, 30, 60, 90)]

    def run(schema):
        stream = spark.readStream.schema(schema).parquet(str(source))
        ledger_stream.start_ledger(stream, path, progress).awaitTermination()

    for n, batch in enumerate(batches):
        part = full_events(spark, batch)
        part.coalesce(1).write.mode("append").parquet(str(source))
        run(part.schema)
        arrived = [r for b in batches[: n + 1] for r in sorted(b, key=lambda r: (r[1], r[2]))]
        for _ in range(2):
            got = {r.request_id: (r.status, r.created_at) for r in ledger_stream.current_state(spark, path).collect()}
            assert got == fold(arrived)
            stored = ledger_stream.decided_requests(spark, path), ledger_stream.open_requests(spark, path)
            assert settled(*stored) == carried_out(arrived)
            # As if the stream had stopped before it noted that the batch was done.
            for name in (f"{n}", f".{n}.crc"):
                (tmp_path / "progress" / "commits" / name).unlink(missing_ok=True)
            run(part.schema)


def test_stream_answers_decided_requests_once(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three")
    at = datetime(2024, 1, 1)
    kinds = [
        [(1, "request"), (2, "request"), (3, "request"), (4, "approve")],
        [(1, "approve"), (2, "deny"), (1, "deny"), (1, "request")],
        [(1, "approve"), (3, "deny"), (3, "approve"), (2, "approve")],
    ]
    path, progress, source = (str(tmp_path / x) for x in ("ledger", "progress", "in"))
    seq = 0
    for batch in kinds:
        rows = []
        for rid, kind in batch:
            seq += 1
            asked = (f"q{seq}", "SELECT count(*) AS n FROM three", "broad") if kind == "request" else (None, None, None)
            rows.append((rid, at + timedelta(seconds=seq), seq, kind, *asked))
        frame = spark.createDataFrame(rows, "request_id int, ts timestamp, seq int, kind string, question string, sql string, reasons string")
        events_ = frame.select("request_id", F.struct("ts", "seq").alias("at"), "kind", "question", "sql", "reasons")
        events_.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events_.schema).parquet(source)
        ledger_stream.start_ledger(stream, path, progress, answer_decided).awaitTermination()
    rows = ledger_stream.decided_requests(spark, path).collect()
    done = sorted((r.request_id, r.question, r.status, r.row_count, r.text) for r in rows)
    denied = "I couldn't answer that from the database (query was denied by an administrator)."
    assert done == [(1, "q1", "executed", 1, '[{"n":3}]'), (1, "q8", "executed", 1, '[{"n":3}]'), (2, "q2", "denied", 0, denied), (3, "q3", "denied", 0, denied)]
    assert ledger_stream.open_requests(spark, path).count() == 0


def answers(spark, rows):
    return spark.createDataFrame(rows, f"question string, text string, hits array<{HIT}>, sql string, route string")


def test_evaluation(spark):
    hit = (None, "ctx", 0.9, "d", "", "", None)
    hooks = offline(8)
    yes, no = Hook(lambda a, b: F.lit(True), False), Hook(lambda a, b: F.lit(False), False)
    half = Hook(lambda a, c: a == "first", False)
    rows = answers(spark, [("q1", "first", [hit], None, "documents"), ("q2", "second", [hit, hit], None, "structured")])
    from dataclasses import replace

    def means(frame, f, r, p):
        items = evaluate.judged_items(frame, replace(hooks, faithfulness=f, relevancy=r, precision=p))
        return {x.metric: (x.score, x.n) for x in evaluate.mean_scores(items).collect()}

    assert set(means(rows, yes, yes, yes).values()) == {(1.0, 2)}
    assert [means(rows, half, yes, no)[m][0] for m in evaluate.METRICS] == [0.5, 1.0, 0.0]
    assert set(means(rows.filter("false"), yes, yes, yes).values()) == {(0.0, 0)}
    contexts = answers(spark, [("q", "5", [], "SELECT 1", "structured"), ("q", "", [], None, "documents"), ("q", "", [hit, hit], "x", "d")])
    assert [r.context for r in evaluate.with_context(contexts).collect()] == ["SELECT 1", "", "ctx\nctx"]


LOG = "ts timestamp_ntz, route string, status string, latency double, top_score double, pii_masked boolean"


def test_counters_and_buckets(spark):
    at = datetime(2024, 1, 1)
    log = spark.createDataFrame([
        (at, "documents", "executed", 0.1, 0.8, True), (at, "documents", "blocked", 0.01, 0.0, False),
        (at, "structured", "frozen", 11.0, 0.0, False),
    ], LOG)
    assert tuple(telemetry.guard_event_counts(log).head()) == (1, 1, 1)
    le = {r.le: r.n for r in telemetry.latency_histogram(log).collect()}
    assert (le["0.005"], le["0.01"], le["0.1"], le["10.0"], le["+Inf"]) == (0, 1, 2, 2, 3)
    score = {r.le: r.n for r in telemetry.top_score_histogram(log).collect()}
    assert (score["0.7"], score["0.8"], score["+Inf"]) == (0, 1, 1)
    empty = {r.le: r.n for r in telemetry.latency_histogram(log.filter("false")).collect()}
    assert set(empty.values()) == {0} and len(empty) == 15


def test_quantile_interpolation(spark):
    row = spark.createDataFrame([(0, 10, 20, 20), (0, 0, 0, 4), (4, 4, 4, 4), (0, 0, 0, 0)], "a int, b int, c int, d int")
    q = telemetry.bucket_quantile([F.col(x) for x in "abcd"], [1.0, 2.0, 4.0], 0.95)
    got = [r[0] for r in row.select(q).collect()]
    assert got[0] == pytest.approx(2 + 2 * (19 - 10) / 10) and got[1] == 4.0
    assert got[2] == pytest.approx(0.95) and got[3] is None


def test_rate_windows_and_stream(spark, tmp_path):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [
        (start + timedelta(seconds=rng.randint(0, 3000)), rng.choice(["documents", "structured"]), "executed", rng.random(), 0.5, False)
        for _ in range(400)
    ]
    log = spark.createDataFrame(rows, LOG)
    got = {(r.window_start, r.route): r.rate for r in telemetry.request_rate(log).collect()}
    want = {}
    for ts, route, *_ in rows:
        minute = ts.replace(second=0)
        for back in range(5):
            key = (minute - timedelta(minutes=back), route)
            want[key] = want.get(key, 0) + 1
    assert got == {k: round(v / 300, 9) for k, v in want.items()}
    p95 = {r.window_start: r.p for r in telemetry.latency_quantile(log).collect()}

    source = str(tmp_path / "log")
    log.coalesce(1).write.parquet(source)
    closed = max(r[0] for r in rows) - timedelta(minutes=15)
    for n, (metric, batch) in enumerate([
        (rates.request_rate_stream, {k: v for k, v in got.items()}), (rates.latency_quantile_stream, p95),
    ]):
        stream = metric(spark.readStream.schema(log.schema).parquet(source))
        out = str(tmp_path / f"out{n}")
        rates.start(stream, out, str(tmp_path / f"progress{n}")).awaitTermination()
        rows_ = spark.read.schema(stream.schema).parquet(out).collect()
        if n == 0:
            assert {(r.window_start, r.route): r.rate for r in rows_} == {k: v for k, v in batch.items() if k[0] <= closed}
        else:
            assert {r.window_start: r.p for r in rows_} == {k: v for k, v in batch.items() if k <= closed}


def test_streamed_windows_of_other_slides_files_and_zones(spark, tmp_path):
    """Several files in turn, rows that come too late, a second slide, and a session zone that changes its clocks."""
    rng = random.Random(6)
    # Clocks in New York go forward in this night.
    start = datetime(2024, 3, 10, 1, 30)
    rows = sorted(
        (start + timedelta(seconds=rng.randint(0, 7200), microseconds=rng.randint(0, 999_999)), rng.choice(["documents", "structured"]),
         "executed", rng.random(), 0.5, rng.random() < 0.3) for _ in range(600)
    )
    late = [(start + timedelta(seconds=5), "documents", "executed", 0.1, 0.5, False)] * 3
    source = str(tmp_path / "log")
    for part in (rows[:200], rows[200:450], rows[450:] + late):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(source)
    log = spark.createDataFrame(rows, LOG)
    assert dict(log.dtypes)["ts"] == "timestamp_ntz"
    closed = rows[-1][0] - timedelta(minutes=10)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for n, (window, slide) in enumerate([(300, 60), (120, 30), (600, 600)]):
            stream = rates.request_rate_stream(
                spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source), window, slide
            )
            out = str(tmp_path / f"rates{n}")
            rates.start(stream, out, str(tmp_path / f"rate-progress{n}")).awaitTermination()
            got = {(r.window_start, r.route): r.rate for r in spark.read.schema(stream.schema).parquet(out).collect()}
            batch = {(r.window_start, r.route): r.rate for r in telemetry.request_rate(log, window, slide).collect()}
            assert got == {k: v for k, v in batch.items() if k[0] + timedelta(seconds=window) <= closed} and got
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    with pytest.raises(ValueError):
        rates.request_rate_stream(log, 300, 70)


def test_extremes_of_dates_and_strings(spark):
    from docquery.operators.figures import arg_extreme_per_group

    rows = spark.createDataFrame(
        [("a", 3, "x", "2024-01-02"), ("a", 1, "z", "2024-05-01"), ("a", 2, "z", "2024-05-01"), (None, 4, "y", None), (None, 5, "w", "2020-01-01")],
        "g string, k int, s string, d string",
    ).selectExpr("g", "k", "s", "cast(d as date) d")
    by = lambda value, highest: {r.g: r.k for r in arg_extreme_per_group(rows, "g", value, "k", highest).collect()}
    assert by("s", True) == {"a": 1, None: 4} and by("s", False) == {"a": 3, None: 5}
    assert by("d", True) == {"a": 1, None: 5} and by("d", False) == {"a": 3, None: 5}


def test_windows_need_whole_slides(spark):
    from docquery.operators.telemetry import over_windows

    with pytest.raises(ValueError):
        over_windows(spark.range(1), [], [], 300, 70)
