"""Audit and guarded execution of SQL statements held in a table."""
from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.functions import planscreen, sqlscreen
from docquery.functions.text import let
from docquery.hooks import Hook
from docquery.operators.gating import decide
from docquery.settings import DEFAULTS, Settings
from docquery.shared import fresh_path, materialize

TOO_SLOW = "it took too long"
UNSAFE = "could not generate a safe query"
RESULT = "sql string, row_count int, rows_json string, error string"


class NotReadOnlyError(ValueError):
    """The statement is not one read-only SELECT."""


def route_questions(rows: DataFrame, classifier: Hook, column: str = "question") -> DataFrame:
    """Add `route`: the keyword rule first, the classifier for the rest."""
    named = sqlscreen.wants_data(F.col(column))
    answered = decide(rows, named, F.lit("structured"), classifier, [F.col(column)], "_reply")
    route = F.when(F.lower("_reply").contains("structured"), "structured").otherwise("documents")
    return answered.withColumn("route", route).drop("_reply")


def validate(rows: DataFrame, column: str = "raw_sql") -> DataFrame:
    """Add `sql` (cleaned, null when refused), `valid` and `error` (first rule broken).

    The rules share one cleaned text, so a filter on `valid` that is pushed below
    this step cleans each statement once more, not once per rule.
    """
    audit = let(
        sqlscreen.cleaned_sql(F.coalesce(column, F.lit(""))),
        lambda sql: F.struct(sql.alias("sql"), sqlscreen.validation_error(sql).alias("error")),
    )
    error = F.col("_audit.error")
    return rows.withColumn("_audit", audit).withColumns(
        {"error": error, "valid": error.isNull(), "sql": F.when(error.isNull(), F.col("_audit.sql"))}
    ).drop("_audit")


def risk_rules(settings: Settings = DEFAULTS) -> Hook:
    """From a statement to the reasons why somebody should be asked before it runs; none if it is safe."""
    return Hook(
        lambda sql: sqlscreen.risk_reasons(sql, settings.sensitive_columns, settings.flag_broad_scans), costly=False
    )


def with_risk(
    rows: DataFrame, settings: Settings = DEFAULTS, column: str = "sql", risk: Hook | None = None
) -> DataFrame:
    """Add `reasons` and `risky`."""
    found = (risk or risk_rules(settings))(F.col(column))
    return rows.withColumn("reasons", found).withColumn("risky", F.size("reasons") > 0)


def run_select(spark: SparkSession, sql: str, max_rows: int | None = None) -> DataFrame:
    """At most `max_rows` rows of one SELECT over the registered views.

    The parsed plan decides, before anything is analysed: an analysed path is already read.
    """
    text = sql.strip().rstrip(";").strip()
    if ";" in text:
        raise NotReadOnlyError(sqlscreen.STACKED_AT_RUN)
    if not text.lower().startswith("select"):
        raise NotReadOnlyError(sqlscreen.NOT_SELECT)
    if broken := planscreen.plan_error(spark, text):
        raise NotReadOnlyError(broken)
    return spark.sql(text).limit(max_rows or DEFAULTS.sql_max_rows)


def execute_distinct(statements: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """`(sql, row_count, rows_json, error)` for each distinct statement of `(sql)`.

    A statement is a query of its own and has to be planned by the driver, so the
    distinct texts are streamed to it one partition at a time and `sql_at_once` of
    them run side by side. Their capped results go to the shared folder, never through
    the driver. All statements are run; one that fails, or takes longer than
    `sql_seconds`, yields its error and does not hold up the others. A statement may be
    late because another one has taken all cores, so late ones get their time once more,
    alone. What is cancelled are the jobs of a statement; the time to plan it is not cut
    short. Where Spark schedules by pools, each statement has a pool of its own.
    """
    spark = statements.sparkSession
    path = fresh_path(spark, "results")
    spark.createDataFrame([], RESULT).write.parquet(f"{path}/none")
    texts = (r["sql"] for r in statements.select("sql").distinct().toLocalIterator())
    taking = threading.Lock()

    late: list[str] = []

    def work(_: int) -> None:
        for sql in _taken(texts, taking):
            if not _run_one(spark, sql, path, settings):
                late.append(sql)

    with ThreadPoolExecutor(settings.sql_at_once) as pool:
        list(pool.map(work, range(settings.sql_at_once)))
    for sql in late:
        if not _run_one(spark, sql, path, settings):
            _failed(spark, sql, TimeoutError(TOO_SLOW)).write.parquet(_part_of(path))
    return spark.read.schema(RESULT).parquet(f"{path}/*")


def _taken(texts: Iterator[str], taking: threading.Lock) -> Iterator[str]:
    """Texts of an iterator that several threads share."""
    while True:
        with taking:
            sql = next(texts, None)
        if sql is None:
            return
        yield sql


def _part_of(path: str) -> str:
    return f"{path}/{uuid.uuid4().hex}"


def _run_one(spark: SparkSession, sql: str, path: str, settings: Settings) -> bool:
    """Store the result of a statement, or return False if its time is over.

    Its jobs carry a tag of their own, by which they are cancelled.
    """
    target, late, over = _part_of(path), threading.Event(), threading.Event()
    tag = target.rpartition("/")[2]

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelJobsWithTag(tag)
        # Again and again, as there may be no job just now.
        while not over.wait(1):
            spark.sparkContext.cancelJobsWithTag(tag)

    watch = threading.Timer(settings.sql_seconds, stop)
    watch.daemon = True
    spark.sparkContext.addJobTag(tag)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", tag)
    watch.start()
    try:
        _planned(spark, sql, settings.sql_max_rows).write.mode("overwrite").parquet(target)
        return True
    except (PySparkException, Py4JError) as problem:
        failed = problem
    finally:
        over.set()
        watch.cancel()
        spark.sparkContext.removeJobTag(tag)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    if late.is_set():
        return False
    _failed(spark, sql, failed).write.mode("overwrite").parquet(target)
    return True


def _planned(spark: SparkSession, sql: str, max_rows: int) -> DataFrame:
    try:
        rows = run_select(spark, sql, max_rows)
        # Columns are taken by place, as their names may repeat; the first of a name is answered.
        places = {name: i for i, name in reversed(list(enumerate(rows.columns)))}
        names = [name for i, name in enumerate(rows.columns) if places[name] == i]
        rows = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
        row = F.struct(*[F.col(f"c{places[name]}").alias(name) for name in names])
        # limit leaves one partition of at most max_rows rows, so this list is short
        result = rows.agg(
            F.count("*").cast("int").alias("row_count"),
            F.to_json(F.collect_list(row), {"ignoreNullFields": "false"}).alias("rows_json"),
        )
        return result.select(
            F.lit(sql).alias("sql"), "row_count", "rows_json", F.lit(None).cast("string").alias("error")
        )
    except (PySparkException, NotReadOnlyError) as problem:
        return _failed(spark, sql, problem)


def _failed(spark: SparkSession, sql: str, problem: Exception) -> DataFrame:
    if isinstance(problem, (NotReadOnlyError, TimeoutError)):
        reason = str(problem)
    else:
        reason = getattr(problem, "getCondition", str)() or type(problem).__name__
    return spark.createDataFrame([(sql, 0, None, f"query failed to execute: {reason}")], RESULT)


def refusal(error: Column) -> Column:
    return F.concat(F.lit("I couldn't answer that from the database ("), error, F.lit(")."))


def structured_branch(
    log: DataFrame, settings: Settings = DEFAULTS, risk: Hook | None = None, answer: Hook | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Answer rows for a log `(request_id, question, raw_sql)`.

    Validated statements without risk flags run, risky ones freeze until somebody
    decides, and failures answer with their reason. Each distinct statement is
    audited and run once, however often it occurs in the log; the outcome is a
    stored table, so its true size decides how it is joined back.

    `risk` replaces the rules of `risk_rules`. `answer` makes the text of a question, its
    statement and the rows found, which otherwise are the text as they are. `finish` adds to the
    rows what follows from their text alone, such as its masking: once for each distinct
    statement, unless `answer` makes the text of each row.
    """
    finish = finish or (lambda rows: rows)
    log = log.withColumn("raw_sql", F.coalesce("raw_sql", F.lit("")))
    valid = validate(log.select("raw_sql").distinct())
    if settings.approval_enabled:
        assessed = _assessed(valid, settings, risk)
    else:
        # Nobody is asked, so nothing is assessed.
        assessed = valid.withColumns(
            {"reasons": F.array().cast("array<string>"), "risky": F.lit(False), "frozen": F.lit(False)}
        )
    audited = materialize(assessed, "audited")
    results = execute_distinct(audited.filter(F.col("valid") & ~F.col("frozen")), settings)
    outcomes = _outcomes(audited, results)
    if answer is None:
        told = materialize(finish(_said(outcomes, None)), "outcomes")
        return log.join(told, "raw_sql").drop("raw_sql")
    return finish(_said(log.join(outcomes, "raw_sql").drop("raw_sql"), answer))


def _assessed(valid: DataFrame, settings: Settings, risk: Hook | None) -> DataFrame:
    """Add `reasons`, `risky` and `frozen` to validated statements; only the valid ones are assessed."""
    rules = risk or risk_rules(settings)
    none = F.array().cast("array<string>")
    known = decide(valid, ~F.col("valid"), none, rules, [F.col("sql")], "reasons")
    return known.withColumn("risky", F.size("reasons") > 0).withColumn("frozen", F.col("valid") & F.col("risky"))


def _said(rows: DataFrame, answer: Hook | None) -> DataFrame:
    """Rows with `text`, or where that is null what `answer` makes of `(question, sql, rows_json)`."""
    if answer is None:
        return rows.withColumn("text", F.coalesce("text", "rows_json")).drop("rows_json")
    asked = [F.col("question"), F.col("sql"), F.col("rows_json")]
    told = decide(rows, F.col("text").isNotNull(), F.col("text"), answer, asked, "_said")
    return told.withColumn("text", F.col("_said")).drop("rows_json", "_said")


def resume_decided(
    frozen: DataFrame, decisions: DataFrame, settings: Settings = DEFAULTS, answer: Hook | None = None
) -> DataFrame:
    """Answers of frozen rows `(request_id, question, sql, reasons)` that have been decided.

    decisions: `(request_id, status)` from the ledger. Approved statements run;
    denied ones answer with the refusal; undecided requests stay out.
    """
    decided = frozen.join(
        decisions.filter(F.col("status").isin("approved", "denied")), "request_id"
    ).select("request_id", "question", "sql", F.array_join("reasons", "; ").alias("reasons"), "status")
    return answer_decided(decided, settings, answer).withColumnRenamed("reasons", "risk_reason")


def answer_decided(decided: DataFrame, settings: Settings = DEFAULTS, answer: Hook | None = None) -> DataFrame:
    """Carry out requests `(question, sql, status, …)` that are `approved` or `denied`.

    Adds `text` and `row_count`; `status` becomes `executed` or `denied`. Each distinct statement runs
    once. A null statement was never valid, and is answered with that.
    """
    decided = materialize(decided, "decided")
    results = execute_distinct(decided.filter((F.col("status") == "approved") & F.col("sql").isNotNull()), settings)
    denied = F.col("status") == "denied"
    error = (
        F.when(denied, sqlscreen.DENIED).when(F.col("sql").isNull(), UNSAFE).otherwise(F.col("result_error"))
    )
    answered = decided.join(_renamed(results), "sql", "left").select(
        *decided.drop("status").columns,
        F.when(error.isNotNull(), refusal(error)).alias("text"), "rows_json",
        F.when(denied, 0).otherwise(F.coalesce("row_count", F.lit(0))).alias("row_count"),
        F.when(denied, "denied").otherwise("executed").alias("status"),
    )
    return _said(answered, answer)


def _renamed(results: DataFrame) -> DataFrame:
    return results.withColumnRenamed("error", "result_error")


def _outcomes(audited: DataFrame, results: DataFrame) -> DataFrame:
    """What each audited statement answers with: a `text`, or the rows it found."""
    invalid = F.concat(F.lit(UNSAFE + ": "), F.col("error"))
    error = F.when(~F.col("valid"), invalid).otherwise(F.col("result_error"))
    return audited.join(_renamed(results), "sql", "left").select(
        "raw_sql", "sql", F.when(F.col("frozen"), "").when(error.isNotNull(), refusal(error)).alias("text"), "rows_json",
        F.when(F.col("frozen"), 0).otherwise(F.coalesce("row_count", F.lit(0))).alias("row_count"),
        F.when(F.col("frozen"), "frozen").otherwise("executed").alias("status"),
        F.when(F.col("valid"), F.array_join("reasons", "; ")).otherwise("").alias("risk_reason"),
    )
