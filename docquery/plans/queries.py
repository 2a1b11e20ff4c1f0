"""The registered queries: each operator over the given tables, or over tables derived from them."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery import hooks as H
from docquery.functions import chunking, sqlscreen
from docquery.functions.hits import NO_HITS, context
from docquery.functions.hits import top_score as best_score
from docquery.operators import correct, evaluate, figures, firewall, ledger, statements, telemetry
from docquery.operators.rerank import rerank_top_n, with_rerank_score
from docquery.operators.retrieve import Index, retrieve, scored_candidates
from docquery.operators.search import vector_top_k
from docquery.plans import inputs
from docquery.plans.answering import answer_batch, grounded_prompts
from docquery.settings import DEFAULTS
from docquery.shared import fresh_path, materialize
from docquery.sources import files, index
from docquery.sources.tables import register_views, rows_to_text, table
from docquery.streaming import ingest as ingest_stream
from docquery.streaming import ledger as ledger_stream
from docquery.streaming import rates as rate_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Order totals are this data's confidential figure.
SETTINGS = replace(DEFAULTS, sensitive_columns=("salary", "o_totalprice"))
HOOKS = H.offline(SETTINGS.embed_dim)
SPLIT_SIZE = 350
# Customer keys that share a file of rejected_files.
KEYS_PER_FILE = 1_000_000

_stored: dict[tuple, object] = {}


def query(fn: Query) -> Query:
    """Register a query under its name, without a trailing underscore."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def once(spark: SparkSession, folder: str, name: str, build: Callable[[], object]):
    """A stored table that several queries of a session read, such as the chunk index."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.documents(spark, folder).unionByName(inputs.transcripts(spark, folder))


def corpus_index(spark: SparkSession, folder: str) -> Index:
    return once(
        spark, folder, "index",
        lambda: index.index_in_place(corpus(spark, folder), HOOKS.embedder, SETTINGS),
    )


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    questions = inputs.benchmark_questions(spark, folder)
    return questions.withColumn("query", F.col("question"))


def question_hits(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark passages as questions, with their final hits."""
    return once(
        spark, folder, "hits",
        lambda: materialize(
            retrieve(_asked(spark, folder), corpus_index(spark, folder), HOOKS, SETTINGS), "hits"
        ),
    )


# ---- sources and sinks -------------------------------------------------------


@query
def read_text_documents(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_path(spark, "folder")
    parts = inputs.transcripts(spark, folder).withColumn("value", F.col("text"))
    parts.select("source", "value").write.partitionBy("source").text(root)
    return files.read_text_documents(spark, root).select("text")


def _segment() -> Column:
    return F.regexp_extract("path", "c_mktsegment=([^/]*)/", 1).alias("segment")


@query
def rejected_files(spark: SparkSession, folder: str) -> DataFrame:
    """How many files of a file type that is not supported each segment has.

    A segment has one file per `KEYS_PER_FILE` customer keys: each such range meets in one writing task.
    """
    root = fresh_path(spark, "folder")
    customers = table(spark, folder, "customer").select(
        "c_mktsegment", "c_name", F.floor(F.col("c_custkey") / KEYS_PER_FILE).alias("part")
    )
    dealt = customers.repartition("c_mktsegment", "part").write.partitionBy("c_mktsegment", "part")
    dealt.option("maxRecordsPerFile", 0).json(root)
    return files.rejected_files(spark, root).groupBy(_segment(), "reason").agg(F.count("*").alias("n_files"))


@query
def skipped_files(spark: SparkSession, folder: str) -> DataFrame:
    """Folders with files of an unsupported type, of a type without a parser, without text, and with text."""
    root = fresh_path(spark, "folder")
    customers = table(spark, folder, "customer").select("c_mktsegment", "c_name")
    by_segment = customers.write.partitionBy("c_mktsegment")
    by_segment.json(f"{root}/json")
    by_segment.text(f"{root}/full")
    # A file of separators that stand for bytes that are no text.
    blank = customers.select("c_mktsegment", F.lit("").alias("value"))
    blank.write.partitionBy("c_mktsegment").option("lineSep", "\ufffd").text(f"{root}/blank")
    _renamed(spark, f"{root}/scans", customers.select("c_mktsegment").distinct(), ".pdf")
    found = files.skipped_files(spark, root)
    return found.select(_segment(), F.regexp_extract("path", "/(json|full|blank|scans)/", 1).alias("part"), "reason").distinct()


def _renamed(spark: SparkSession, root: str, segments: DataFrame, suffix: str) -> None:
    """One text file per segment, with another suffix; Spark's writers do not let their files be named."""
    segments.withColumn("value", F.col("c_mktsegment")).write.partitionBy("c_mktsegment").text(root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path").collect():
        system.rename(path(row["path"]), path(row["path"].removesuffix(".txt") + suffix))


@query
def rows_to_text_(spark: SparkSession, folder: str) -> DataFrame:
    return rows_to_text(table(spark, folder, "nation"), "Nation", "n_nationkey")


@query
def rows_to_text_part(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    small = F.when(F.col("p_size") > 10, F.col("p_size"))
    return rows_to_text(rows.withColumn("p_size", small), "Part", "p_partkey")


@query
def read_question_set(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "questions")
    item = F.struct(
        F.col("text").alias("question"), F.lit("documents").alias("expected_route")
    )
    table(spark, folder, "benchmark").groupBy(F.floor(F.col("item_id") / 25).alias("file")).agg(
        F.to_json(F.collect_list(item)).alias("value")
    ).write.partitionBy("file").text(path)
    return files.read_question_set(spark, path).select("question", "expected_route")


@query
def eval_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "report")
    items = eval_items(spark, folder)
    files.write_report(evaluate.mean_scores(items), items, path)
    return _rounded_scores(files.read_report(spark, f"{path}/scores"))


def _rounded_scores(scores: DataFrame) -> DataFrame:
    return scores.withColumn("score", F.round("score", 6))


@query
def index_write_read(spark: SparkSession, folder: str) -> DataFrame:
    """Two ingest runs side by side: every chunk is there twice, under different ids."""
    path = fresh_path(spark, "index")
    documents = inputs.transcripts(spark, folder)
    index.write_index(documents, path, HOOKS.embedder, SETTINGS, recreate=True, run="0")
    index.write_index(documents, path, HOOKS.embedder, SETTINGS, run="1")
    chunks = index.read_index(spark, path, SETTINGS).chunks
    return chunks.groupBy("source").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("chunk_id").alias("n_ids"),
        F.count_distinct("child", "chunk_no").alias("n_chunks"),
    )


@query
def index_fingerprint_check(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "index")
    index.write_index(
        inputs.transcripts(spark, folder), path, HOOKS.embedder, SETTINGS, recreate=True, run="0"
    )
    try:
        index.read_index(spark, path, replace(SETTINGS, embed_model="another"))
        refused = False
    except index.EmbedderMismatchError:
        refused = True
    stored = index.read_index(spark, path, SETTINGS).chunks
    return stored.agg(F.count("*").alias("n_chunks")).withColumn("refused", F.lit(refused))


@query
def vector_dim_check(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return index.wrong_dimensions(vectors, 64).agg(F.count("*").alias("wrong"))


# ---- chunking ----------------------------------------------------------------


@query
def markdown_sections(spark: SparkSession, folder: str) -> DataFrame:
    sections = chunking.markdown_sections(F.col("text"))
    return (
        inputs.transcripts(spark, folder)
        .select("source", F.posexplode(sections).alias("section_no", "s"))
        .select("source", "section_no", "s.title", "s.body")
    )


@query
def recursive_split(spark: SparkSession, folder: str) -> DataFrame:
    pieces = chunking.recursive_split(F.col("text"), SPLIT_SIZE)
    return inputs.documents(spark, folder).select(
        "source", F.posexplode(pieces).alias("piece_no", "piece")
    )


@query
def chunk_overlap(spark: SparkSession, folder: str) -> DataFrame:
    lines = chunking.add_overlap(F.split("text", "\n", -1), DEFAULTS.chunk_overlap)
    return inputs.documents(spark, folder).select(
        "source", F.posexplode(lines).alias("chunk_no", "chunk")
    )


@query
def plain_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.documents(spark, folder).select(
        "source", F.posexplode(chunking.plain_chunks(F.col("text"))).alias("chunk_no", "chunk")
    )


@query
def parent_child_chunks(spark: SparkSession, folder: str) -> DataFrame:
    chunks = index.chunk_documents(corpus(spark, folder), SETTINGS, with_parent=True)
    return chunks.select("source", "chunk_no", "child", "parent", "title")


@query
def ingest_counts_by_source(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks per origin of the documents, counted from the stored index."""
    return index.ingest_counts(corpus_index(spark, folder).chunks)


@query
def ingest_counts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same ingest as a stream of transcript files."""
    root, path = fresh_path(spark, "arriving"), fresh_path(spark, "index")
    inputs.transcripts(spark, folder).write.parquet(root)
    arriving = spark.readStream.schema("source string, text string").parquet(root)
    ingest_stream.start_ingest(
        arriving, path, fresh_path(spark, "progress"), HOOKS.embedder, SETTINGS
    ).awaitTermination()
    return index.ingest_counts(index.read_index(spark, path, SETTINGS).chunks)


# ---- retrieval ---------------------------------------------------------------


@query
def embed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The nonzero entries of each document's vector."""
    vectors = inputs.documents(spark, folder).select(
        "source", HOOKS.embedder(F.col("text")).alias("v")
    )
    return (
        vectors.select("source", F.posexplode("v").alias("dim", "weight"))
        .filter(F.col("weight") != 0)
        .select("source", "dim", F.round(F.col("weight").cast("double"), 5).alias("weight"))
    )


def _label_means(vectors: DataFrame) -> DataFrame:
    """One query per label: the mean of its vectors."""
    return (
        vectors.select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("c"))
        .select(F.col("label").alias("question_id"), F.col("c.x").alias("embedding"))
    )


def _nearest(spark: SparkSession, folder: str, k: int) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return vector_top_k(
        vectors.select(F.col("vec_id").alias("chunk_id"), "embedding"),
        _label_means(vectors), k, replace(SETTINGS, embed_dim=64),
    )


@query
def vector_top_k_(spark: SparkSession, folder: str) -> DataFrame:
    return _nearest(spark, folder, 5)


@query
def rerank_top_n_(spark: SparkSession, folder: str) -> DataFrame:
    """Rerank 20 candidates by a scorer that prefers vectors with the query's own label."""
    pool = _nearest(spark, folder, 20).join(
        table(spark, folder, "embeddings").select(F.col("vec_id").alias("chunk_id"), "label"),
        "chunk_id",
    )
    own = H.Hook(lambda q, c: F.when(q == c, 1.0).otherwise(-1.0), costly=False)
    pairs = pool.withColumn("query", F.col("question_id")).withColumn("child", F.col("label"))
    ranked = rerank_top_n(with_rerank_score(pairs, own), 5)
    return ranked.select("question_id", "chunk_id", "score", "rerank_score", "final_rank")


@query
def lexical_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Word-statistics score of every first-stage candidate."""
    pairs = scored_candidates(_asked(spark, folder), corpus_index(spark, folder), HOOKS, SETTINGS)
    return pairs.select("question_id", "source", "chunk_id", "cosine_rank", "score", "rerank_score")


@query
def two_stage_retrieve(spark: SparkSession, folder: str) -> DataFrame:
    hits = question_hits(spark, folder).select("question_id", F.posexplode("hits").alias("place", "h"))
    return hits.select(
        "question_id", (F.col("place") + 1).alias("place"), "h.chunk_id", "h.text", "h.score",
        "h.source", "h.parent", "h.title", "h.rerank_score",
    )


@query
def top_score(spark: SparkSession, folder: str) -> DataFrame:
    return question_hits(spark, folder).select("question_id", best_score(F.col("hits")).alias("top_score"))


@query
def context_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return question_hits(spark, folder).select("question_id", context(F.col("hits")).alias("context"))


@query
def grade_retrieval(spark: SparkSession, folder: str) -> DataFrame:
    graded = correct.grade(question_hits(spark, folder), HOOKS.grade_judge, SETTINGS.grade_gate)
    return graded.select("question_id", "top_score", "grade.relevant", "grade.reason", "grade.used_llm")


def _corrected(spark: SparkSession, folder: str) -> DataFrame:
    questions = inputs.benchmark_questions(spark, folder)
    return once(
        spark, folder, "corrected",
        lambda: materialize(
            correct.corrected_hits(questions, corpus_index(spark, folder), HOOKS, SETTINGS),
            "corrected",
        ),
    )


def _flat(found: DataFrame) -> DataFrame:
    return found.select(
        "question_id", "top_score", "correction.attempts", "correction.graded_relevant",
        "correction.grade_reason", "correction.rewritten_query",
        F.array_join("hits.chunk_id", ",").alias("hit_ids"),
    )


@query
def correction_loop(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_corrected(spark, folder))


@query
def linear_answers(spark: SparkSession, folder: str) -> DataFrame:
    questions = inputs.benchmark_questions(spark, folder)
    found = correct.linear_hits(questions, corpus_index(spark, folder), HOOKS, SETTINGS)
    answer = HOOKS.generator(F.col("question"), F.col("hits"))
    return found.select("question_id", "top_score", "correction.attempts", answer.alias("text"))


@query
def grounded_prompts_(spark: SparkSession, folder: str) -> DataFrame:
    return grounded_prompts(question_hits(spark, folder)).select("question_id", "prompt")


# ---- routing and statement audit ---------------------------------------------


@query
def route_questions(spark: SparkSession, folder: str) -> DataFrame:
    log = inputs.statement_log(spark, folder)
    return statements.route_questions(log, HOOKS.classifier).select("event_id", "route")


@query
def strip_sql_fences(spark: SparkSession, folder: str) -> DataFrame:
    log = inputs.statement_log(spark, folder)
    return log.select("event_id", sqlscreen.strip_fences(F.col("raw_sql")).alias("sql"))


@query
def validate_sql_log(spark: SparkSession, folder: str) -> DataFrame:
    log = statements.validate(inputs.statement_log(spark, folder))
    return log.select("event_id", "valid", "sql", "error")


@query
def execution_check_log(spark: SparkSession, folder: str) -> DataFrame:
    error = sqlscreen.execution_error(F.col("raw_sql"))
    return inputs.statement_log(spark, folder).select(
        "event_id", error.isNull().alias("executable"), error.alias("error")
    )


@query
def guarded_select(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder)
    return statements.run_select(
        spark,
        "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey;",
        SETTINGS.sql_max_rows,
    )


@query
def risk_flags(spark: SparkSession, folder: str) -> DataFrame:
    valid = statements.validate(inputs.statement_log(spark, folder)).filter("valid")
    return statements.with_risk(valid, SETTINGS).select(
        "event_id", "risky", F.array_join("reasons", "; ").alias("reasons"),
        sqlscreen.risk_summary(F.col("reasons")).alias("summary"),
    )


def _statement_requests(spark: SparkSession, folder: str) -> DataFrame:
    log = inputs.statement_log(spark, folder)
    return log.select(F.col("event_id").alias("request_id"), "question", "raw_sql")


@query
def structured_branch_status(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder)
    return statements.structured_branch(_statement_requests(spark, folder), SETTINGS).select(
        "request_id", "sql", "text", "row_count", "status", "risk_reason"
    )


def _ordered_text() -> Column:
    """`text`, but null where the statement leaves open which rows it returns."""
    return F.when(~F.coalesce(F.col("sql") == inputs.STATEMENTS[6], F.lit(False)) | (F.col("status") == "denied"), F.col("text")).alias("text")


@query
def resumed_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Frozen statements of the log, decided by the ledger state of the user who asked."""
    register_views(spark, folder)
    log = _statement_requests(spark, folder)
    risky = statements.with_risk(statements.validate(log), SETTINGS).filter("valid and risky")
    users = table(spark, folder, "events").select(F.col("event_id").alias("request_id"), "user_id")
    state = ledger.resolve(_approvals(spark, folder)).select(
        F.col("request_id").alias("user_id"), "status"
    )
    decisions = users.join(state, "user_id").select("request_id", "status")
    resumed = statements.resume_decided(risky, decisions, SETTINGS)
    return firewall.output_firewall(resumed).select(
        "request_id", "status", "row_count", "risk_reason", _ordered_text(),
    )


@query
def count_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return figures.count_filtered(table(spark, folder, "orders"), F.col("o_orderstatus") == "F")


@query
def count_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return figures.count_per_group(table(spark, folder, "customer"), "c_mktsegment")


@query
def avg_per_group(spark: SparkSession, folder: str) -> DataFrame:
    found = figures.avg_per_group(table(spark, folder, "customer"), "c_mktsegment", "c_acctbal")
    return found.withColumn("avg_value", F.round("avg_value", 6))


@query
def median_per_group(spark: SparkSession, folder: str) -> DataFrame:
    found = figures.median_per_group(table(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice")
    return found.withColumn("median_value", F.round("median_value", 6))


@query
def sum_per_group(spark: SparkSession, folder: str) -> DataFrame:
    found = figures.sum_per_group(table(spark, folder, "lineitem"), "l_returnflag", "l_quantity")
    return found.withColumn("sum_value", F.round("sum_value", 6))


@query
def arg_extreme_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    top = figures.arg_extreme_per_group(orders, "o_orderpriority", "o_totalprice", "o_orderkey")
    low = figures.arg_extreme_per_group(
        orders, "o_orderpriority", "o_totalprice", "o_orderkey", highest=False
    )
    return top.withColumn("which", F.lit("highest")).unionByName(
        low.withColumn("which", F.lit("lowest"))
    )


@query
def most_common_group(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    most = figures.most_common_group(customers, "c_nationkey")
    least = figures.most_common_group(customers, "c_nationkey", most=False)
    return most.withColumn("which", F.lit("most")).unionByName(
        least.withColumn("which", F.lit("least"))
    )


@query
def filtered_projection(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return figures.filtered_projection(
        orders, F.col("o_orderpriority") == "1-URGENT", "o_orderkey", "o_custkey", "o_totalprice"
    )


@query
def limited_projection(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return figures.first_rows(orders, 10, F.col("o_totalprice").desc(), F.col("o_orderkey"))


# ---- approvals ---------------------------------------------------------------


def _approvals(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.approval_events(table(spark, folder, "events"), SETTINGS)


@query
def approvals_current(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.latest_requests(_approvals(spark, folder)).drop("requested_at")


@query
def approvals_resolved(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.resolve(_approvals(spark, folder))


@query
def approvals_pending(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.pending(ledger.resolve(_approvals(spark, folder)))


@query
def approval_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer key as an id to look up; most have no request."""
    ids = table(spark, folder, "customer").select(F.col("c_custkey").alias("request_id"))
    return ledger.lookup(ledger.resolve(_approvals(spark, folder)), ids)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )


def _by_time(events: DataFrame, parts: int) -> list[DataFrame]:
    """Rows of successive spans of time, all of the same length."""
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).head()
    place = F.least(F.floor(
        parts * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(ends["first"]).cast("timestamp")))
        / F.greatest(F.unix_micros(F.lit(ends["last"]).cast("timestamp")) - F.unix_micros(F.lit(ends["first"]).cast("timestamp")), F.lit(1))
    ), F.lit(parts - 1))
    return [events.filter(place == i) for i in range(parts)]


@query
def approvals_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The log arrives in three parts; after each, the stream picks up where it stopped."""
    register_views(spark, folder)
    source, path, progress = (fresh_path(spark, label) for label in ("arriving", "ledger", "progress"))
    log = table(spark, folder, "events")
    for part in _by_time(log, 3):
        part.write.mode("append").parquet(source)
        events = inputs.approval_events(spark.readStream.schema(log.schema).parquet(source), SETTINGS)
        ledger_stream.start_ledger(
            events, path, progress, lambda decided: statements.answer_decided(decided, SETTINGS)
        ).awaitTermination()
    columns = "request_id", "created_at", "question", "sql", "reasons", "status"
    waiting = ledger_stream.open_requests(spark, path).withColumns(
        {"created_at": F.col("at.ts"), "status": F.lit("pending"), "text": F.lit(None).cast("string"),
         "row_count": F.lit(None).cast("int")}
    )
    answered = ledger_stream.decided_requests(spark, path).withColumn("created_at", F.col("requested_at.ts"))
    return answered.select(*columns, _ordered_text(), "row_count").unionByName(
        waiting.select(*columns, "text", "row_count")
    )


# ---- guardrails --------------------------------------------------------------


@query
def detect_injection(spark: SparkSession, folder: str) -> DataFrame:
    found = firewall.detect_injection(inputs.statement_log(spark, folder), "question")
    return found.select("event_id", F.array_join("injection", "; ").alias("injection"))


@query
def detect_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = firewall.detect_toxicity(inputs.document_rows(spark, folder))
    return found.select("doc_id", F.array_join("toxicity", "; ").alias("toxicity"))


@query
def mask_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = firewall.mask_pii(inputs.document_rows(spark, folder))
    return found.select("doc_id", "text", F.array_join("pii_found", ",").alias("pii_found"))


@F.pandas_udf(T.BooleanType())
def _mentions_leave(text: pd.Series) -> pd.Series:
    return text.str.contains("leave policy", case=False, regex=False)


@query
def judge_second_opinion(spark: SparkSession, folder: str) -> DataFrame:
    """A stand-in judge, asked only about questions the patterns let through."""
    judge = H.Hook(lambda text: _mentions_leave(F.lower(text)))
    log = inputs.statement_log(spark, folder).select("event_id", "question")
    found = firewall.detect_injection(log, "question", judge)
    return found.select("event_id", F.array_join("injection", "; ").alias("injection"))


@query
def input_firewall(spark: SparkSession, folder: str) -> DataFrame:
    found = firewall.input_firewall(inputs.statement_log(spark, folder), "question", SETTINGS)
    return found.select("event_id", "allowed", F.array_join("reasons", "; ").alias("reasons"))


@query
def output_firewall(spark: SparkSession, folder: str) -> DataFrame:
    found = firewall.output_firewall(inputs.document_rows(spark, folder))
    return found.select(
        "doc_id", "text", "pii_masked", "toxic", F.array_join("findings", "; ").alias("findings")
    )


def batch_questions(spark: SparkSession, folder: str) -> DataFrame:
    """The whole question log, and the benchmark passages under negative ids."""
    log = inputs.statement_log(spark, folder).select(
        F.col("event_id").alias("question_id"), "question", "raw_sql"
    )
    passages = inputs.benchmark_questions(spark, folder).select(
        (-1 - F.col("question_id")).alias("question_id"), "question",
        F.lit(None).cast("string").alias("raw_sql"),
    )
    return log.unionByName(passages)


def _answered(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder)
    return answer_batch(
        batch_questions(spark, folder), corpus_index(spark, folder), HOOKS, SETTINGS
    )


@query
def answer_batch_(spark: SparkSession, folder: str) -> DataFrame:
    return _answered(spark, folder).select(
        "question_id", "route", "status", "text", "row_count", "risk_reason", "pii_masked",
        F.array_join("guard_findings", "; ").alias("guard_findings"),
        "correction.attempts", "top_score",
    )


# ---- evaluation --------------------------------------------------------------


def _eval_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Answers with and without hits: the corrected benchmark, and the statement log."""
    from_documents = _corrected(spark, folder).select(
        "question_id", "question",
        HOOKS.generator(F.col("question"), F.col("hits")).alias("text"),
        "hits", F.lit(None).cast("string").alias("sql"), F.lit("documents").alias("route"),
    )
    log = statements.validate(inputs.statement_log(spark, folder))
    from_tables = log.select(
        (-1 - F.col("event_id")).alias("question_id"), "question", F.col("question").alias("text"),
        F.expr(NO_HITS).alias("hits"), "sql", F.lit("structured").alias("route"),
    )
    return from_documents.unionByName(from_tables)


@query
def eval_context(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.with_context(_eval_answers(spark, folder)).select("question_id", "context")


@query
def eval_judgements(spark: SparkSession, folder: str) -> DataFrame:
    items = evaluate.judged_items(_eval_answers(spark, folder), HOOKS)
    return items.select("question_id", *[(F.col(m) == 1).alias(m) for m in evaluate.METRICS])


@query
def eval_items(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.judged_items(_eval_answers(spark, folder), HOOKS)


@query
def eval_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_scores(evaluate.mean_scores(eval_items(spark, folder)))


# ---- answer-log metrics ------------------------------------------------------


def _answer_log(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.answer_log(table(spark, folder, "events"))


@query
def requests_by_route_status(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.requests_by_route_status(_answer_log(spark, folder))


@query
def latency_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.latency_histogram(_answer_log(spark, folder))


@query
def top_score_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.top_score_histogram(_answer_log(spark, folder))


@query
def guard_event_counts(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.guard_event_counts(_answer_log(spark, folder))


@query
def request_rate_5m(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.request_rate(_answer_log(spark, folder))


@query
def latency_p95_5m(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.latency_quantile(_answer_log(spark, folder))


@query
def requests_by_route(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.requests_by_route(_answer_log(spark, folder))


@query
def eval_gauges(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard's view of the latest stored report."""
    path = fresh_path(spark, "report")
    items = eval_items(spark, folder)
    files.write_report(evaluate.mean_scores(items), items, path)
    return _rounded_scores(files.read_report(spark, f"{path}/scores"))


def _streamed(spark: SparkSession, folder: str, metrics: Callable[[DataFrame], DataFrame]) -> DataFrame:
    path = fresh_path(spark, "metrics")
    result = metrics(inputs.answer_log(_event_stream(spark, folder)))
    rate_stream.start(result, path, fresh_path(spark, "progress")).awaitTermination()
    return spark.read.schema(result.schema).parquet(path)


@query
def request_rate_5m_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, rate_stream.request_rate_stream)


@query
def latency_p95_5m_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, rate_stream.latency_quantile_stream)


@query
def request_counts_stream(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, rate_stream.request_counts_stream)
