"""Time the headline queries and print one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "parent_child_chunks", "markdown_sections", "embed_documents", "vector_top_k", "lexical_scores",
    "two_stage_retrieve", "context_blocks", "grade_retrieval", "correction_loop",
    "mask_pii", "output_firewall", "detect_toxicity", "input_firewall", "validate_sql_log",
    "risk_flags", "structured_branch_status", "median_per_group", "arg_extreme_per_group",
    "approvals_resolved", "approvals_stream", "answer_batch", "eval_scores",
    "latency_histogram", "request_rate_5m", "latency_p95_5m", "request_rate_5m_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from docquery.plans.queries import QUERIES, corpus_index

    timings: dict[str, float] = {}
    started = time.time()
    corpus_index(spark, folder)
    timings["index_build"] = round(time.time() - started, 3)
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
