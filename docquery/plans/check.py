"""Compare registered queries with their DuckDB restatement: `python -m docquery.plans.check DIR [name …]`."""
from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from docquery.plans.oracles import SQL
from docquery.plans.queries import QUERIES
from docquery.sources.tables import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return repr(value)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    rows = [tuple(_cell(r[c]) for c in columns) for r in df.select(*columns).collect()]
    return columns, sorted(rows, key=str)


def duckdb_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=str)


def compare(spark: SparkSession, con, folder: str, name: str) -> str:
    """An empty string when both sides agree, else what differs first."""
    columns, rows = spark_rows(QUERIES[name](spark, folder))
    expected_columns, expected = duckdb_rows(con, SQL[name])
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    return f"{len(wrong)} rows differ, first {str(wrong[0])[:700]}" if wrong else ""


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, folder, name) if name in SQL else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        print(f"{name:28s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
