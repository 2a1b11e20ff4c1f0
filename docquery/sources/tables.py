"""Relational tables as a source of text and of views for guarded statements."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_views(spark: SparkSession, folder: str) -> None:
    """Make the tables visible to statements; views only, nothing can be written."""
    for name in TABLES:
        table(spark, folder, name).createOrReplaceTempView(name)


def row_line(name: str, rows: DataFrame) -> Column:
    """`Name | col=value | col=value` of the non-null cells, null when there are none."""
    cells = [
        F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string")))
        for c in rows.columns
    ]
    filled = F.array_compact(F.array(*cells))
    return F.when(
        F.size(filled) > 0, F.concat_ws(" | ", F.lit(name), F.array_join(filled, " | "))
    )


def rows_to_text(rows: DataFrame, name: str, *keep: str) -> DataFrame:
    """One text line per row, with the columns of `keep` beside it."""
    text = row_line(name, rows)
    return rows.select(*keep, text.alias("line")).filter(F.col("line").isNotNull())
