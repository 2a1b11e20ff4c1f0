"""Calling a model only for the rows that need it."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.hooks import Hook
from docquery.shared import materialize


def decide(
    rows: DataFrame, settled: Column, otherwise: Column, hook: Hook, inputs: list[Column], name: str
) -> DataFrame:
    """Add `name`: `otherwise` where `settled`, else what `hook` returns.

    A cheap hook is one conditional column. A costly one is called on the open rows
    only: the table is written out once, so that both halves read the same rows, and
    split, since a conditional would still evaluate a Python UDF for every row.
    """
    is_settled = F.coalesce(settled, F.lit(False))
    if not hook.costly:
        return rows.withColumn(name, F.when(is_settled, otherwise).otherwise(hook(*inputs)))
    stored = materialize(rows, "gated")
    done = stored.filter(is_settled).withColumn(name, otherwise)
    judged = stored.filter(~is_settled).withColumn(name, hook(*inputs))
    return done.unionByName(judged)
