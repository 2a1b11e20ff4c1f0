"""A bounded sample of labelled documents, the only rows a classifier is fitted on.

Defined cases: rows without a key or with a label that is none of the classes are left out; a key
labelled twice keeps the larger label; a class without rows is absent from the sizes; an empty table gives none.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: Column, folds: int) -> Column:
    """The fold of a key: crc32 of its text modulo `folds`, null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def sampled_labels(
    labels: DataFrame, label: str, held_out: int, folds: int, most: dict[int, int], key: str = "doc_id"
) -> tuple[DataFrame, dict[int, int]]:
    """At most `most[c]` keys of each class outside the held-out fold, and the class sizes they stand for.

    The keys of smallest hash are taken, so the sample is the same each time. Keys labelled twice
    keep the larger label.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(*most)).groupBy(key).agg(
        F.max(label).cast("int").alias("label")
    ).filter(remainder(F.col(key), folds) != held_out)
    sizes = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draws = [
        known.filter(F.col("label") == c).orderBy(F.xxhash64(key), key).limit(n) for c, n in most.items()
    ]
    sample = draws[0]
    for other in draws[1:]:
        sample = sample.unionByName(other)
    return sample, sizes
