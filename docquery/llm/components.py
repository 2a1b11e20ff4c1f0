"""Connected components of a table of links, by alternating large and small stars.

Every step is an aggregate, a join and a distinct over the links, so no component is ever
gathered; the number of rounds grows with the logarithm of the largest component.

Defined cases: links with a null end join nothing; a link from a node to itself and repeated links
change nothing; a table without links gives no nodes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.shared import materialize


def _large(links: DataFrame) -> DataFrame:
    """Join each larger neighbour of a node to the smallest node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Stored, so that the join has a plain shuffle on both sides and can split the neighbours of a star's centre.
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them; `u` is the larger end."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).head()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` of every node in `links(u, v)`; the root is the smallest node reachable."""
    ends = F.least("u", "v"), F.greatest("u", "v")
    links = materialize(
        links.filter(F.col("u") != F.col("v")).select(ends[1].alias("u"), ends[0].alias("v")).distinct(), "links"
    )
    before = _state(links)
    while before[0]:
        links = materialize(_small(_large(links).distinct()).distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
