"""The question families a data question falls into, as DataFrame operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from docquery.shared import hot_keys, join_around_hot, materialize


def count_filtered(rows: DataFrame, condition: Column) -> DataFrame:
    return rows.filter(condition).agg(F.count("*").alias("n"))


def count_per_group(rows: DataFrame, group: str) -> DataFrame:
    return rows.groupBy(group).agg(F.count("*").alias("n"))


def avg_per_group(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rows.groupBy(group).agg(F.avg(value).alias("avg_value"))


def sum_per_group(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rows.groupBy(group).agg(F.sum(value).alias("sum_value"))


def arg_extreme_per_group(rows: DataFrame, group: str, value: str, key: str, highest: bool = True) -> DataFrame:
    """The row key with the highest (lowest) value of each group; ties go to the smaller key.

    Aggregates, so each task sends one row per group instead of all its rows. Numbers need one; what
    cannot be negated, as dates and strings, is found first and its smallest key in a second one.
    """
    present = rows.filter(F.col(value).isNotNull())
    if highest and not isinstance(rows.schema[value].dataType, NumericType):
        top = present.groupBy(group).agg(F.max(value).alias("_top"))
        there = present.join(
            top.withColumnRenamed(group, "_group"),
            F.col(group).eqNullSafe(F.col("_group")) & (F.col(value) == F.col("_top")),
        )
        return there.groupBy(group).agg(F.min(key).alias(key), F.first("_top").alias(value))
    order = F.struct((-F.col(value) if highest else F.col(value)).alias("v"), F.col(key).alias("k"))
    best = present.groupBy(group).agg(F.min(order).alias("best"))
    found = -F.col("best.v") if highest else F.col("best.v")
    return best.select(group, F.col("best.k").alias(key), found.alias(value))


def most_common_group(rows: DataFrame, group: str, most: bool = True) -> DataFrame:
    """The group with the most (fewest) rows; ties go to the smaller name."""
    counts = count_per_group(rows, group)
    n = F.col("n").desc() if most else F.col("n").asc()
    return counts.orderBy(n, F.col(group)).limit(1)


def filtered_projection(rows: DataFrame, condition: Column, *columns: str) -> DataFrame:
    return rows.filter(condition).select(*columns)


def first_rows(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """A report of the first `n` rows in an order that leaves no ties."""
    return rows.orderBy(*order).limit(n)


# Share of a group's rows left on either side of its middle; distinct values that one task ranks at
# most; and how many ranges a round divides those of a group into that has more.
_BRACKET = 0.0001
MOST_RANKED = 100_000
_SPLITS = 200


def median_per_group(
    rows: DataFrame, group: str, value: str, hot_rows: int | None = None, most: int | None = None
) -> DataFrame:
    """Exact median of each group, without gathering a group in one task.

    A quantile sketch, merged from all tasks, brackets the middle of each group;
    its rank error is a tenth of the margin left on either side. Rows below the
    bracket are only counted. The few rows inside it are counted per value, and in
    a large group narrowed further in rounds, until at most `most` values of a group
    are left to be ranked, which gives the middle value or the mean of the two middle ones.
    """
    # A struct as the key, so that the group of nulls joins like any other.
    present = rows.select(
        F.struct(F.col(group).alias("of")).alias("g"), F.col(value).cast("double").alias("v")
    ).filter(F.col("v").isNotNull())
    edges = F.array(F.lit(0.5 - _BRACKET), F.lit(0.5 + _BRACKET))
    sketch = F.percentile_approx("v", edges, F.lit(int(10 / _BRACKET)))
    brackets = materialize(
        present.groupBy("g")
        .agg(sketch.alias("e"), F.count("*").alias("n"))
        .select("g", "n", F.get("e", F.lit(0)).alias("lo"), F.get("e", F.lit(1)).alias("hi")),
        "brackets",
    )
    placed = join_around_hot(present, brackets, "g", hot_keys(brackets, "g", hot_rows))
    # The values inside the bracket, plus one row per group for all that lies below it.
    slot = F.when(F.col("v") >= F.col("lo"), F.col("v"))
    counted = (
        placed.filter(F.col("v") <= F.col("hi"))
        .select("g", "n", slot.alias("slot"))
        .groupBy("g", "slot")
        .agg(F.count("*").alias("here"), F.max("n").alias("n"))
    )
    few = _narrowed(materialize(counted, "bracket"), MOST_RANKED if most is None else most, hot_rows)
    ranked = few.withColumn("upto", _upto("slot"))
    middle = ranked.groupBy("g").agg(
        F.max(F.when(_holds(_LOW), F.col("slot"))).alias("a"), F.max(F.when(_holds(_HIGH), F.col("slot"))).alias("b")
    )
    missed = F.raise_error("the middle of a group lies outside its bracket").cast("double")
    return middle.select(
        F.col("g.of").alias(group),
        F.when(F.col("a").isNull() | F.col("b").isNull(), missed)
        .otherwise((F.col("a") + F.col("b")) / 2).alias("median_value"),
    )


# The ranks of the two middle rows of `n`.
_LOW, _HIGH = "floor((n + 1) / 2)", "floor((n + 2) / 2)"


def _upto(order: str) -> Column:
    """Rows of the group up to and including those `here`."""
    return F.sum("here").over(Window.partitionBy("g").orderBy(F.col(order).asc_nulls_first()))


def _holds(rank: str) -> Column:
    return (F.col("upto") - F.col("here") < F.expr(rank)) & (F.expr(rank) <= F.col("upto"))


def _narrowed(counted: DataFrame, most: int, hot_rows: int | None = None) -> DataFrame:
    """The stored `(g, n, slot, here)` with at most `most` values a group, which still hold its middle.

    A round divides the values of a group at its own quantiles, each a range of its own, keeps the
    one or two ranges that hold the middle and adds what lies below to the row without a value.
    """
    done = None
    while True:
        sizes = materialize(counted.groupBy("g").agg(F.count("*").alias("n")), "sizes")
        wide = sizes.filter(F.col("n") > most + 1)
        if wide.head() is None:
            return counted if done is None else done.unionByName(counted)
        hot = hot_keys(sizes, "g", hot_rows)
        small = counted.join(sizes.filter(F.col("n") <= most + 1).select("g"), "g", "left_semi")
        done = small if done is None else done.unionByName(small)
        rest = counted.join(wide.select("g"), "g", "left_semi")
        shares = F.array(*[F.lit(i / _SPLITS) for i in range(_SPLITS + 1)])
        splits = materialize(
            rest.groupBy("g").agg(F.array_distinct(F.percentile_approx("slot", shares, F.lit(20 * _SPLITS))).alias("splits")),
            "splits",
        )
        below = F.size(F.filter("splits", lambda s: s < F.col("slot")))
        place = F.when(F.col("slot").isNull(), -1).otherwise(2 * below + F.array_contains("splits", F.col("slot")).cast("int"))
        placed = join_around_hot(rest, splits, "g", hot).select("g", "n", "slot", "here", place.alias("place"))
        # At most two rows per split of a group.
        ranges = placed.groupBy("g", "place").agg(F.sum("here").alias("here"), F.max("n").alias("n"))
        held = ranges.withColumn("upto", _upto("place")).filter(_holds(_LOW) | _holds(_HIGH))
        kept = materialize(
            held.groupBy("g").agg(
                F.min("place").alias("first"), F.max("place").alias("last"),
                F.min(F.col("upto") - F.col("here")).alias("before"), F.max("n").alias("n"),
            ),
            "kept",
        )
        inside = join_around_hot(placed, kept.drop("n"), "g", hot).filter(F.col("place").between(F.col("first"), F.col("last")))
        none = kept.filter("first > -1").select("g", "n", F.lit(None).cast("double").alias("slot"), F.col("before").alias("here"))
        counted = materialize(inside.select("g", "n", "slot", "here").unionByName(none), "bracket")
