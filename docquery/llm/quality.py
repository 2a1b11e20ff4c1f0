"""Document quality by a sparse rule ensemble that is compiled into column expressions.

Shallow trees are grown on statistics of labelled texts; each path from a root is a conjunctive
rule; a lasso logistic regression over all rules keeps few of them with their weights; the score
is a column expression over the statistics, which are column expressions over the text.

Defined cases: a null text is empty; an empty text has zero statistics and the score that these
give; equal texts get equal scores; without labels of both classes every score is the share of
good labels (1 if there are none); columns other than the text are not used; a table without rows
gives none.
"""
from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.llm.labels import sampled_labels
from docquery.shared import materialize

# The classifier is fitted on at most so many labelled documents of each class.
SAMPLE = {0: 5000, 1: 10000}
FOLDS, HELD_OUT = 3, 1

TREES, DEPTH, SEED = 24, 3, 7
LASSO = 0.002
# Rules with smaller weights than this are dropped.
LEAST_WEIGHT = 1e-3

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _less(text: Column, letters: str) -> Column:
    """How many characters of `text` are in `letters`."""
    return F.char_length(text) - F.char_length(F.translate(text, letters, ""))


def statistics(text: Column) -> Column:
    """Statistics of a whole text, as one struct of doubles."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line != "")
    known = F.struct(
        F.char_length(text).alias("chars"), F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("distinct_words"),
        F.size(lines).alias("lines"), F.size(F.array_distinct(lines)).alias("distinct_lines"),
        _less(text, "#*$%&<>").alias("symbols"), _less(text, "|").alias("bars"),
        _less(text, "!?").alias("marks"), _less(text, ".,;:").alias("stops"),
        _less(text, UPPER).alias("upper"), _less(text, "0123456789").alias("digits"),
    )

    def shares(k: Column) -> Column:
        per = lambda a, b: k[a].cast("double") / F.greatest(k[b], F.lit(1))
        return F.struct(
            F.log1p(k["words"].cast("double")).alias("log_words"),
            per("chars", "words").alias("chars_per_word"),
            per("distinct_words", "words").alias("distinct_word_share"),
            per("distinct_lines", "lines").alias("distinct_line_share"),
            per("words", "lines").alias("words_per_line"),
            per("symbols", "words").alias("symbols_per_word"),
            per("bars", "words").alias("bars_per_word"),
            per("marks", "words").alias("marks_per_word"),
            per("stops", "words").alias("stops_per_word"),
            per("upper", "chars").alias("upper_share"),
            per("digits", "chars").alias("digit_share"),
        )

    # The counts are bound once: `transform` over one element is how an expression names a value.
    return F.get(F.transform(F.array(known), shares), F.lit(0))


@dataclass(frozen=True)
class Rule:
    """A conjunction of `(statistic, is it at most the bound, bound)`."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self, stats: Column) -> Column:
        holds = F.lit(True)
        for name, at_most, bound in self.terms:
            holds = holds & (stats[name] <= bound if at_most else stats[name] > bound)
        return holds


def _simplified(terms: list[tuple[str, bool, float]]) -> Rule:
    """Keep the tightest bound of each statistic and direction."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, at_most, bound in terms:
        tighter = min if at_most else max
        bounds[name, at_most] = tighter(bounds.get((name, at_most), bound), bound)
    return Rule(tuple(sorted((n, a, b) for (n, a), b in bounds.items())))


def tree_rules(root, names: list[str]) -> set[Rule]:
    """The rule of each node below the root of a fitted tree."""
    found: set[Rule] = set()
    todo = [(root, [])]
    while todo:
        node, terms = todo.pop()
        if terms:
            found.add(_simplified(terms))
        if node.subtreeDepth():
            split = node.split()
            name, bound = names[split.featureIndex()], split.threshold()
            todo.append((node.leftChild(), [*terms, (name, True, bound)]))
            todo.append((node.rightChild(), [*terms, (name, False, bound)]))
    return found


@dataclass
class QualityModel:
    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self, stats: Column) -> Column:
        """The score of a `statistics` struct."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def to_json(self) -> str:
        return json.dumps({"intercept": self.intercept, "rules": [[r.terms, w] for r, w in self.rules]})


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> QualityModel:
    """Fit on a sample of at most `SAMPLE` labelled documents, all outside the held-out fold."""
    sample, sizes = sampled_labels(labels, "quality", HELD_OUT, FOLDS, SAMPLE, key)
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 1.0
    chosen = docs.select(key, text).join(F.broadcast(sample), key)
    stored = materialize(chosen.select("label", statistics(F.col(text)).alias("s")).select("label", "s.*"), "sample")
    names = [c for c in stored.columns if c != "label"]
    drawn = {row["label"]: row["n"] for row in stored.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(drawn) < 2:
        edge = min(max(share, 1e-6), 1 - 1e-6)
        return QualityModel(math.log(edge / (1 - edge)))
    weight = F.lit(0.0)
    for label, n in drawn.items():
        weight = F.when(F.col("label") == label, F.lit(sizes[label] / n)).otherwise(weight)
    # Sorted into one small partition, so that the fit is the same each time.
    rows = stored.coalesce(1).sortWithinPartitions(*stored.columns).withColumn("weight", weight)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select(
        "label", "weight", "features"
    ).cache()
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        featureSubsetStrategy="onethird",
    ).fit(vectors)
    found = sorted(set().union(*[tree_rules(t._call_java("rootNode"), names) for t in forest.trees]), key=repr)
    vectors.unpersist()
    stats = F.struct(*[F.col(n) for n in names])
    held = rows.select("label", "weight", stats.alias("s"))
    flags = held.select(
        "label", "weight", *[r.column(F.col("s")).cast("double").alias(f"r{i}") for i, r in enumerate(found)]
    )
    inputs = [f"r{i}" for i in range(len(found))]
    lasso = LogisticRegression(
        labelCol="label", featuresCol="features", weightCol="weight", elasticNetParam=1.0, regParam=LASSO,
        standardization=False, maxIter=60,
    ).fit(VectorAssembler(inputCols=inputs, outputCol="features").transform(flags).select("label", "weight", "features"))
    weights = lasso.coefficients.toArray()
    kept = [(r, float(w)) for r, w in zip(found, weights) if abs(w) >= LEAST_WEIGHT]
    return QualityModel(float(lasso.intercept), kept)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """`docs` with a score column added; a clashing column of that name is replaced."""
    named = docs.withColumn("__stats", statistics(F.col(text)))
    return named.withColumn(score, model.score(F.col("__stats"))).drop("__stats")
