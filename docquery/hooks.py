"""Model calls as column hooks, with deterministic offline defaults.

A hook takes columns and returns a column. `costly=True` marks one that leaves
the JVM or calls a model; the operators then run it only on the rows that need
it, by splitting the table instead of wrapping the call in a condition (a Python
UDF inside `when` would be evaluated for every row).
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.text import let, words
from docquery.settings import DEFAULTS


@dataclass(frozen=True)
class Hook:
    call: Callable[..., Column]
    costly: bool = True

    def __call__(self, *columns: Column) -> Column:
        return self.call(*columns)


def hashed_terms(dim: int = DEFAULTS.embed_dim) -> Hook:
    """Unit vectors of hashed words weighted `1 + ln(count)`.

    Works on whole Arrow batches: each distinct word of a batch is hashed once, and
    the counts of a block of rows are one flat histogram.
    """
    block = max(1, (8 << 20) // (8 * dim))

    def slots(distinct: pa.Array) -> np.ndarray:
        digests = (hashlib.md5(t.encode("utf-8")).hexdigest() for t in distinct.to_pylist())
        return np.fromiter((int(d[:8], 16) % dim for d in digests), np.int64, len(distinct))

    def unit_counts(rows: np.ndarray, found: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The filled places of `n` vectors, one after the other, and what they hold."""
        counts = np.bincount(rows * dim + found, minlength=n * dim)
        filled = np.flatnonzero(counts)
        weights = 1.0 + np.log(counts[filled])
        of = filled // dim
        norms = np.sqrt(np.bincount(of, weights * weights, minlength=n))
        return filled, (weights / norms[of]).astype(np.float32)

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(terms: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        words_ = pc.dictionary_encode(pc.list_flatten(terms))
        found = slots(words_.dictionary)[words_.indices.to_numpy(zero_copy_only=False)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.zeros(len(sizes) * dim, np.float32)
        for at in range(0, len(sizes), block):
            some = sizes[at : at + block]
            rows = np.repeat(np.arange(len(some)), some)
            filled, weights = unit_counts(rows, found[ends[at] : ends[at + len(some)]], len(some))
            flat[filled + at * dim] = weights
        offsets = np.arange(0, (len(sizes) + 1) * dim, dim, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return Hook(lambda text: embed(words(text)))


# ---- stand-ins that stay inside the JVM -------------------------------------


def _coverage(needle: Column, haystack: Column) -> Column:
    """Share of the distinct words of `needle` found in `haystack`; 0 without words."""
    return let(
        F.array_distinct(words(needle)),
        lambda n: F.when(F.size(n) == 0, F.lit(0.0)).otherwise(
            F.size(F.array_intersect(n, words(haystack))) / F.size(n)
        ),
    )


def covers(share: float) -> Hook:
    """Judge `(needle, haystack) -> bool`: enough of the words are there."""
    return Hook(lambda needle, haystack: _coverage(needle, haystack) >= share, costly=False)


def keyword_rewriter(min_length: int = 4) -> Hook:
    """Rewrite a question into its distinct longer words, in order."""
    return Hook(
        lambda question, hits: F.array_join(
            F.array_distinct(F.filter(words(question), lambda w: F.length(w) >= min_length)), " "
        ),
        costly=False,
    )


def extractive_generator() -> Hook:
    """Answer `(question, hits)` with the best passage and its source in brackets."""
    from docquery.functions.hits import NO_CONTEXT, passages

    def answer(question: Column, hits: Column) -> Column:
        best = F.get(passages(hits), F.lit(0))
        source = F.get(hits, F.lit(0))["source"]
        return F.when(
            F.size(hits) > 0, F.concat(best, F.lit(" ["), source, F.lit("]"))
        ).otherwise(F.lit(NO_CONTEXT))

    return Hook(answer, costly=False)


def always(value: str) -> Hook:
    return Hook(lambda *_: F.lit(value), costly=False)


@dataclass(frozen=True)
class Hooks:
    """The full set of model calls of one deployment."""

    embedder: Hook
    scorer: Hook | None  # (query, child) -> raw logit; None uses word statistics
    grade_judge: Hook
    rewriter: Hook
    generator: Hook
    classifier: Hook
    injection_judge: Hook | None
    toxicity_judge: Hook | None
    faithfulness: Hook
    relevancy: Hook
    precision: Hook


def offline(dim: int = DEFAULTS.embed_dim) -> Hooks:
    return Hooks(
        embedder=hashed_terms(dim),
        scorer=None,
        grade_judge=covers(0.5),
        rewriter=keyword_rewriter(),
        generator=extractive_generator(),
        classifier=always("documents"),
        injection_judge=None,
        toxicity_judge=None,
        faithfulness=covers(0.8),
        relevancy=covers(0.3),
        precision=covers(0.5),
    )
