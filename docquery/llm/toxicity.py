"""Toxicity by compression distance: which of two zstandard dictionaries explains a window better.

One dictionary is trained on what toxic documents have and ordinary ones lack, the other on
ordinary documents. A window is a word, lower-cased, in a frame of fixed text that both
dictionaries know, so that the fixed costs of a frame cancel out. What a window adds to the
compressed length under each dictionary gives a cell (difference, toxic length); thresholds and
weights of the cells are calibrated on the labelled sample, and a logistic curve over a document's
strongest windows gives the score.

Defined cases: a null or empty text has no windows and gets the score of a text without evidence;
repeated words count once; rows with equal texts get equal scores; without labels of both classes
every score is the share of toxic labels (0 if there are none); columns other than the key and the
text are not used; a table without rows gives none.
"""
from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.llm.labels import sampled_labels
from docquery.llm.memory import Recent, received, send

# The classifier is fitted on at most so many labelled documents of each class.
SAMPLE = {0: 6000, 1: 2000}
FOLDS, HELD_OUT = 5, 0

FRAME = b" <<<window of words>>> "
EDGES = b".,!?;:*$%&#|()\"'"
LEVEL = 19
ORDINARY_BYTES, TOXIC_BYTES = 64 << 10, 4 << 10
# A word is typical of toxic text when it is in so many toxic documents, so many times as often.
LEAST_DOCUMENTS, LEAST_RATIO, LEAST_LETTERS = 3, 8, 3
STRONGEST = 10
MOST_REMEMBERED = 300_000

Cell = tuple[int, int]


def windows(text: str) -> set[bytes]:
    return {w.strip(EDGES) for w in text.lower().encode().split()} - {b""}


def _train(samples: list[bytes], size: int, **shape: int) -> bytes:
    """Bytes of a trained dictionary; too few samples to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples, **shape).as_bytes() + FRAME
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] + FRAME


@dataclass
class Distance:
    """The two dictionaries, as a function from a window to its cell."""

    ordinary: bytes
    toxic: bytes

    def __post_init__(self):
        self._pair = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                write_content_size=False, write_dict_id=False, write_checksum=False,
            )
            for d in (self.ordinary, self.toxic)
        ]
        self._fixed = [len(c.compress(FRAME + FRAME)) for c in self._pair]

    def cell(self, window: bytes) -> Cell:
        framed = FRAME + window + FRAME
        ordinary, toxic = (len(c.compress(framed)) - n for c, n in zip(self._pair, self._fixed))
        return min(max(ordinary - toxic, -3), 8), min(toxic, 12)


def _features(weights: Iterable[float], n_words: int) -> list[float]:
    top = heapq.nlargest(STRONGEST, weights) + [0.0] * 3
    return [1.0, top[0], top[1], top[2], sum(top), math.log1p(n_words)]


def _logistic(rows: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ridge logistic weights by Newton steps; each row counts as `counts` documents."""
    weights = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (counts * (p - labels)) + 1e-2 * weights
        bend = (rows * (counts * p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(len(weights))
        weights -= np.linalg.solve(bend, slope)
    return weights


@dataclass
class ToxicityModel:
    ordinary: bytes = b""
    toxic: bytes = b""
    cells: dict[Cell, float] = field(default_factory=dict)
    curve: tuple[float, ...] = ()
    share: float = 0.0

    def scorer(self):
        """A function from texts to scores, which remembers the words it has seen."""
        if not self.curve:
            return lambda text: self.share
        distance = Distance(self.ordinary, self.toxic)

        def evidence(word: bytes):
            window = word.strip(EDGES)
            weight = self.cells.get(distance.cell(window), 0.0) if window else 0.0
            return (window, weight) if weight > 0 else False

        seen = Recent(MOST_REMEMBERED, evidence)

        def score(text: str) -> float:
            words = text.lower().encode().split()
            found = dict(filter(None, [seen[word] for word in set(words)]))
            z = sum(a * b for a, b in zip(self.curve, _features(found.values(), len(words))))
            return 1 / (1 + math.exp(-min(max(z, -30), 30)))

        return score


def fit(rows: list[tuple[set[bytes], int, int]], sizes: dict[int, int]) -> ToxicityModel:
    """Fit on `(windows, number of words, label)` of sampled documents that stand for `sizes` of each class."""
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    classes = {c: [r for r in rows if r[2] == c] for c in (0, 1)}
    if not all(classes.values()):
        return ToxicityModel(share=share)
    documents = {c: Counter(w for r in classes[c] for w in r[0]) for c in (0, 1)}
    ratio = len(classes[0]) / len(classes[1])
    typical = {
        w for w, n in documents[1].items()
        if n >= LEAST_DOCUMENTS and len(w) >= LEAST_LETTERS and n * ratio >= LEAST_RATIO * (documents[0][w] + 0.5)
    }

    def text(words: set[bytes]) -> bytes:
        return b" " + b" ".join(sorted(words, key=lambda w: (zlib.crc32(w), w))) + b" "

    ordinary = _train([text(r[0] - typical) for r in classes[0]], ORDINARY_BYTES, k=64, d=8)
    toxic = _train([text(r[0] & typical) for r in classes[1] if r[0] & typical], TOXIC_BYTES, k=16, d=6)
    distance = Distance(ordinary, toxic)
    cell = {w: distance.cell(w) for w in documents[0] | documents[1]}
    met = {c: Counter(x for r in classes[c] for x in {cell[w] for w in r[0]}) for c in (0, 1)}
    rate = lambda x, c: (met[c][x] + 1) / (len(classes[c]) + 2)
    cells = {x: math.log(rate(x, 1) / rate(x, 0)) for x in met[0] | met[1]}
    features = np.array([_features([v for w in r[0] if (v := cells[cell[w]]) > 0], r[1]) for r in rows])
    counts = np.array([sizes[r[2]] / len(classes[r[2]]) for r in rows])
    curve = _logistic(features, np.array([r[2] for r in rows]), counts)
    return ToxicityModel(ordinary, toxic, {x: v for x, v in cells.items() if v > 0}, tuple(curve), share)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        words = pa.array([sorted(windows(t)) for t in texts], pa.list_(pa.binary()))
        counts = pa.array([len(t.encode().split()) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([words, counts, batch.column(1)], names=["words", "n", "label"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Fit on a sample of at most `SAMPLE` labelled documents, all outside the held-out fold."""
    sample, sizes = sampled_labels(labels, "toxic", HELD_OUT, FOLDS, SAMPLE, key)
    chosen = docs.select(key, text).join(F.broadcast(sample), key).select(text, "label")
    found = chosen.mapInArrow(_windows, "words array<binary>, n long, label int").toArrow().to_pylist()
    # In an order of their own, so that the fit is the same however the rows arrive.
    rows = sorted(((set(r["words"]), r["n"], r["label"]) for r in found), key=lambda r: (r[1:], sorted(r[0])))
    return fit(rows, sizes)


def _scored(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    score = model.scorer()
    for batch in batches:
        scores = [score(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["key", "score"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, score, predicted)` of each row."""
    columns = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = columns.schema["key"].dataType.simpleString()
    sent = send(docs.sparkSession, model)
    scored = columns.mapInArrow(lambda b: _scored(b, received(sent)), f"key {kind}, score double")
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
