"""Text quality by regularised quadratic discriminant analysis over document statistics.

Some twenty statistics of a whole text (lengths, shares of kinds of characters, repetition, entropy) are transformed to
be roughly normal. Each class has a mean and a covariance, estimated from sums that are added up over all labelled rows
outside the held-out fold. The class covariance is shrunk towards the pooled one, the less rows the more, and both get
a share of the pooled variances on the diagonal. The score is the logistic function of the difference of log densities
plus that of the class shares, from Mahalanobis distances by Cholesky factors that are computed once.

Statistics are computed once per text and written; fit and scores read them. Labels, language, source and id are no
inputs of a score.

Defined cases: null texts are empty, and an empty text has statistics of zero; if a class has no labelled row, all
scores are 0.5.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import stage, text_of
from accountweave.llm.labels import fold, known

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
RIDGE = 0.05
_SPACE, _DIGIT, _UPPER, _LOWER = (np.zeros(256, bool) for _ in range(4))
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DIGIT[48:58] = True
_UPPER[65:91] = True
_LOWER[97:123] = True
_OTHER = ~(_SPACE | _DIGIT | _UPPER | _LOWER)
_OTHER[128:] = False
_USUAL = np.zeros(256, bool)
_USUAL[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = True


def _odds(share: float) -> float:
    """A share on a scale without ends."""
    return math.log((share + 0.002) / (1.002 - share))


def statistics(text: str) -> list[float]:
    data = np.frombuffer(text.encode(), np.uint8)
    count = np.bincount(data, minlength=256)
    n = max(1, len(data))
    words = text.split()
    lines = text.split("\n")
    m, k = max(1, len(words)), len(lines)
    often = Counter(words)
    threes = set(zip(words, words[1:], words[2:]))
    used = count[count > 0] / n
    letters = max(1, int(count[_UPPER].sum() + count[_LOWER].sum() + count[192:].sum()))
    sizes = [len(w) for w in often]
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        math.log1p(k),
        math.log1p(len(data) / k),
        math.log1p(len(text) / m),
        math.sqrt(np.var(sizes)) if sizes else 0.0,
        math.log1p(max(sizes, default=0)),
        _odds(count[_SPACE].sum() / n),
        _odds(count[_DIGIT].sum() / n),
        _odds(min(1.0, count[_UPPER].sum() / letters)),
        _odds(count[_OTHER & _USUAL].sum() / n),
        _odds(count[_OTHER & ~_USUAL].sum() / n),
        _odds(count[33] / n),
        _odds(count[124] / n),
        _odds(count[128:].sum() / n),
        _odds(count[46] / m if count[46] < m else 1.0),
        _odds(len(often) / m),
        _odds(max(often.values(), default=0) / m),
        _odds(1 - len(threes) / max(1, len(words) - 2) if len(words) > 2 else 0.0),
        _odds(1 - len(set(lines)) / k),
        float(-(used * np.log(used)).sum()) if len(data) else 0.0,
    ]


SIZE = len(statistics(""))


@dataclass(frozen=True)
class Model:
    """Per class (0, 1): mean, inverse of the Cholesky factor, and the constant part of the log density."""

    means: np.ndarray
    inverse: np.ndarray
    constant: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.means):
            return np.full(len(x), 0.5)
        density = []
        for mean, inverse, constant in zip(self.means, self.inverse, self.constant, strict=True):
            z = (x - mean) @ inverse.T
            density.append(constant - 0.5 * (z * z).sum(1))
        d = density[1] - density[0]
        # Far from both classes the order is kept and the ends are not reached.
        return 1 / (1 + np.exp(-d / (1 + np.abs(d) / 30)))


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, x`` of every whole text, written once."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    return stage(rows.mapInArrow(run, f"id {kind}, x array<double>"), "statistics")


def fit(measures: DataFrame, labels: DataFrame, ridge: float = RIDGE) -> Model:
    """From all labelled rows outside the held-out fold; the driver gets sums only, whose number is fixed."""
    rows = measures.join(known(labels, "quality", FOLDS, HELD_OUT).withColumnRenamed("label_id", "id"), "id").select("x", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + SIZE + SIZE * SIZE))
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(len(batch), SIZE)
            label = np.asarray(batch.column("label"))
            for k in (0, 1):
                own = x[label == k]
                sums[k] += np.r_[len(own), own.sum(0), (own.T @ own).ravel()]
        at = np.arange(sums.size)
        yield pa.record_batch([pa.array(at // sums.shape[1], pa.int32()), pa.array(at % sums.shape[1], pa.int32()), pa.array(sums.ravel())], names=["label", "at", "s"])

    sums = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for r in rows.mapInArrow(run, "label int, at int, s double").groupBy("label", "at").agg(F.sum("s").alias("s")).collect():
        sums[r.label, r["at"]] = r.s
    n = sums[:, 0]
    if (n < 1).any():
        return Model(*(np.zeros(0) for _ in range(3)))
    means = sums[:, 1 : 1 + SIZE] / n[:, None]
    scatter = sums[:, 1 + SIZE :].reshape(2, SIZE, SIZE) / n[:, None, None] - np.einsum("ki,kj->kij", means, means)
    pooled = np.einsum("k,kij->ij", n / n.sum(), scatter)
    diagonal = np.diag(np.diag(pooled) + 1e-6)
    inverse, constant = [], []
    for k in (0, 1):
        towards = SIZE / (SIZE + n[k])
        covariance = (1 - ridge) * ((1 - towards) * scatter[k] + towards * pooled) + ridge * diagonal
        factor = np.linalg.cholesky(covariance)
        inverse.append(np.linalg.inv(factor))
        constant.append(math.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Model(means, np.array(inverse), np.array(constant))


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    measures = measured(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(fit(measures, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(len(batch), SIZE)
            yield pa.record_batch([batch.column("id"), pa.array(shared.value.score(x))], names=["id", "score"])

    return measures.mapInArrow(run, f"id {measures.schema['id'].dataType.simpleString()}, score double")
