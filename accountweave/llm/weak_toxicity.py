"""Toxicity by weak supervision: many small voters, a generative label model, a linear classifier on its posteriors.

Voters. Words and word beginnings that are far more frequent in labelled toxic texts than chance allows are dealt over
``LISTS`` lexicons; each is a voter that fires if the text holds one of its entries. Pattern voters fire on how many
entries a text holds, on how dense they are, and on a fixed list of common insults.

Label model. Each voter has a chance to fire on toxic and one to fire on clean texts; both, and the share of toxic texts,
are estimated by expectation-maximisation over the sample. The label of a text is one more voter, right with a chance of
``TRUST``; it is the first guess, and keeps the estimate in place where few voters are independent. Voters that fire
together more than the class explains are correlated; each voter's evidence is divided by the sum of its correlations, so
that ten voters that see the same thing count as one. The posterior of each sampled text is its label from there on.

Classifier. A ridge logistic regression on which entries occur, how many and how densely, fitted to the posteriors. It
scores every whole text; labels, language, source and id are no inputs.

Only the fit is sampled: at most about ``SAMPLE`` labelled rows outside the held-out fold, taken by a hash of the id. Their
entries pass the driver as numbers, at most a few hundred per row.

Defined cases: null texts are empty; an empty text has no entry and scores as any text without; without labels the list
of insults is the only voter; without any text all scores are 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import stage, text_of
from accountweave.llm.labels import fold, known, sampled

SAMPLE = 20_000
ENTRIES, LISTS = 600, 24
#: Chance that a label is right.
TRUST = 0.95
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
#: Evidence of an insult that the labels don't show.
PLAIN = 3.0
BEGINNINGS = (3, 4, 5, 6, 7)
#: Insults that need no labels to be known.
INSULTS = frozenset("idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown clowns imbecile dumb filth".split())
_WORD = re.compile(r"[^\W\d_]+")


def entries(text: str) -> set[str]:
    """Distinct lower-case words, and their beginnings marked by a star."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for k in BEGINNINGS:
        out.update([w[:k] + "*" for w in words if len(w) > k])
    return out


def mine(texts: DataFrame, limit: int = ENTRIES) -> dict[str, float]:
    """The entries most typical of toxic texts and the evidence of each (log odds ratio); ``texts``: ``text, label``.

    Counts are combined within each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()

        def counts() -> pa.RecordBatch:
            terms = list(seen[1] | seen[0])
            out = pa.record_batch([pa.array(terms, pa.string()), *(pa.array([seen[k][t] for t in terms], pa.int64()) for k in (1, 0))], names=["term", "toxic", "clean"])
            seen[0].clear()
            seen[1].clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                seen[label].update(entries(text))
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield counts()
        yield counts()

    n = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return dict.fromkeys(sorted(INSULTS), PLAIN)
    terms = texts.select("text", "label").mapInArrow(run, "term string, toxic long, clean long")
    terms = stage(terms.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")), "terms")
    share = toxic / (toxic + clean)
    # Twice the log-likelihood ratio of a term's toxic share against the share of all.
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    gain = 2 * (a * F.log(a / ((a + b) * share)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0))
    least = 2 * (math.log(max(1, terms.count())) + 2)
    best = terms.where((a > 0) & (a >= 0.6 * (a + b))).withColumn("gain", gain).where(F.col("gain") > least)
    found = {r.term: math.log((r.a + 0.5) / (r.b + 0.5) * clean / toxic) for r in best.orderBy(F.desc("gain"), "term").limit(limit).collect()}
    return dict(sorted((dict.fromkeys(INSULTS, PLAIN) | found).items()))


@dataclass(frozen=True)
class Model:
    """``terms``: number of each entry; ``weights``: of each entry, then of the shape of the finds (``shape``)."""

    terms: dict[str, int]
    evidence: np.ndarray
    weights: np.ndarray

    def score(self, text: str) -> float:
        found, words = hits(text, self.terms)
        w = self.weights
        x = sum(w[i] for i in found) + shape(found, words, self.evidence) @ w[len(self.terms) :]
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, float(x)))))


def hits(text: str, terms: dict[str, int]) -> tuple[list[int], int]:
    """Entries of the lexicon in a text, and its number of words."""
    all_words = _WORD.findall(text.lower())
    words = set(all_words)
    found = [terms[w] for w in words if w in terms]
    for k in BEGINNINGS:
        starts = {w[:k] for w in words if len(w) > k}
        found += [terms[s + "*"] for s in starts if s + "*" in terms]
    return found, len(all_words)


def shape(found: list[int], words: int, evidence: np.ndarray) -> np.ndarray:
    """Strongest entry, number of entries, their density, and a constant."""
    n = len(found)
    return np.array([max((evidence[i] for i in found), default=0.0), math.log1p(n), min(1.0, n / (words + 10)), 1.0])


def votes(found: list[int], words: int, terms: dict[str, int]) -> np.ndarray:
    """Which voters fire."""
    names = list(terms)
    out = np.zeros(LISTS + 5)
    for i in found:
        out[xxhash.xxh3_64_intdigest(names[i]) % LISTS] = 1
    n, density = len(found), len(found) / (words + 10)
    out[LISTS:] = n >= 1, n >= 3, n >= 8, density >= 0.02, any(names[i] in INSULTS for i in found)
    return out


def label_model(fired: np.ndarray, guess: np.ndarray, trust: float = TRUST, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each row, chances to fire (clean, toxic) of each voter, and correlations of voters within classes."""
    q = guess.astype(float).clip(0.02, 0.98)
    given = (2 * guess - 1) * math.log(trust / (1 - trust))
    for _ in range(rounds):
        weight = np.stack([1 - q, q])
        mass = weight.sum(1)
        # Half a firing in each class: no voter is certain.
        chance = (weight @ fired + 0.5) / (mass[:, None] + 1)
        rest = fired - weight.T @ chance
        spread = np.sqrt((rest**2).mean(0) + 1e-9)
        together = (rest.T @ rest) / len(rest) / np.outer(spread, spread)
        np.fill_diagonal(together, 1)
        share = 1 / np.clip(together, 0, 1).sum(1)
        yes, no = np.log(chance[1] / chance[0]), np.log((1 - chance[1]) / (1 - chance[0]))
        prior = (mass[1] + 1) / (mass.sum() + 2)
        x = given + math.log(prior / (1 - prior)) + fired @ (share * yes) + (1 - fired) @ (share * no)
        q = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    return q, chance, together


def logistic(x: np.ndarray, q: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps; the last column is the constant and has no ridge."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (q - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> Model:
    given = known(labels, "toxic", FOLDS, HELD_OUT, "doc_id")
    total = given.count()
    share = min(1.0, sample / max(1, total))
    rows = docs.where((fold(id_column, FOLDS) != HELD_OUT) & sampled(F.col(id_column), share))
    rows = rows.select(F.col(id_column).alias("label_id"), text_of(text_column).alias("text"))
    if total:
        texts = rows.join(given.where(sampled(F.col("label_id"), share)), "label_id").select("text", "label")
    else:
        n = docs.count()
        texts = rows.where(sampled(F.xxhash64("label_id"), min(1.0, sample / max(1, n)))).select("text", F.lit(0).alias("label"))
    texts = stage(texts, "labelled-sample", compression="zstd")
    mined = mine(texts)
    terms, evidence = {t: i for i, t in enumerate(mined)}, np.array(list(mined.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [hits(t, terms) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [pa.array([sorted(f) for f, _ in own], pa.list_(pa.int32())), pa.array([w for _, w in own], pa.int64()), batch.column("label")], names=["found", "words", "label"]
            )

    table = texts.mapInArrow(run, "found array<int>, words long, label int").toPandas()
    if not len(table):
        return Model(terms, evidence, np.r_[np.zeros(len(terms) + 3), -40.0])
    fired = np.stack([votes(list(f), w, terms) for f, w in zip(table.found, table.words, strict=True)])
    guess = table.label.to_numpy(float)
    if not guess.any():
        guess = fired[:, -1]
    q, _, _ = label_model(fired, guess)
    x = np.zeros((len(table), len(terms) + 4))
    for i, (found, words) in enumerate(zip(table.found, table.words, strict=True)):
        x[i, list(found)] = 1
        x[i, len(terms) :] = shape(list(found), words, evidence)
    return Model(terms, evidence, logistic(x, q))


def scorer(docs: DataFrame, model: Model, text_column: str = "text") -> Column:
    """Score of each whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return score(text_of(text_column))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    return docs.where(scorer(docs, fit(docs, labels)) < threshold)
