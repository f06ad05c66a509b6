"""Toxicity by a factorization machine over hashed terms.

Terms are words and word beginnings of 4 to 7 letters (which catch inflected forms), hashed to 64
bits. The linear weights say what a term means by itself, the factors what two terms mean together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches, pieces
from webcorpus.llm.labelled import held_out, prior, sample

# Bounds of learning: labelled documents, terms, and factors of a term.
SAMPLE, TERMS, FACTORS = 12_000, 512, 4
BEGINNINGS = (4, 5, 6, 7)
# Documents that must have a term, and its least two-proportion score: among a million terms that
# mean nothing, fewer than one reaches 5.
FEWEST, LEAST_SCORE = 8, 5.0
ROUNDS, RATE, DECAY_LINEAR, DECAY_FACTORS = 300, 0.05, 2e-4, 2e-3
# Words whose terms a worker keeps.
KEPT = 1 << 19
_WORD = re.compile(r"[^\W\d_]+")


def word_terms(word: str) -> list[int]:
    """Signed 64-bit hashes of a lower-case word and its beginnings."""
    plain = [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)]
    return [xxhash.xxh64_intdigest(p) - (1 << 63) for p in plain]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class Terms:
    """Places of a text's terms in a list of chosen ones; keeps what it knows of words."""

    def __init__(self, chosen: list[int]) -> None:
        self.place = {h: k for k, h in enumerate(chosen)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> list[int]:
        if len(self.known) > KEPT:
            self.known.clear()
        found: set[int] = set()
        for word in words_of(text):
            places = self.known.get(word)
            if places is None:
                places = tuple(self.place[h] for h in word_terms(word) if h in self.place)
                self.known[word] = places
            if places:
                found.update(places)
        return sorted(found)


def raw_scores(x: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The machine's value: bias, linear part and all pairs, by the square-of-sums identity."""
    pairs = 0.5 * ((x @ factors) ** 2 - (x ** 2) @ (factors ** 2)).sum(axis=1)
    return bias + x @ linear + pairs


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, factors: int = FACTORS,
          rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the whole sample; logistic loss with decay, so that scores are probabilities."""
    n, m = x.shape
    start = np.random.default_rng(0).normal(0, 0.05, (m, factors))
    params = [np.array([prior(n, y.sum())]), np.zeros(m), start]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, rounds + 1):
        bias, w, v = params
        sums = x @ v
        off = (sigmoid(bias[0] + x @ w + 0.5 * (sums ** 2 - x @ v ** 2).sum(axis=1)) - y) / max(n, 1)
        grads = [np.array([off.sum()]), x.T @ off + DECAY_LINEAR * w,
                 x.T @ (off[:, None] * sums) - (x.T @ off)[:, None] * v + DECAY_FACTORS * v]
        for k, g in enumerate(grads):
            means[k] = 0.9 * means[k] + 0.1 * g
            squares[k] = 0.999 * squares[k] + 0.001 * g * g
            step = means[k] / (1 - 0.9 ** t) / (np.sqrt(squares[k] / (1 - 0.999 ** t)) + 1e-8)
            params[k] = params[k] - RATE * step
    return float(params[0][0]), params[1], params[2]


def _choose(rows: DataFrame, terms: int) -> list[int]:
    """At most `terms` terms: those that differ most between the labels, by the two-proportion score,
    then those that occur in nearest to half of the texts.

    The latter say little by themselves, but may with another term; the rarer a pair is, the less there
    is to learn of it.
    """
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                hashes = np.array(sorted({h for w in words_of(text) for h in word_terms(w)}),
                                  dtype=np.int64)
                yield pa.RecordBatch.from_pydict({
                    "term": pa.array(hashes), "y": pa.array(np.full(len(hashes), y))})

    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("ones")).first()
    n, ones = size.n, size.ones
    if ones == 0 or ones == n:
        return []
    counts = map_batches(rows, spread, "term long, y double").groupBy("term").agg(
        F.count("*").alias("df"), F.sum("y").alias("hits")).filter(F.col("df") >= FEWEST)
    share = F.col("df") / n
    score = (F.col("hits") / ones - (F.col("df") - F.col("hits")) / (n - ones)) / F.sqrt(
        share * (1 - share) * (1 / ones + 1 / (n - ones)))
    own = F.abs(score) >= LEAST_SCORE
    best = counts.filter(F.col("df") < n).orderBy(
        own.desc(), F.when(own, -F.abs(score)).otherwise(F.abs(share - 0.5)), "term").limit(terms)
    return [r.term for r in best.select("term").collect()]


def learn(documents: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = SAMPLE,
          terms: int = TERMS) -> tuple[list[int], float, np.ndarray, np.ndarray]:
    """(terms, bias, linear weights, factors), learnt in one task from the bounded sample."""
    rows = sample(documents, labels, label, limit)
    chosen = _choose(rows, terms)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Terms(chosen)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_pydict({
                "x": pa.array([find(t) for t in batch.column("text").to_pylist()],
                              pa.list_(pa.int32())), "y": batch.column("y")})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, y = [], []
        for batch in batches:
            found += batch.column("x").to_pylist()
            y += batch.column("y").to_pylist()
        order = sorted(range(len(y)), key=lambda k: (found[k], y[k]))  # sums do not hang on order
        x = np.zeros((len(y), len(chosen)))
        for row, k in enumerate(order):
            x[row, found[k]] = 1
        bias, linear, factors = train(x, np.array([y[k] for k in order], dtype=float))
        yield pa.RecordBatch.from_pydict({
            "bias": pa.array([bias]), "linear": pa.array([linear.tolist()]),
            "factors": pa.array([factors.ravel().tolist()], pa.list_(pa.float64()))})

    placed = map_batches(rows, place, "x array<int>, y double").repartition(1)
    made = map_batches(placed, fit, "bias double, linear array<double>, factors array<double>").first()
    return (chosen, made.bias if made else prior(0, 0),
            np.array(made.linear if made else []),
            np.array(made.factors if made else []).reshape(-1, FACTORS))


def toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = SAMPLE,
             terms: int = TERMS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, from the whole text alone.

    Learns from at most `limit` labelled documents outside the held-out fold, once per call. With no
    labels, or one label only, every text gets the same score. Null and empty texts get that of a
    text without terms; texts of any length count whole. Null ids are held out; repeated rows are
    scored alike, and ties at the threshold are toxic. No rows give none. Other columns are not read.
    """
    model = documents.sparkSession.sparkContext.broadcast(learn(documents, labels, label, limit, terms))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, bias, linear, factors = model.value
        find = Terms(chosen)
        for batch in pieces(batches):
            x = np.zeros((batch.num_rows, len(chosen)))
            for k, text in enumerate(batch.column("text").to_pylist()):
                x[k, find(text or "")] = 1
            p = sigmoid(raw_scores(x, bias, linear, factors))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32))})

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(
        rows, score, f"doc_id {kind}, held_out boolean, score double, predicted int")
