"""Toxicity by a chain of linear classifiers.

Categories are predicted in a fixed order. Each category's model is a sparse logistic regression on the presence of words
and a few shape features, and on the probabilities of the categories before it. In training those probabilities are
out-of-fold, so later models see them as they will be: from models that have not seen the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize, python_ready

#: The chain: name and the condition on a row of labels. Later models see the probabilities of earlier ones.
CHAIN = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
#: Labelled documents that are fitted, the first by hash: the bound of what reaches the driver.
SAMPLE = 8000
#: Words that may become features: those most associated with a category (chi-square).
VOCABULARY = 4096
FOLDS = 5
#: Documents of the sample that a word must occur in.
LEAST = 4
#: L1 penalty as a share of the smallest one that makes all weights 0.
PENALTY = 0.02

_find = re.compile(r"[^\W\d_]+").findall


def words(text: str | None) -> set[str]:
    """The distinct lower-cased runs of letters of a whole text."""
    return set(_find(text.lower())) if text else set()


def shape(text: str | None) -> list[float]:
    """Shares, each in 0..1, that do not depend on the language."""
    text = text or ""
    n = max(len(text), 1)
    lines = [x for x in text.split("\n") if x]
    tokens = text.split()
    return [
        sum(map(text.count, "#*$%&|<>@!")) / n,
        sum(map(str.isupper, text)) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        1 - len(set(tokens)) / max(len(tokens), 1),
        min(1.0, len(tokens) / 50),
    ]


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(list(words(t)), shape(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array([w for w, _ in found], pa.list_(pa.string())), pa.array([s for _, s in found], pa.list_(pa.float64()))], ["doc_id", "y", "words", "shape"])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Sparse:
    """Binary features as (row, column) pairs, and dense columns after them."""

    row: np.ndarray
    column: np.ndarray
    dense: np.ndarray
    width: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], len(self.dense)) + self.dense @ w[self.width :]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.column, r[self.row], self.width), self.dense.T @ r])

    def take(self, rows: np.ndarray) -> Sparse:
        new = np.full(len(self.dense), -1)
        new[rows] = np.arange(len(rows))
        keep = new[self.row] >= 0
        return Sparse(new[self.row[keep]], self.column[keep], self.dense[rows], self.width)

    def plus(self, column: np.ndarray) -> Sparse:
        return Sparse(self.row, self.column, np.column_stack([self.dense, column]), self.width)


def fit(x: Sparse, y: np.ndarray, rounds: int = 600) -> tuple[np.ndarray, float]:
    """L1 logistic regression with balanced classes, by accelerated proximal gradient. Returns weights and intercept."""
    n, ones = len(y), float(y.sum())
    if not 0 < ones < n:
        return np.zeros(x.width + x.dense.shape[1]), 6.0 if ones else -6.0
    each = np.where(y > 0, 0.5 / ones, 0.5 / (n - ones))
    v = np.ones(x.width + x.dense.shape[1])
    for _ in range(30):
        v = x.back(each * x.dot(v))
        v /= max(np.linalg.norm(v), 1e-12)
    rate = 1 / (0.25 * (np.linalg.norm(x.back(each * x.dot(v))) + 1) * 1.1)
    penalty = PENALTY * np.abs(x.back(each * (0.5 - y))).max()
    w = u = np.zeros_like(v)
    b = c = 0.0
    t = 1.0
    for _ in range(rounds):
        r = each * (_sigmoid(x.dot(u) + c) - y)
        new = u - rate * x.back(r)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        d = c - rate * r.sum()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = new + (t - 1) / s * (new - w), d + (t - 1) / s * (d - b)
        w, b, t = new, d, s
    return w, b


@dataclass
class Chain:
    """Fitted models in order: word weights by word, weights of shape and of earlier probabilities, intercept, threshold."""

    names: list[str]
    words: list[dict[str, float]]
    dense: list[np.ndarray]
    intercept: list[float]
    threshold: list[float]

    def score(self, text: str | None) -> list[float]:
        """The probabilities of the categories, in order."""
        found, extra = words(text), shape(text)
        for weights, dense, b in zip(self.words, self.dense, self.intercept, strict=True):
            z = b + sum(weights[w] for w in sorted(weights.keys() & found)) + float(np.dot(dense, extra))
            extra = [*extra, float(_sigmoid(np.array(z)))]
        return extra[-len(self.names) :]


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold probabilities, midway to the next lower one; 0.5 without both classes."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = -1
    i = int(np.argmax(f1))
    return float((p[order][i] + (p[order][i + 1] if i + 1 < len(p) else 0)) / 2)


def train(docs: DataFrame, labels: DataFrame, chain: tuple[tuple[str, str], ...] = CHAIN, sample: int = SAMPLE) -> Chain:
    """Fit the chain on at most `sample` labelled documents of different texts, the first by a hash of the id.

    Labels that match no document count for nothing; a repeated label counts once (the largest); of several texts with one id
    the first by hash is taken, so at most `sample` texts reach the driver. A category without both
    classes gets a constant. Without labels every probability is near 0.
    """
    python_ready(docs.sparkSession)
    y: Column = F.array(*[F.coalesce(F.expr(c), F.lit(False)).cast("double") for _, c in chain])
    rows = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(y).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(rows), "doc_id")  # at most `sample` ids
    rows = rows.groupBy("doc_id").agg(F.first("y").alias("y"), F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select("doc_id", "y", "t.text")
    found = materialize(rows.dropDuplicates(["text"]).mapInArrow(_word_rows, "doc_id long, y array<double>, words array<string>, shape array<double>"), "toxic-words")
    n = found.count()
    names = [k for k, _ in chain]
    totals = found.agg(*[F.sum(F.col("y")[i]) for i in range(len(names))]).first()
    chi = F.lit(0.0)
    for i in range(len(names)):
        p = (totals[i] or 0.0) / max(n, 1)
        if 0 < p < 1:
            chi = F.greatest(chi, F.pow(F.col(f"y{i}") - F.col("n") * p, F.lit(2)) / (F.col("n") * p * (1 - p)))
    counts = found.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("y")[i]).alias(f"y{i}") for i in range(len(names))])
    top = counts.where(F.col("n") >= LEAST).orderBy(chi.desc(), "word").limit(VOCABULARY).select("word").collect()
    number = {r[0]: i for i, r in enumerate(sorted(top))}
    wanted = F.array(*[F.lit(w) for w in number]) if number else F.array().cast("array<string>")
    data = found.select("doc_id", "y", "shape", F.array_intersect("words", wanted).alias("words")).orderBy("doc_id").collect()
    row = np.array([i for i, r in enumerate(data) for _ in r["words"]], np.int64)
    column = np.array([number[w] for r in data for w in r["words"]], np.int64)
    x = Sparse(row, column, np.array([r["shape"] for r in data], float).reshape(len(data), len(shape(""))), len(number))
    target = np.array([r["y"] for r in data], float).reshape(len(data), len(names))
    fold = np.arange(len(data)) % FOLDS
    out = Chain(names, [], [], [], [])
    for i in range(len(names)):
        y1 = target[:, i]
        held = np.zeros(len(data))
        for k in range(FOLDS):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(inside) and len(outside):
                w, b = fit(x.take(inside), y1[inside])
                held[outside] = _sigmoid(x.take(outside).dot(w) + b)
        w, b = fit(x, y1)
        out.words.append({word: float(w[j]) for word, j in number.items() if w[j]})
        out.dense.append(w[len(number) :])
        out.intercept.append(float(b))
        out.threshold.append(_threshold(held, y1))
        x = x.plus(held)
    return out


def _scorer(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([chain.score(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(chain.names))
            columns = [batch.column(c) for c in batch.schema.names] + [pa.array(np.round(scores[:, i], 6)) for i in range(len(chain.names))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *[f"p_{k}" for k in chain.names]])

    return run


def classify(docs: DataFrame, chain: Chain) -> DataFrame:
    """Add p_<category> for each category of the chain, and rejected: whether the last one reaches its threshold.

    Null and empty texts have no words: their score is the models' intercept. Every row is scored by itself on its whole
    text; columns of docs with the new names are replaced.
    """
    python_ready(docs.sparkSession)
    docs = docs.drop("rejected", *[f"p_{k}" for k in chain.names])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"p_{k} double" for k in chain.names])
    return docs.mapInArrow(_scorer(chain), schema).withColumn("rejected", F.col(f"p_{chain.names[-1]}") >= chain.threshold[-1])


def classify_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest: doc_id, a probability for each category, whether the document is toxic, and kept, its opposite."""
    scored = classify(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", *[f"p_{k}" for k, _ in CHAIN], F.col("rejected").alias("toxic"), (~F.col("rejected")).alias("kept"))
