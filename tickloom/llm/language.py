"""Language by a string kernel: blended-spectrum n-gram presence, Nystroem landmarks, one-versus-rest ridge regression.

The kernel of two texts is the number of n-grams (n = 1 to 3) present in both, over the root of the product of their own
numbers; it is exact. A text is compared with a few landmark texts only; ridge regression on those kernel values, whitened by
the landmarks' own kernel matrix, gives a score for each language. Scoring is a sparse product of a batch's presence rows with
the landmarks', then a product with the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialize, python_ready

ORDERS = 3
#: Training texts and landmarks of each language, the first by a hash of the id, and of all languages together.
TRAINING, MOST_TRAINING = 400, 6400
LANDMARKS, MOST_LANDMARKS = 16, 512
#: Languages that are learned: the most frequent ones.
MOST_LANGUAGES = 256
RIDGE = 1e-3
BLOCK = 64
#: Characters whose n-grams are gathered at a time.
CHUNK = 1 << 20
UNKNOWN = "und"

_ASCII = np.where(np.array([chr(i).isalpha() for i in range(128)]), np.arange(128), 32).astype(np.int64)


def grams(text: str | None) -> np.ndarray:
    """The distinct n-grams of a whole text, lower-cased, as numbers of 21 bits a character; ASCII other than letters is a space."""
    low = (text or "").lower()
    c = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if not len(c):
        return np.zeros(0, np.int64)
    c = np.where(c < 128, _ASCII[np.minimum(c, 127)], c)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    c = c[keep] + 1
    found = np.zeros(0, np.int64)
    for at in range(0, len(c), CHUNK):
        part = c[at : at + CHUNK + ORDERS - 1]
        codes, h = [found, part], part
        for n in range(1, min(ORDERS, len(part))):
            h = (h[:-1] << 21) | part[n:]
            codes.append(h)
        found = pd.unique(np.concatenate(codes))
    return found


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    """langs in order; grams: those of the landmarks, sorted; start, marks: which landmarks have each; sizes: each landmark's
    number of grams; weights: landmark by language."""

    langs: list[str]
    grams: np.ndarray
    start: np.ndarray
    marks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, langs: list[str], landmarks: list[np.ndarray]) -> Model:
        codes = np.concatenate([*landmarks, np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(landmarks), dtype=np.int32), [len(g) for g in landmarks])
        order = np.argsort(codes, kind="stable")
        known, first = np.unique(codes[order], return_index=True)
        return cls(langs, known, np.append(first, len(codes)), owner[order], np.array([max(len(g), 1) for g in landmarks], float), np.zeros((len(landmarks), len(langs))))

    def kernel(self, rows: list[np.ndarray]) -> np.ndarray:
        """Kernel values of a batch of texts (by their grams) with the landmarks."""
        m = len(self.sizes)
        row, code = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.zeros(0, np.int64)])
        at = np.searchsorted(self.grams, code)
        at[at == len(self.grams)] = 0
        hit = self.grams[at] == code if len(self.grams) else np.zeros(len(code), bool)
        row, at = row[hit], at[hit]
        many = self.start[at + 1] - self.start[at] if len(at) else np.zeros(0, np.int64)
        each = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.start[at], many)
        both = np.bincount(np.repeat(row, many) * m + self.marks[each], minlength=len(rows) * m).reshape(len(rows), m)
        size = np.array([max(len(r), 1) for r in rows], float)
        return both / np.sqrt(size[:, None] * self.sizes[None, :])

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return self.kernel(rows) @ self.weights


def _kernels(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [k for i in range(0, len(texts), BLOCK) for k in model.kernel([grams(t) for t in texts[i : i + BLOCK]])]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), pa.array(found, pa.list_(pa.float64()))], ["lang", "rank", "kernel"])

    return run


def train(docs: DataFrame, training: int = TRAINING, landmarks: int = LANDMARKS) -> Model:
    """Fit on at most `training` texts of each language (null languages and texts without letters left out).

    Which: the first by a hash of the id, one text an id. They are cut out by a hash threshold that leaves about twice as many
    of each language, so no language's rows are ever ranked in one task. With many languages each has fewer, so that
    MOST_TRAINING and MOST_LANDMARKS bound what is fitted; the driver gets the landmarks' texts and the others' kernel values.
    """
    python_ready(docs.sparkSession)
    known = docs.where("lang is not null").where(F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("doc_id").alias("hash"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return Model.of([], [])
    training = max(2, min(training, MOST_TRAINING // len(counts)))
    landmarks = max(1, min(landmarks, MOST_LANDMARKS // len(counts)))
    share: Column = F.lit(-1.0)
    for lang, n in counts:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, (2 * training + 50) / n))).otherwise(share)
    drawn = known.where((F.col("hash").cast("double") / float(2**64) + 0.5) <= share)
    drawn = drawn.groupBy("lang", "hash").agg(F.min("text").alias("text")).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash")))
    drawn = materialize(drawn.where(F.col("rank") <= training).select("lang", "rank", "text"), "language-texts")
    marks = drawn.where(F.col("rank") <= landmarks).orderBy("lang", "rank").collect()
    langs = sorted({r["lang"] for r in marks})
    model = Model.of(langs, [grams(r["text"]) for r in marks])
    rows = drawn.select("lang", "rank", "text").mapInArrow(_kernels(model), "lang string, rank int, kernel array<double>").orderBy("lang", "rank").collect()
    k_nm = np.array([r["kernel"] for r in rows])
    k_mm = model.kernel([grams(r["text"]) for r in marks])
    y = np.array([[1.0 if k == r["lang"] else -1.0 for k in langs] for r in rows])
    model.weights = np.linalg.solve(k_nm.T @ k_nm + RIDGE * len(rows) * k_mm + 1e-8 * np.eye(len(marks)), k_nm.T @ y)
    return model


def _predict(model: Model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = [], []
            texts = batch.column("text").to_pylist()
            for i in range(0, len(texts), BLOCK):
                part = texts[i : i + BLOCK]
                found = model.scores([grams(t) for t in part]) if model.langs else np.zeros((len(part), 0))
                for t, s in zip(part, found, strict=True):
                    sure = bool(model.langs) and has_letter(t)
                    lang.append(model.langs[int(s.argmax())] if sure else UNKNOWN)
                    score.append(round(float(min(1.0, max(0.0, (s.max() + 1) / 2))), 6) if sure else 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns in keep, and lang_pred and score (0 to 1) of each row's whole text, from the text alone.

    A null text, one without letters, and any text where no language was learned get 'und' and 0. Repeated rows get repeated
    results; ties go to the first language in order.
    """
    python_ready(docs.sparkSession)
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["lang_pred string", "score double"])
    return docs.select(*keep, "text").mapInArrow(_predict(model, keep), schema)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Predict every document's language; learned from those whose crc32(doc_id) mod 4 is not 2, the rest are held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    marked = docs.select("doc_id", "text", "lang", held.alias("held_out"))
    return predict(marked, train(marked.where("not held_out")), ["doc_id", "held_out"])
