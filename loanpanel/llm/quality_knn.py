"""A quality classifier by the votes of the nearest labelled documents.

A document's terms say how it is written, not what about: for each word its case, the
sign it ends with, its length, whether it repeats the word before or an earlier one, and
a hash of its beginning. Labelled documents of a bounded sample span a latent space
(singular vectors of their weighted term matrix). Every document is brought into that
space, compared with all labelled vectors by exact cosines, a block of documents at a
time, and the NEIGHBOURS nearest vote with their label, weighted by similarity.

The sample has at most SAMPLE documents, so its vectors (SAMPLE * RANK floats, under
1 MB) can be broadcast. Documents are never shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import labelled_sample, small_batches

#: Bounds: labelled documents, latent dimensions, neighbours that vote, documents compared
#: at a time, words that a task remembers.
SAMPLE, RANK, NEIGHBOURS, BLOCK, REMEMBERED = 4096, 48, 15, 256, 100_000

#: Term numbers: case of a word, its last sign, its length, marks, hashed beginnings.
CASES, SIGNS, LENGTHS, MARKS, HASHED = 6, 64, 16, 4, 256
TERMS = CASES + SIGNS + LENGTHS + MARKS + HASHED
SAME, SEEN, SHORT_TEXT, NO_WORD = range(CASES + SIGNS + LENGTHS, CASES + SIGNS + LENGTHS + MARKS)


def terms_of(word: str) -> tuple[int, int, int, int]:
    letters = word.strip("\"'()[]{}.,;:!?#*$%&|<>-")
    case = (
        0 if not letters else 1 if letters.isnumeric() else 2 if letters.islower()
        else 3 if letters.isupper() and len(letters) > 1 else 4 if letters.istitle() else 5
    )
    sign = 0 if word[-1].isalnum() else 1 + zlib.crc32(word[-1].encode()) % (SIGNS - 1)
    start = zlib.crc32(letters[:3].lower().encode()) % HASHED
    return case, CASES + sign, CASES + SIGNS + min(len(word), LENGTHS) - 1, TERMS - HASHED + start


class Reader:
    """Texts to term frequencies. Remembers the terms of a bounded number of words."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.terms = np.zeros((1024, 4), np.int64)
        self.done = 0  # words whose terms are filled in

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        n = len(words)
        if not n:
            empty = np.zeros(TERMS)
            empty[NO_WORD] = 1
            return empty
        if len(self.numbers) > REMEMBERED:
            self.numbers.clear()
            self.done = 0
        numbers = self.numbers
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
        self._learn(words, ids)
        counts = np.bincount(self.terms[ids].ravel(), minlength=TERMS).astype(float)
        counts[SAME] = 4 * (ids[1:] == ids[:-1]).sum()
        counts[SEEN] = n - len(np.unique(ids))
        counts[SHORT_TEXT] = 8 if n < 8 else 0
        return np.sqrt(counts / n)

    def _learn(self, words: list[str], ids: np.ndarray) -> None:
        """Fills in the terms of words that were new in this text."""
        top = len(self.numbers)
        if top > len(self.terms):
            self.terms = np.concatenate([self.terms, np.zeros((max(top - len(self.terms), len(self.terms)), 4), np.int64)])
        for at in np.flatnonzero(ids >= self.done):
            self.terms[ids[at]] = terms_of(words[at])
        self.done = top


@dataclass(frozen=True)
class Model:
    """Weights of the terms, the axes of the latent space, the labelled unit vectors."""

    weights: np.ndarray  # TERMS
    axes: np.ndarray  # TERMS x RANK
    vectors: np.ndarray  # labelled x RANK
    labels: np.ndarray
    prior: float

    def place(self, frequencies: np.ndarray) -> np.ndarray:
        found = (frequencies * self.weights) @ self.axes
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)

    def vote(self, frequencies: np.ndarray) -> np.ndarray:
        """Weighted votes, 0 to 1, for a block of documents; without labels the prior."""
        if not len(self.labels):
            return np.full(len(frequencies), self.prior)
        similar = self.place(frequencies) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(similar, nearest, 1), 0) ** 8 + 1e-9
        return np.clip((weight * self.labels[nearest]).sum(1) / weight.sum(1), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Model:
    """The latent space and the labelled vectors, from a bounded sample of labelled
    documents outside the held-out fold."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, SAMPLE, key, text).select("key", "label", "text")
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("label", T.IntegerType()), T.StructField("terms", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            terms = [reader(t.as_py()).astype(np.float32).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.binary())], names=schema.names)

    rows = sorted(sample.mapInArrow(read, schema).collect())
    found = np.array([np.frombuffer(r["terms"], np.float32) for r in rows], float).reshape(-1, TERMS)
    known = np.array([r["label"] for r in rows], float)
    # terms that nearly all documents hold say little
    weights = np.log((1 + len(rows)) / (1 + (found > 0).sum(0))) + 0.5
    weighted = found * weights
    values, axes = np.linalg.eigh(weighted.T @ weighted)
    model = Model(weights, np.ascontiguousarray(axes[:, np.argsort(-values)[:RANK]]), np.zeros((0, RANK)), known, 0.5)
    return Model(weights, model.axes, model.place(found), known, 0.5)


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """The score of a whole text, 0 to 1; a null text counts as empty."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.axes, model.vectors, model.labels, model.prior))

    @F.arrow_udf(T.DoubleType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader, placed = Reader(), Model(*shared.value)
        for batch in batches:
            votes = [np.zeros(0)]
            for at in range(0, len(batch), BLOCK):
                block = np.array([reader(t.as_py()) for t in batch.slice(at, BLOCK)])
                votes.append(placed.vote(block))
            yield pa.array(np.concatenate(votes), pa.float64())

    return run(text)
