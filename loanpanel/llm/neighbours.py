"""Approximate nearest neighbours by collision counting, for largest inner product.

Vectors are cut into blocks of about BLOCK by a hash of their id. Within a block every
vector gets one more component that makes all lengths equal, so that the largest inner
product is the smallest distance, and is projected on PROJECTIONS random lines; the
projections are kept as sorted arrays. A query is given the same length and uses the
PER_QUERY lines on which its own projection is furthest from zero: these tell most. On each,
a window is centred on that projection and widened by GROWTH (virtual rehashing). Cursors at
both ends of a window move outward, and only the entries that they newly pass are counted.
Once enough vectors lie in THRESHOLD of the windows or more, those are verified by their
inner products in double precision.

On 8,192 random vectors of 64 components (the hardest case) a query passes 20 entries and
verifies 0.2 vectors for each vector of the block, half the operations of all inner products
(64 each), at a recall of 0.97. One matrix product of all of them takes less time even so, as
it runs through memory in order; the method pays where a vector costs more than 64 terms.

Each block of vectors meets each block of queries once, in one task of bounded size; of
a query only its best k of a block go on. Nothing is collected or broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Vectors and queries that meet in one task, and queries searched at a time.
BLOCK, QUERY_BLOCK, CHUNK = 8192, 8192, 64
PROJECTIONS, PER_QUERY, THRESHOLD, GROWTH = 256, 48, 0.5, 1.05
#: A block's search ends with k + LEAST + VERIFIED * (vectors in the block) collided vectors.
LEAST, VERIFIED = 256, 0.12
SEED = 7


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v, dim of the vectors that can take part: no null id, not null, empty or zero,
    no null or non-finite component. Of several vectors under one id the smallest counts
    (so repeated rows count once)."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector)
    good = F.forall(v, lambda x: F.coalesce(finite(x), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & v.isNotNull() & F.coalesce(good, F.lit(False)))
    return (
        rows.groupBy(F.col(key).alias("id"))
        .agg(F.min(v).alias("v"))
        .select("id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("dim"))
    )


def _scaled(vectors: np.ndarray, axis: int | None) -> np.ndarray:
    """By a power of two so that the largest component lies between 1/2 and 1: lengths of any
    finite vectors can then be told."""
    _, exponent = np.frexp(np.abs(vectors).max(axis, keepdims=True))
    return np.ldexp(vectors, -exponent)


class Index:
    """The sorted projections of one block of vectors of the same dimension."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.n = vectors, len(vectors)
        scaled = _scaled(vectors, None)
        lengths = (scaled**2).sum(1)
        self.length = np.sqrt(lengths.max())
        rest = np.sqrt(np.maximum(lengths.max() - lengths, 0))
        self.lines = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        projected = (np.column_stack([scaled, rest]) @ self.lines).T
        order = np.argsort(projected, axis=1, kind="stable")
        self.order = order.astype(np.int32).ravel()
        self.spread = float(np.median(np.abs(projected)))
        # all lines in one ascending array, each in a stretch of its own
        self.reach = 1.0 + float(np.abs(projected).max())
        self.middle = 4 * self.reach * np.arange(PROJECTIONS)
        self.sorted = (np.take_along_axis(projected, order, 1) + self.middle[:, None]).ravel()
        self.passed = self.verified = 0  # entries counted and vectors verified so far

    def candidates(self, queries: np.ndarray, k: int, width: float) -> tuple[list[np.ndarray], float]:
        """For each query the vectors that collided often enough, and the widest window.
        Every search starts with windows of half-width `width`."""
        scaled = _scaled(queries, 1)
        scaled *= self.length / np.sqrt((scaled**2).sum(1, keepdims=True))
        centres = scaled @ self.lines[:-1]
        used = np.argsort(-np.abs(centres), axis=1, kind="stable")[:, :PER_QUERY]
        centres = np.clip(np.take_along_axis(centres, used, 1), -self.reach, self.reach)
        middle = self.middle[used]
        need = min(self.n, k + 1 + LEAST + int(VERIFIED * self.n))
        often = math.ceil(THRESHOLD * PER_QUERY)
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        counts = np.zeros((len(queries), self.n), np.int16)
        low = high = None
        left = np.arange(len(queries))
        while len(left):
            ends = [np.clip(centres[left] + side * width, -self.reach, self.reach) + middle[left] for side in (-1, 1)]
            new_low, new_high = (np.searchsorted(self.sorted, e, side) for e, side in zip(ends, ("left", "right")))
            if low is None:  # both cursors start where the window does
                low = np.zeros((len(queries), PER_QUERY), np.int64)
                high = np.zeros_like(low)
                low[left] = high[left] = new_low
            starts = np.concatenate([new_low, high[left]], axis=1)
            sizes = np.concatenate([low[left] - new_low, new_high - high[left]], axis=1)
            low[left], high[left] = new_low, new_high
            done = np.zeros(len(left), bool)
            for row, at in enumerate(left):
                counts[at] += self._counted(starts[row], sizes[row])
                collided = np.flatnonzero(counts[at] >= often)
                if len(collided) >= need:
                    found[at], done[row] = collided, True
            left = left[~done]
            width *= GROWTH
        return found, width

    def _counted(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How often each vector stands in some stretches of the sorted arrays."""
        total = int(sizes.sum())
        self.passed += total
        places = np.arange(total) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return np.bincount(self.order[places], minlength=self.n).astype(np.int16)

    def best(self, query: np.ndarray, among: np.ndarray) -> np.ndarray:
        """The inner products of some vectors. One beyond the range of a double is infinite;
        where infinite terms of both signs meet it counts as the smallest."""
        self.verified += len(among)
        with np.errstate(over="ignore", invalid="ignore"):
            scores = (self.vectors[among] * query).sum(1)
        return np.where(np.isnan(scores), -np.inf, scores)


def _search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query, id, score) of the k nearest of a block for each query, without itself."""
    index, rows = Index(vectors), []
    width = 0.5 * index.spread
    for at in range(0, len(queries), CHUNK):
        part = queries[at : at + CHUNK]
        found, widest = index.candidates(part, k, width)
        width = max(width, widest / GROWTH**12)
        for query_id, query, among in zip(query_ids[at : at + CHUNK], part, found, strict=True):
            among = among[ids[among] != query_id]
            scores = index.best(query, among)
            order = np.lexsort((ids[among], -scores))[:k]
            rows += zip([query_id] * len(order), ids[among[order]], scores[order], strict=True)
    return rows


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each usable vector with `is_query` (a
    condition on the key column) the k nearest found among all others, ties to the smaller
    id. Vectors of another dimension than a query's are not compared with it. Components may
    have any finite size; a product that a double cannot hold is infinite (and ties with
    others that are)."""
    rows = usable(vectors, key, vector)
    questions = rows.where(is_query)
    n = rows.count()
    blocks = max(1, math.ceil(n / BLOCK))
    question_blocks = max(1, math.ceil(questions.count() / QUERY_BLOCK))
    own = lambda parts: F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = rows.select("dim", own(blocks).alias("b"), every(question_blocks).alias("c"), "id", "v")
    right = questions.select("dim", every(blocks).alias("b"), own(question_blocks).alias("c"), "id", "v")
    id_type = vectors.schema[key].dataType
    schema = T.StructType(
        [T.StructField("query_id", id_type), T.StructField("vec_id", id_type), T.StructField("score", T.DoubleType())]
    )

    def arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        t = t.combine_chunks()
        ids = t["id"].to_numpy()
        return ids, t["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)

    def meet(one: pa.Table, two: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if one.num_rows and two.num_rows:
            found = _search(*arrays(one), *arrays(two), k)
        columns = zip(*found, strict=True) if found else ([], [], [])
        types = (one.schema.field("id").type, one.schema.field("id").type, pa.float64())
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=schema.names)

    by = ["dim", "b", "c"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
