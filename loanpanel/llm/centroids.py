"""Clustering of integer vectors around centroids, exact, by equal-average equal-variance
search.

Centroids are sorted by the mean of their components. A vector's scan starts where its own
mean stands and goes outward, the nearer mean first. With d components, means m and
deviations s (the length of what is left when the mean is taken off), the squared distance
of v and c is at least d * (m_v - m_c)^2 + (s_v - s_c)^2. Once the first term alone
exceeds the best distance so far, so it does for all centroids further out and the scan ends;
where both together exceed it, the centroid is passed over; only the rest are measured, in
whole numbers. The bounds are floating-point numbers lowered by more than their rounding, so
they reject nothing that is as near as the best.

A round reads all vectors once: tasks add up their vectors by centroid and hand on one sum
per centroid and component. The centroids themselves (a parameter, not data) go to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import settled

#: By what share of the lengths involved a bound is lowered.
SLACK = 1e-9
#: Vectors that are searched at a time.
CHUNK = 4096
_FARTHEST = np.iinfo(np.int64).max


def largest_component(dim: int) -> int:
    """The largest size of a component with which a squared distance fits into a long."""
    return isqrt((1 << 60) // dim)


def whole_vectors(vectors: DataFrame, dim: int, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key and v, the components floor(scale * x), of each row that takes part: exactly
    `dim` components, none null, none not finite, none of which the result is larger than
    `largest_component` (2^27 at 64 components: distances would not fit into a long)."""
    v, limit = F.col(vector), largest_component(dim) // scale
    fits = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) <= F.lit(float(limit)), F.lit(False)))
    rows = vectors.where((F.size(v) == dim) & F.coalesce(fits, F.lit(False)))
    number = lambda x: F.floor(x.cast("double") * scale).cast("int")
    return rows.select(F.col(key).alias("key"), F.transform(v, number).alias("v"))


class Search:
    """Nearest centroid by squared distance, ties to the smaller number."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(1)
        self.numbers = np.argsort(sums, kind="stable")
        self.centroids = centroids[self.numbers]
        self.root = np.sqrt(centroids.shape[1])
        self.sums, self.spread, self.length = self._shape(self.centroids)
        self.measured = 0  # distances computed so far

    def _shape(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sums = v.sum(1).astype(float)
        spread = np.sqrt(((v - (sums / v.shape[1])[:, None]) ** 2).sum(1))
        return sums, spread, np.hypot(spread, sums / self.root)

    def __call__(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid number and distance of each row of `v` (64-bit whole numbers)."""
        k = len(self.sums)
        sums, spread, length = self._shape(v)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(len(v), _FARTHEST)
        found = np.full(len(v), k)
        at_work = np.arange(len(v))
        while len(at_work):
            low, high = left[at_work], right[at_work]
            to_low = np.where(low >= 0, sums[at_work] - self.sums[low], np.inf)
            to_high = np.where(high < k, self.sums[np.minimum(high, k - 1)] - sums[at_work], np.inf)
            down = to_low <= to_high
            left[at_work] -= down
            right[at_work] += ~down
            c, gap = np.where(down, low, np.minimum(high, k - 1)), np.minimum(to_low, to_high)
            slack = SLACK * (length[at_work] + self.length[c])
            by_mean = np.maximum(gap / self.root - slack, 0) ** 2
            near = by_mean <= best[at_work]
            near &= gap < np.inf
            at_work, c = at_work[near], c[near]
            apart = np.maximum(np.abs(spread[at_work] - self.spread[c]) - slack[near], 0)
            may = by_mean[near] + apart**2 <= best[at_work]
            rows, c = at_work[may], c[may]
            self.measured += len(rows)
            distance = ((v[rows] - self.centroids[c]) ** 2).sum(1)
            number = self.numbers[c]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
            best[rows[better]], found[rows[better]] = distance[better], number[better]
        return found, best


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for part in (batch.slice(at, CHUNK) for at in range(0, batch.num_rows, CHUNK)):
            yield part.column(0), part.column(1).flatten().to_numpy().reshape(-1, dim).astype(np.int64)


def assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """key, cluster, distance of each row (key, v)."""
    dim, table = len(centroids[0]), centroids
    schema = T.StructType(
        [rows.schema["key"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(np.array(table, np.int64))
        for keys, v in _chunks(batches, dim):
            found, distance = search(v)
            yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.int32()), pa.array(distance)], names=schema.names)

    return rows.mapInArrow(run, schema)


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid replaced by the floor of the mean of its rows; one without rows stays."""
    dim, table = len(centroids[0]), centroids
    schema = "cluster int, n long, sums array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(np.array(table, np.int64))
        sums, n = np.zeros((len(table), dim), np.int64), np.zeros(len(table), np.int64)
        for _, v in _chunks(batches, dim):
            found, _ = search(v)
            np.add.at(sums, found, v)
            n += np.bincount(found, minlength=len(table))
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(n[full]), pa.array(list(sums[full]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = rows.mapInArrow(run, schema).select("cluster", "n", F.posexplode("sums").alias("i", "part"))
    total = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    new = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), total).collect():  # centroids * dim rows
        new[r.cluster][r.i] = int(r.total) // r.n
    return new


def clustered(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dim: int = 64,
    scale: int = 64,
    seed: int = 1,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per row of `vectors` that takes part (see `whole_vectors`): key, cluster,
    distance (squared), cluster_inertia and inertia (distances summed over the cluster and
    over all; null beyond a long), centroid_sha256 (of the cluster's centroid, components
    as decimal numbers joined by commas).

    The first centroids are the k rows with the smallest SHA-256 of `seed:key`, fewer if
    there are fewer rows; then `rounds` times all centroids move. A null key counts as empty
    text; of rows with one key, the smaller vector comes first; repeated rows are several
    vectors. A tie goes to the centroid with the smaller number. No rows give no rows. Other
    columns are not read, whatever their names.
    """
    spark = vectors.sparkSession
    rows = settled(whole_vectors(vectors, dim, scale, key, vector))
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    centroids = [list(r.v) for r in rows.orderBy(place, "v").limit(k).collect()]
    if not centroids:
        empty = ("cluster int", "distance long", "cluster_inertia long", "inertia long", "centroid_sha256 string")
        return rows.select(F.col("key").alias(key), *(F.expr(f"CAST(NULL AS {t}) AS {c}") for c, t in map(str.split, empty)))
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    found = settled(assigned(rows, centroids))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    inertia = {r.cluster: int(r.total) for r in sums}  # at most k rows
    fits = lambda x: x if x < 1 << 63 else None
    about = [
        (c, fits(x), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, x in sorted(inertia.items())
    ]
    clusters = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(clusters), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
