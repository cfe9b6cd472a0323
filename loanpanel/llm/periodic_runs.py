"""Runs of words: stretches that repeat with a period, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of
at least max(LEAST, REPEATS * q) words, that no neighbouring word extends.

Periods are taken by octaves, from `half` to 2 * half - 1. For each octave a document is cut
into tiles with borders every 2 * half words, wide enough for their octave, and tiles are
solved on their own. The places i where word i equals word i + q, for all the run's places,
are an interval of at least 3 * half, so there is a border b in it with `half` such places
to its right. Equal sums of `half` words at b and b + q pick the borders where that may be.
There, two Z-functions tell for every period of the octave how far the words from b on equal
those from b + q on, and how far those before b equal those before b + q, up to just beyond
the neighbouring borders. What both make is a fragment of the interval. Fragments
that meet inside a tile are joined there; those that reach out of the tile, or are long
enough, go on. They are shuffled by document and period, where fragments that meet are
stitched. A run found with several periods (all multiples of the smallest) keeps the smallest.

A document's tiles of all octaves together are as many copies of it as there are octaves, so
they are made and solved where the document was read; what moves are fragments, and the
texts of documents that have some.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import settled, small_batches

#: Words and repeats of the shortest run.
LEAST, REPEATS = 6, 4
#: Words of a tile at least (a power of two).
TILE = 4096

# Odd, with its inverse modulo 2^64: sums of words are polynomials in BASE.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and 0x09-0x0D; a null text has none."""
    return (text or "").encode("utf-8").split()


def z_function(s: list[int]) -> list[int]:
    """How many numbers from each place on equal those from the start on."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


class Powers:
    """The powers of BASE and of its inverse, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            grown = [np.full(size, x, np.uint64) for x in (_BASE, _INVERSE)]
            for powers in grown:
                powers[0] = 1
            self.up, self.down = (np.cumprod(p, dtype=np.uint64) for p in grown)
        return self.up[:n], self.down[:n]


class Tiles:
    """Finds the fragments of one document, tile by tile."""

    def __init__(self, ids: list[int], powers: Powers):
        self.ids, self.n, self.powers = ids, len(ids), powers
        values = (np.array(ids, np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        self.values = values ^ (values >> np.uint64(31))

    def fragments(self) -> Iterator[tuple[int, int, int]]:
        """(period, first place, place after the last) of places i equal to i + period."""
        half = 1
        while REPEATS * half <= self.n and self.n >= LEAST:
            core = max(TILE, 8 * half)
            for start in range(0, self.n, core):
                yield from self._solve(half, start, min(start + core, self.n + -self.n % (2 * half)))
            half *= 2

    def _borders(self, half: int, start: int, end: int) -> np.ndarray:
        """The borders of a tile where some period of the octave may have `half` places."""
        values = self.values[start : min(end + half, self.n)]
        up, down = self.powers(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up, out=sums[1:])
        here = (sums[half:] - sums[:-half]) * down[: max(len(sums) - half, 0)]  # of `half` words from each place on
        rows = np.zeros(end - start, np.uint64)  # beyond the text, zeros: a chance hit is refuted below
        rows[: min(len(here), end - start)] = here[: end - start]
        rows = rows.reshape(-1, 2 * half)[: (self.n - start) // (2 * half)]
        return start + 2 * half * np.flatnonzero((rows[:, half:] == rows[:, :1]).any(1))

    def _solve(self, half: int, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        step, ahead = 2 * half, 3 * half
        open_: dict[int, tuple[int, int]] = {}  # by period, the last fragment

        def closed(period: int) -> Iterator[tuple[int, int, int]]:
            low, high = open_[period]
            if high - low >= least_places(period) or low <= start - step or high >= end:
                yield period, low, high

        for b in self._borders(half, start, end).tolist():
            after = self._after(b, half, ahead)
            before = self._before(b, half, step)
            for period, (f, g) in enumerate(zip(after, before, strict=True), half):
                if f < half:
                    continue
                low, high = b - g, b + f
                if period in open_:
                    if low <= open_[period][1]:
                        open_[period] = open_[period][0], high
                        continue
                    yield from closed(period)
                open_[period] = low, high
        for period in open_:
            yield from closed(period)

    def _after(self, b: int, half: int, most: int) -> list[int]:
        """For each period, how many words from b on equal those a period later."""
        z = z_function(self.ids[b : b + 2 * half + most])[half : 2 * half]
        return [min(x, most) for x in z] + [0] * (half - len(z))

    def _before(self, b: int, half: int, most: int) -> list[int]:
        """For each period, how many words before b equal those a period later."""
        lead = self.ids[max(b - most, 0) : b]
        lead.reverse()
        tail = self.ids[b : b + 2 * half]
        gap = [-1] + [-2 - i for i in range(2 * half - len(tail))]  # beyond the text, equal to nothing
        tail.reverse()
        z = z_function(lead + gap + tail + lead)
        at = len(lead) + 1 + 2 * half  # the place of b itself
        return [z[at - p] if at - p < len(z) else 0 for p in range(half, 2 * half)]


def least_places(period: int) -> int:
    """Places i equal to i + period in the shortest run with this smallest period."""
    return max(LEAST, REPEATS * period) - period


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


_FRAGMENT = T.ArrayType(
    T.StructType([T.StructField(name, T.LongType()) for name in ("period", "low", "high")]), containsNull=False
)
_FRAGMENT_ARROW = pa.list_(pa.struct([(name, pa.int64()) for name in ("period", "low", "high")]))


def tiled(rows: DataFrame) -> DataFrame:
    """Of row, key, text: row, key, fragments, collapsed_sha256 where there are none (it is
    the digest of all words, then), else text."""
    names = ("row", "key", "fragments", "text", "collapsed_sha256")
    fields = [
        rows.schema["row"],
        rows.schema["key"],
        T.StructField("fragments", _FRAGMENT),
        T.StructField("text", T.StringType()),
        T.StructField("collapsed_sha256", T.StringType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found, texts, digests = [], [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                numbers: dict[bytes, int] = {}
                ids = [numbers.setdefault(w, len(numbers)) for w in words]
                # where no word comes twice there is nothing to find
                mine = list(Tiles(ids, powers).fragments()) if len(numbers) < len(ids) else []
                found.append([dict(zip(("period", "low", "high"), f, strict=True)) for f in mine])
                texts.append(text if mine else None)
                digests.append(None if mine else sha(b" ".join(words)))
            columns = [*batch.columns[:2], pa.array(found, _FRAGMENT_ARROW), pa.array(texts, pa.string()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, T.StructType(fields))


def stitched(fragments: DataFrame) -> DataFrame:
    """row, start, length, period of each run, from row, period, low, high."""
    order = Window.partitionBy("row", "period").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("fresh", (F.coalesce(reach, F.lit(-1)) < F.col("low")).cast("long"))
    numbered = marked.withColumn("number", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row", "period", "number").agg(F.min("low").alias("start"), F.max("high").alias("high"))
    length = F.col("high") + F.col("period") - F.col("start")
    long_enough = length >= F.greatest(F.lit(LEAST), REPEATS * F.col("period"))
    runs = whole.withColumn("length", length).where(long_enough)
    return runs.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def described(text: str, runs: list[tuple[int, int, int]]) -> tuple:
    """The digest columns of a text with its runs (start, length, period)."""
    runs = sorted((s, p, n) for s, n, p in runs)
    words = words_of(text)
    best = None
    for s, p, n in runs:
        if best is None or n * best[2] > best[1] * p:
            best = s, n, p
    change = np.zeros(len(words) + 1, np.int64)
    for s, p, n in runs:
        change[s + p] += 1
        change[s + n] -= 1
    kept = np.cumsum(change[:-1]) == 0
    lines = "".join(f"{s},{n},{p}\n" for s, p, n in runs)
    collapsed = b" ".join(w for w, k in zip(words, kept.tolist(), strict=True) if k)
    s, n, p = best or (None, None, None)
    return len(runs), s, n, p, 1000 * n // p if best else None, sha(lines.encode()), sha(collapsed)


_DIGEST = (
    ("n_runs", T.LongType(), pa.int64()),
    ("start", T.LongType(), pa.int64()),
    ("length", T.LongType(), pa.int64()),
    ("period", T.LongType(), pa.int64()),
    ("exponent_milli", T.LongType(), pa.int64()),
    ("runs_sha256", T.StringType(), pa.string()),
    ("collapsed_sha256", T.StringType(), pa.string()),
)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_runs; start, length, period of the run with the
    greatest length / period (ties: smallest start, then period) and exponent_milli, its
    floor(1000 * length / period), all null without a run; runs_sha256 of the lines
    `start,length,period` of all runs by start, then period; collapsed_sha256 of the text
    without its repeats: words in a run after the run's first period are dropped, the
    others joined by one space.

    A null or empty text has no words and no runs. Rows are told apart by themselves, so
    null and repeated keys and repeated rows give rows like others. Other columns are not
    read, whatever their names.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    solved = settled(tiled(rows))  # fixes the row numbers as well
    plain = solved.where("collapsed_sha256 IS NOT NULL")
    some = solved.where("collapsed_sha256 IS NULL")
    runs = stitched(some.select("row", F.inline("fragments")))
    runs = runs.groupBy("row").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    joined = some.select("row", "key", "text").join(runs, "row", "left").select("key", "text", "runs")
    schema = T.StructType([joined.schema["key"], *(T.StructField(name, t) for name, t, _ in _DIGEST)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                described(t, [(r["start"], r["length"], r["period"]) for r in mine or ()])
                for t, mine in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            columns = zip(*found, strict=True) if found else [[] for _ in _DIGEST]
            arrays = [pa.array(list(c), t) for c, (_, _, t) in zip(columns, _DIGEST, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    without = plain.select(
        "key",
        F.lit(0).cast("long").alias("n_runs"),
        *(F.lit(None).cast("long").alias(name) for name in ("start", "length", "period", "exponent_milli")),
        F.lit(sha(b"")).alias("runs_sha256"),
        "collapsed_sha256",
    )
    return joined.mapInArrow(run, schema).unionByName(without).withColumnRenamed("key", key)
