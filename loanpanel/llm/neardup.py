"""Near-duplicate documents by one-permutation MinHash, verified on full shingle sets.

A document's set holds its distinct shingles of `size` words (A-Z lower-cased; with fewer
words, the whole sequence). Two documents are linked if 100 times the intersection is at
least `percent` times the union, and components of links are classes.

* Documents with equal sets are one node from the start, the smallest of them, so copies
  cost one row each and are never compared. A node is named by its key and a hash of its
  text, so that different texts under one key are different nodes.
* One hash per shingle: its upper part names one of BANDS * ROWS bins, and a bin keeps
  its smallest hash. An empty bin borrows from the first non-empty bin in an order of
  its own (optimal densification). ROWS bins form a band; equal bands share a bucket.
  Two sets of similarity s share none with probability (1 - s^ROWS)^BANDS, 1e-7 at 0.8.
* A bucket's candidates are a star: each member with one centre, the member that shares
  most buckets in all, which is the text that the others were made from if there is one.
* Candidates are verified on the sets themselves, and verified links give components.
* What a star leaves open are pairs of a bucket that are in different components, neither
  of them the centre c. Of such x and y the star tells how much each shares with c; they
  share no more than the smaller of the two, and what both have beyond c. So either the
  first alone reaches the threshold, or they have enough words beyond c in common: then
  one of these is among the rarest few of each (a prefix filter), which a join on those
  finds. All pairs found are verified. A copy with many edits of its own, far from the
  centre, shares none of them, so that few pairs are left even of a large group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import settled, small_batches
from loanpanel.llm.components import components

ROWS, BANDS = 5, 40
BINS = ROWS * BANDS
SEED = 11
#: Words that a task remembers the hash of, sets that it remembers while verifying.
REMEMBERED, REMEMBERED_SETS = 100_000, 8
#: Up to this many documents (16 MB of numbers) are looked up in the texts by a broadcast
#: of their keys; for more the texts are shuffled.
BROADCAST_KEYS = 1_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and 0x09-0x0D, A-Z lower-cased; a null text has none."""
    return (text or "").encode("utf-8").lower().split()


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketcher:
    """Texts to (number of shingles, id of the set, bands)."""

    def __init__(self, size: int):
        self.size, self.known = size, {}
        # borrow[j, i]: when the empty bin j tries bin i
        self.borrow = np.random.default_rng(SEED).random((BINS, BINS)).argsort(1).argsort(1).astype(np.uint16)
        self.band = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64))

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """The distinct shingles' hashes, sorted."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        joined = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            joined = joined * _MULTIPLIER + each[i : len(words) - size + 1 + i]
        return np.unique(_mixed(joined))

    def __call__(self, text: str | None) -> tuple[int, bytes | None, np.ndarray | None]:
        words = words_of(text)
        if not words:
            return 0, None, None
        found = self.hashes(words)
        bins = ((found >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))  # the smallest hash of each bin
        full = bins[first]
        signature = np.zeros(BINS, np.uint64)
        signature[full] = found[first]
        if len(full) < BINS:
            is_empty = np.ones(BINS, bool)
            is_empty[full] = False
            empty = np.flatnonzero(is_empty)
            lender = full[self.borrow[np.ix_(empty, full)].argmin(1)]
            signature[empty] = signature[lender]
        key = self.band.copy()
        for column in signature.reshape(BANDS, ROWS).T:
            key = _mixed(key * _MULTIPLIER + column)
        return len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), key.view(np.int64)


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key (a struct of the key and a hash of the text) and text, null texts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(whole).alias("mark")).alias("key"), whole.alias("text"))


def sketch(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key (see `_named`), n_shingles, set_id, bands; the last two are null without words."""
    rows = _named(docs, key, text)
    schema = T.StructType(
        [
            rows.schema["key"],
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_id", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(size)
        for batch in batches:
            found = [sketcher(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.binary()),
                    pa.array([f[2] for f in found], pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of keys with `both`, the size of the intersection of their full sets,
    and `linked`. `texts` has the key and text of every node."""
    schema = T.StructType(
        [pairs.schema["a"], pairs.schema["b"], T.StructField("both", T.LongType()), T.StructField("linked", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Sets(size)
        for batch in batches:
            both, linked = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = held(x.as_py()), shingles(y.as_py(), size)
                both.append(len(one & two))
                linked.append(100 * both[-1] >= percent * (len(one) + len(two) - both[-1]))
            columns = [*batch.columns[:2], pa.array(both, pa.int64()), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    found = _with_texts(pairs, texts).mapInArrow(run, schema)
    return found.groupBy("a", "b").agg(F.max("both").alias("both"), F.max("linked").alias("linked"))


class _Sets:
    """Texts to shingle sets; a centre's text comes again and again."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: str) -> set:
        if text not in self.known:
            if len(self.known) >= REMEMBERED_SETS:
                self.known.clear()
            self.known[text] = shingles(text, self.size)
        return self.known[text]


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    of = lambda x: texts.select(F.col("key").alias(x), F.col("text").alias(f"text_{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "text_a", "text_b")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", mark: str | None = None
) -> DataFrame:
    """One row per row of `docs`: key, n_shingles, component_id (the smallest key of its
    class), kept (whether it is that key itself). `mark` names one column more, xxhash64 of
    the text (a null text counts as empty), which tells rows of one key apart.

    A document without words is linked with nothing. A null key takes no part: its class
    is null and it is not kept. Where different texts stand under one key, each row has
    the class of its own text, and they are linked only if they are near-duplicates. Other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = settled(sketch(docs, size, key, text))
    sets = rows.where("set_id IS NOT NULL AND key.key IS NOT NULL")
    nodes = sets.groupBy("set_id", "n_shingles").agg(F.min("key").alias("node"))
    own = settled(sets.join(nodes.select("set_id", F.col("node").alias("key")), ["set_id", "key"], "left_semi"))
    banded = own.select(F.col("key").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    crowded = banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = settled(banded.join(crowded, "band").distinct())
    weights = members.groupBy("node").agg(F.sum("members").alias("weight"))
    weighed = members.join(weights, "node")
    centres = weighed.groupBy("band").agg(F.min_by("node", F.struct(-F.col("weight"), "node")).alias("centre"))
    star = settled(
        members.join(centres, "band").where("node != centre").select("band", F.col("centre").alias("a"), F.col("node").alias("b"), "n")
    )
    pairs = star.select("a", "b").distinct()
    tested = settled(compared(pairs, _texts(docs, pairs, key, text), size, percent))
    links = tested.where("linked").select("a", "b")
    classes = settled(components(links))
    rest = settled(_left_open(star, tested, classes, docs, size, percent, key, text))
    if not rest.isEmpty():
        more = compared(rest, _texts(docs, rest, key, text), size, percent)
        classes = components(links.unionByName(more.where("linked").select("a", "b")))
    known = (
        rows.where("key.key IS NOT NULL")
        .join(nodes.select("set_id", "node"), "set_id", "left")
        .join(classes, "node", "left")
        .select("key", "n_shingles", F.coalesce("component", "node", "key")["key"].alias("component_id"))
    )
    unknown = rows.where("key.key IS NULL").select("key", "n_shingles", F.col("key.key").alias("component_id"))
    kept = F.coalesce(F.col("key.key") == F.col("component_id"), F.lit(False))
    more = [F.col("key.mark").alias(mark)] if mark else []
    return known.unionByName(unknown).select(
        F.col("key.key").alias(key), "n_shingles", "component_id", kept.alias("kept"), *more
    )


def _left_open(
    star: DataFrame, tested: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, key: str, text: str
) -> DataFrame:
    """The pairs (a, b) that share a bucket, are in different components, are not yet
    tested and may reach the threshold; see above for why there are no others.

    star: band, a (centre), b (member), n (its set's size). tested: a, b, both.
    """
    of = lambda x: classes.select(F.col("node").alias(x), F.col("component").alias(f"{x}_class"))
    placed = star.join(of("a"), "a", "left").join(of("b"), "b", "left")
    placed = placed.withColumn("class", F.coalesce("b_class", "b")).withColumn(
        "away", F.col("class") != F.coalesce("a_class", "a")
    )
    bands = placed.groupBy("band").agg(F.count("*").alias("members"), F.max("away").alias("away"))
    bands = bands.where("members > 1 AND away").select("band")
    members = placed.join(bands, "band").groupBy("a", "b", "n", "class", "away").agg(F.count("*").alias("bands"))
    members = members.join(tested.select("a", "b", F.col("both").alias("s")), ["a", "b"])
    least = members.groupBy("a").agg(F.min("n").alias("least"))
    # at least so many shingles must be shared with any member
    need = F.ceil(F.lit(percent) * (F.col("n") + F.greatest("least", F.ceil(F.lit(percent) * F.col("n") / 100))) / (100 + percent))
    members = settled(members.join(least, "a").withColumn("need", need.cast("long")))

    def pairs(one: DataFrame, two: DataFrame, on: list[str], condition: str) -> DataFrame:
        other = two.select(*on, *(F.col(c).alias(f"{c}_2") for c in ("b", "class", "n", "s")))
        met = one.join(other, on).where("class != class_2").where(condition)
        return met.select(F.greatest("b", "b_2").alias("x"), F.least("b", "b_2").alias("y"))

    near = members.where("s >= need")
    enough = f"100 * least(s, s_2) >= {percent} * (n + n_2 - least(s, s_2))"
    by_centre = pairs(near.where("away"), near, ["a"], enough)

    extra = _beyond(members.select("a", "b"), docs, size, key, text)
    extra = settled(extra.select("a", "b", F.explode("hashes").alias("hash")))
    counts = extra.groupBy("hash").agg(F.count("*").alias("often")).where("often > 1")
    order = Window.partitionBy("a", "b").orderBy("often", "hash")
    own = Window.partitionBy("a", "b")
    rare = (
        # a shingle of one member only comes first in the order and meets nothing
        extra.join(counts, "hash")
        .withColumn("place", F.row_number().over(order) - F.count("*").over(own))
        .join(members, ["a", "b"])
        # all but the need - s most frequent, and one more
        .where("place <= 1 - greatest(need - s, 1)")
    )
    sizes = f"100 * least(n, n_2) >= {percent} * greatest(n, n_2)"
    by_words = pairs(rare.where("away"), rare, ["a", "hash"], sizes)
    known = tested.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
    found = by_centre.unionByName(by_words).distinct().join(known, ["x", "y"], "left_anti")
    return found.select(F.col("x").alias("a"), F.col("y").alias("b"))


def _beyond(pairs: DataFrame, docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """a, b, hashes of the shingles that b has and a has not."""
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"], T.StructField("hashes", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher, known = Sketcher(size), {}
        for batch in batches:
            found = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                centre = x.as_py()
                if centre not in known:
                    if len(known) >= REMEMBERED_SETS:
                        known.clear()
                    known[centre] = sketcher.hashes(words_of(centre))
                own = sketcher.hashes(words_of(y.as_py()))
                found.append(np.setdiff1d(own, known[centre], assume_unique=True).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int64()))], names=schema.names)

    return _with_texts(pairs, _texts(docs, pairs, key, text)).mapInArrow(run, schema)


def _texts(docs: DataFrame, pairs: DataFrame, key: str, text: str) -> DataFrame:
    """key and text of the nodes in some pair."""
    ends = settled(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct())
    if ends.count() <= BROADCAST_KEYS:
        ends = F.broadcast(ends)
    return _named(docs, key, text).join(ends, "key", "left_semi").distinct()
