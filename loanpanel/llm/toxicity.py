"""A toxicity classifier that is penalised for reacting to group mentions.

A document's features are the words and word beginnings that it holds. A logistic
regression over the most telling ones is fitted on a bounded sample of labelled
documents. In the sample's sentences that name a group, the name is swapped for each
other name of its family, neutral ones included, and the loss holds the squared change
of the sentence's score. So a name alone, however often it stands beside abuse in the
labels, adds no more to a score than "people" does.

A swapped sentence is scored as it reads then: a name that stands there twice, or whose
beginning another word has, loses or gains only the features that really change. Sentences
that look the same to the model, before and after, are one with a count.

Fitting collects at most SAMPLE documents' features out of FEATURES, and at most SWAPS
different swaps of their sentences; every document is then scored where it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import labelled_sample, settled, small_batches

#: Bounds: labelled documents to learn from, features of the model, different swapped
#: sentences (the most frequent) whose change of score is penalised.
SAMPLE, FEATURES, SWAPS = 12_000, 2_000, 20_000
#: A feature is considered if this many documents of the sample hold it, and if the toxic
#: ones among them are more than chance gives, by this value of chi-squared at least.
SUPPORT, TELLING = 3, 20.0
#: Weights of the ridge on features, of the one on the bias (which would otherwise sink
#: so far that one telling word is not enough), and of a score change by a swapped name.
RIDGE, BIAS_RIDGE, FAIRNESS = 1e-5, 4e-3, 4.0
#: Lengths of the word beginnings that count as features.
BEGINNINGS = (4, 5, 6)
#: Words that a task remembers the weights of.
REMEMBERED = 100_000

#: Names of groups, by family; within a family each may take another's place.
IDENTITY = (
    "people persons women men girls boys".split(),
    "person woman man girl boy".split(),
    "people gays lesbians homosexuals bisexuals transgender straights".split(),
    "person gay lesbian homosexual bisexual straight".split(),
    "people muslims christians jews hindus buddhists atheists catholics".split(),
    "person muslim christian jew hindu buddhist atheist catholic".split(),
    "people africans asians europeans americans mexicans latinos arabs immigrants refugees".split(),
    "person african asian european american mexican latino arab immigrant refugee".split(),
    "young old black white disabled blind deaf poor rich".split(),
    "menschen frauen männer muslime christen juden ausländer flüchtlinge".split(),
    "personnes femmes hommes musulmans chrétiens juifs immigrés réfugiés".split(),
    "personas mujeres hombres musulmanes cristianos judíos inmigrantes refugiados".split(),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


@dataclass(frozen=True)
class Model:
    """score = logistic(bias + sum of weights of the features that a document holds)."""

    weights: dict[str, float]
    bias: float


def features_of(word: str) -> list[str]:
    """A lower-cased word, and its beginnings (marked, so that they are not words)."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)]


def features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in features_of(w)}


def swaps(text: str) -> Iterator[tuple[set[str], set[str]]]:
    """The words of each sentence that names a group, as they are and with all places of one
    name taken by another of its family, for every such exchange."""
    for sentence in _SENTENCE.split(text.lower()):
        words = set(_WORD.findall(sentence))
        for name in sorted(words & _NAMES):
            for other in sorted({o for family in IDENTITY if name in family for o in family} - {name}):
                yield words, words - {name} | {other}


_NAMES = {name for family in IDENTITY for name in family}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """Learns from labelled documents outside the held-out fold; without any, every
    document scores one half less a little."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, SAMPLE, key, text)
    schema = T.StructType(
        [
            T.StructField("label", T.IntegerType()),
            T.StructField("held", T.ArrayType(T.StringType())),
            T.StructField("names", T.ArrayType(T.StringType())),
            T.StructField("text", T.StringType()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names = [{w for before, after in swaps(t) for w in before ^ after} for t in texts]
            columns = [
                batch.column(0),
                pa.array([sorted(features(t)) for t in texts], pa.list_(pa.string())),
                pa.array([sorted(n) for n in names], pa.list_(pa.string())),
                # only texts that name a group are read again
                pa.array([t if n else None for t, n in zip(texts, names, strict=True)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = settled(
        sample.select("label", "text").mapInArrow(read, schema).withColumn("row", F.monotonically_increasing_id())
    )
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n, bad = sum(sizes.values()), sizes.get(1, 0)
    if bad in (0, n):
        return Model({}, float(np.log((bad + 1) / (n - bad + 2))))
    # Only features of toxic documents, so that no wealth of harmless words hides them.
    held = rows.select("label", F.explode("held").alias("feature")).groupBy("feature")
    counts = held.agg(F.count("*").alias("n"), F.sum("label").alias("bad")).where(F.col("n") >= SUPPORT)
    share = bad / n
    telling = F.pow(F.col("bad") - F.col("n") * share, 2) / (F.col("n") * share * (1 - share))
    more = counts.where((F.col("bad") > F.col("n") * share) & (telling >= TELLING))
    best = more.select("feature", telling.alias("t")).orderBy(F.desc("t"), "feature").limit(FEATURES).collect()
    chosen = [r["feature"] for r in best]
    names = [r["name"] for r in rows.select(F.explode("names").alias("name")).distinct().collect()]  # of IDENTITY
    chosen += sorted({f for name in names for f in features_of(name)} - set(chosen))
    number = {f: i for i, f in enumerate(chosen)}
    # only the chosen features of the sample come to the driver
    known = F.broadcast(docs.sparkSession.createDataFrame(list(number.items()), "feature string, number int"))
    kept = (
        rows.select("row", F.explode("held").alias("feature"))
        .join(known, "feature")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("number")).alias("held"))
    )
    data = rows.select("row", "label").join(kept, "row", "left").orderBy("row").collect()
    held_by = [np.array(r["held"] or [], np.int64) for r in data]
    y = np.array([r["label"] for r in data], float)
    changes = _changes(rows.where("text IS NOT NULL").select("text"), number)
    # The more telling a feature, the further its weight may go: a beginning that many
    # toxic words share is learned before each of those words.
    scale = np.full(len(chosen), 0.5)
    scale[: len(best)] = np.sqrt([r["t"] / best[0]["t"] for r in best])
    weights, bias = _regress(held_by, y, scale, Swaps.of(changes, n))
    return Model({f: float(w) for f, w in zip(chosen, weights, strict=True) if w}, float(bias))


def _changes(texts: DataFrame, number: dict[str, int]) -> list:
    """(before, after, count) of the swapped sentences: their features by number, how often."""
    schema = "before array<int>, after array<int>, n long"

    def known(words: set[str]) -> tuple[int, ...]:
        return tuple(sorted({number[f] for w in words for f in features_of(w) if f in number}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, int] = {}
            for text in batch.column(0):
                for before, after in swaps(text.as_py()):
                    swap = known(before), known(after)
                    counts[swap] = counts.get(swap, 0) + 1
            columns = list(zip(*((b, a, n) for (b, a), n in counts.items()), strict=True)) or [[], [], []]
            types = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["before", "after", "n"])

    found = texts.mapInArrow(run, schema).groupBy("before", "after").agg(F.sum("n").alias("n")).where("before != after")
    return found.orderBy(F.desc("n"), "before", "after").limit(SWAPS).collect()


@dataclass(frozen=True)
class Swaps:
    """Swapped sentences as sparse rows: of each entry the row and the feature, for the
    sentences before and after; of each row its share of the penalty."""

    before: tuple[np.ndarray, np.ndarray]
    after: tuple[np.ndarray, np.ndarray]
    share: np.ndarray

    @classmethod
    def of(cls, changes: list, n: int) -> Swaps:
        """From (before, after, count), for a sample of n documents."""

        def entries(side: int) -> tuple[np.ndarray, np.ndarray]:
            held = [np.array(c[side], np.int64) for c in changes]
            return np.repeat(np.arange(len(held)), [len(h) for h in held]), np.concatenate([*held, np.zeros(0, np.int64)])

        return cls(entries(0), entries(1), np.array([c[2] / n for c in changes], float))

    def penalty(self, weights: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
        """The squared changes of the sentences' scores, added up by share, and its gradient
        by the weights and by the bias."""
        rows, width = len(self.share), len(weights)
        scores = [logistic(np.bincount(r, weights[f], rows) + bias) for r, f in (self.before, self.after)]
        change = scores[0] - scores[1]
        slopes = [2 * self.share * change * p * (1 - p) for p in scores]
        by_weight = [np.bincount(f, x[r], width) for (r, f), x in zip((self.before, self.after), slopes, strict=True)]
        return float((self.share * change**2).sum()), by_weight[0] - by_weight[1], float((slopes[0] - slopes[1]).sum())


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _regress(held: list[np.ndarray], y: np.ndarray, scale: np.ndarray, swapped: Swaps, steps: int = 600) -> tuple[np.ndarray, float]:
    """Adam on the logistic loss (both labels count the same in all), a ridge, and the
    penalty for changes of score."""
    n, width = len(y), len(scale)
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    lengths = np.array([len(h) for h in held])
    columns = np.concatenate([*held, np.zeros(0, np.int64)])
    rows = np.repeat(np.arange(n), lengths)
    theta = np.zeros(width + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights = theta[:-1] * scale
        error = (logistic(np.bincount(rows, weights[columns], n) + theta[-1]) - y) * share
        gradient = np.append(np.bincount(columns, error[rows], width) * scale, error.sum())
        gradient += 2 * np.append(np.full(width, RIDGE), BIAS_RIDGE) * theta
        if len(swapped.share):
            _, by_weight, by_bias = swapped.penalty(weights, theta[-1])
            gradient += FAIRNESS * np.append(by_weight * scale, by_bias)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:-1] * scale, theta[-1]


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """The score of a whole text, 0 to 1; a null text counts as empty. The model has a
    bounded number of features and is broadcast."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf(T.DoubleType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        (weights, bias), known = shared.value, {}
        for batch in batches:
            scores = []
            for value in batch:
                found: dict[str, float] = {}
                for word in set(_WORD.findall((value.as_py() or "").lower())):
                    own = known.get(word)
                    if own is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        own = known[word] = {f: weights[f] for f in features_of(word) if f in weights}
                    if own:
                        found |= own
                z = bias + sum(sorted(found.values()))
                scores.append(logistic(z))
            yield pa.array(scores, pa.float64())

    return run(text)
