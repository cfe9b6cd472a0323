"""Secrets in texts: three base patterns, and strings that look random to a pair of Markov
models.

One model of characters is learned from random strings, the other from ordinary
identifiers; a string's score is the sum of the log-likelihood ratios of its steps from
character to character, from the border in and out again. The ratios are kept in whole
thousandths, so a score is exact whatever the order of adding.

The labelled samples are the strings of the documents themselves: what a base pattern found
is random; every other string of SAMPLE characters or more is ordinary, but for those that
the model is to judge (CANDIDATE characters or more, of several kinds), which have no label:
among them are the secrets that no pattern knows. All documents are counted; a task hands on one number per pair of characters and class. More samples, of kinds
that the patterns do not know, can be given as a table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import small_batches

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_STRINGS = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
#: Characters of a string that is counted, and of one that may be a secret.
SAMPLE, CANDIDATE = 8, 16
#: A string is a secret from so many nats in all, and for each of its characters.
NATS, NATS_EACH = 12.0, 0.4

# The base patterns, the least characters of a match (of its last group, if
# it has groups), in the order in which kinds are sorted.
PATTERNS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I, 8),
    ("access", r"AKIA[A-Z0-9]+", re.A, 16),
    ("hex", r"[0-9a-f]+", re.A, 32),
)
ADDED = "random"
KINDS = (*(p[0] for p in PATTERNS), ADDED)
_ASSIGN, _ACCESS, _HEX = (re.compile(p, flags) for _, p, flags, _ in PATTERNS)
_ASSIGN_LEAST, _ACCESS_LEAST, _HEX_LEAST = (p[3] for p in PATTERNS)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CODE = np.zeros(128, np.int64)  # 0: the border
_CODE[np.frombuffer(SIGNS.encode(), np.uint8)] = np.arange(1, len(SIGNS) + 1)
STATES = len(SIGNS) + 1
_SAMPLES, _CANDIDATES = re.compile(_STRINGS % SAMPLE), re.compile(_STRINGS % CANDIDATE)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of what the base patterns find, sorted.

    A pattern takes the leftmost matches that do not overlap; matches that are too short
    are dropped afterwards and do not give way to others. Keys of the other two kinds have
    only characters of strings, and are looked for inside long strings.
    """
    found = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_LEAST]
    for string in _CANDIDATES.finditer(text):
        start, end = string.span()
        for kind, pattern, least in ((1, _ACCESS, _ACCESS_LEAST), (2, _HEX, _HEX_LEAST)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text, start, end) if m.end() - m.start() >= least]
    return sorted(found)


def _pairs(strings: list[str]) -> np.ndarray:
    """How often each pair of characters stands in the strings, borders included."""
    codes = _CODE[np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("ascii"), np.uint8)]
    return np.bincount(codes[:-1] * STATES + codes[1:], minlength=STATES**2) if strings else np.zeros(STATES**2, np.int64)


def samples_of(text: str) -> tuple[list[str], list[str]]:
    """The ordinary and the random strings of a text: strings that touch no base match and
    are no candidates, and the last groups of base matches."""
    base = base_spans(text)
    random = []
    for start, kind, end in base:
        value = _ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end]
        random += _SAMPLES.findall(value)
    free = _outside(base)
    return [m.group() for m in _SAMPLES.finditer(text) if free(*m.span()) and not is_candidate(m.group())], random


def is_candidate(string: str) -> bool:
    """Is it long enough, and has it two of digits, small and capital letters?"""
    if len(string) < CANDIDATE:
        return False
    return any(map(str.isdigit, string)) + any(map(str.islower, string)) + any(map(str.isupper, string)) >= 2


def _outside(spans: list[tuple[int, int, int]]):
    """Says of intervals, asked from left to right, whether they touch no span."""
    at, reach = 0, 0

    def free(start: int, end: int) -> bool:
        nonlocal at, reach
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][2])
            at += 1
        return reach <= start

    return free


class Model:
    """Log-likelihood ratios of pairs of characters, in thousandths of a nat."""

    def __init__(self, ordinary: np.ndarray, random: np.ndarray):
        self.ratios = np.rint(1000 * (self._logs(random) - self._logs(ordinary))).astype(np.int64)

    @staticmethod
    def _logs(counts: np.ndarray) -> np.ndarray:
        """Of each next character given the one before; every pair counts once more."""
        counts = counts.reshape(STATES, STATES).astype(float) + 1
        return np.log(counts / counts.sum(1, keepdims=True))

    def score(self, string: str) -> int:
        codes = _CODE[np.frombuffer(f"\n{string}\n".encode("ascii"), np.uint8)]
        return int(self.ratios[codes[:-1], codes[1:]].sum())

    def is_secret(self, string: str) -> bool:
        """Is it a candidate, and does it look random?"""
        return is_candidate(string) and self.score(string) >= max(1000 * NATS, 1000 * NATS_EACH * len(string))


def fit(docs: DataFrame, text: str = "text", samples: DataFrame | None = None) -> Model:
    """The model of all strings of `docs`, and of `samples` (value string, is_random
    boolean; its strings are taken the same way, null rows are left out) if given.

    At most two numbers per pair of characters come to the driver. Without any string,
    every score is 0 and nothing is a secret.
    """
    small_batches(docs.sparkSession)

    def counted(rows: DataFrame, strings) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = [np.zeros(STATES**2, np.int64) for _ in range(2)]
            for batch in batches:
                found: tuple[list, list] = ([], [])
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for mine, more in zip(found, strings(*row), strict=True):
                        mine += more
                for total, mine in zip(counts, found, strict=True):
                    total += _pairs(mine)
            for label, total in enumerate(counts):
                cells = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cells), label), pa.int32()), pa.array(cells, pa.int32()), pa.array(total[cells])],
                    names=["label", "cell", "n"],
                )

        return rows.mapInArrow(run, "label int, cell int, n long")

    counts = counted(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")), samples_of)
    if samples is not None:
        given = samples.where("value IS NOT NULL AND is_random IS NOT NULL").select("value", "is_random")
        own = lambda value, is_random: ([], _SAMPLES.findall(value)) if is_random else (_SAMPLES.findall(value), [])
        counts = counts.unionByName(counted(given, own))
    tables = np.zeros((2, STATES**2), np.int64)
    for r in counts.groupBy("label", "cell").agg(F.sum("n").alias("n")).collect():
        tables[r.label, r.cell] = r.n
    return Model(*tables)


def spans(text: str, model: Model) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the base spans, which always stay, and of the secrets
    among the strings that touch none of them; sorted."""
    base = base_spans(text)
    free = _outside(base)
    added = [
        (m.start(), len(PATTERNS), m.end())
        for m in _CANDIDATES.finditer(text)
        if free(*m.span()) and model.is_secret(m.group())
    ]
    return sorted(base + added)


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, and spans, an array of (start, end, kind; code
    points, end exclusive) sorted by start and then in the order of KINDS.

    A null text is empty; null keys and repeated rows give rows like others. Other columns
    are not read, whatever their names.
    """
    small_batches(docs.sparkSession)
    span = T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]
    )
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("spans", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in spans(t.as_py() or "", model)] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, arrow)], names=["key", "spans"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    return rows.select(F.col("key").alias(key), "spans")
