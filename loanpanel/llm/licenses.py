"""License scans: an exact set-similarity join of text blocks with notice templates.

A template of up to `stride` different words (STRIDE, or the next power of two for longer
ones) is compared with blocks of 2 * stride words, one every stride words, so that each
passage of up to stride words lies whole in a block. A block matches if it holds at least
THRESHOLD of the template's different words. Words are ordered by their frequency over all
documents, rarest first. To reach the needed overlap t of a template of n words, a block
must hold one of its n - t + 1 rarest words (prefix), must have t words of templates at all
(length), and behind the rarest word that both share there must be enough words left in
template and block (position). An index from prefix words to templates gives the pairs to
look at; those that pass all three are compared.

The templates are parameters of the job, of any number and length; they and their index go
to the tasks, and the plan does not grow with them. The documents are read twice, once to
count the templates' words and once to match, and never shuffled: what is shuffled are counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import small_batches

STRIDE = 32
THRESHOLD = 0.8

#: The phrases whose exact places count.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Short notices, as their licenses word them, lower case, words only.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("free and unencumbered software released into the public domain", "unlicense"),
)


#: Every byte that stands between words becomes a space. Bytes of other characters stay.
_BETWEEN = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a whole text, A-Z lower-cased: runs of digits, letters and characters
    beyond ASCII. A null text has none."""
    return (text or "").encode("utf-8").lower().translate(_BETWEEN).split()


def word_order(docs: DataFrame, templates: Sequence[tuple[str, str]], text: str = "text") -> list[str]:
    """The templates' words, rarest in `docs` first (ties by spelling).

    Counted over all documents; the result is as long as the templates have words.
    """
    small_batches(docs.sparkSession)
    vocabulary = {w.encode() for words, _ in templates for w in words.split()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(filter(vocabulary.__contains__, words_of(value.as_py())))
        names, n = [w.decode() for w in counts], list(counts.values())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    counts = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    found = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sorted({w.decode() for w in vocabulary}, key=lambda w: (found.get(w, 0), w))


class Index:
    """The templates by the words of their prefixes. Words are numbers, the rarest first."""

    def __init__(self, templates: Sequence[tuple[str, str]], order: Sequence[str], threshold: float):
        self.rank = {w.encode(): i for i, w in enumerate(order)}
        self.templates: list[tuple[list[int], int, int, str]] = []  # words, needed overlap, stride, label
        self.prefixes: dict[int, list[int]] = {}  # word: templates that have it in their prefix
        for number, (words, label) in enumerate(templates):
            own = sorted({self.rank[w.encode()] for w in words.split()})
            need = math.ceil(threshold * len(own) - 1e-9)
            stride = max(STRIDE, 1 << max(len(own) - 1, 0).bit_length())
            self.templates.append((own, need, stride, label))
            for word in own[: len(own) - need + 1]:
                self.prefixes.setdefault(word, []).append(number)
        self.compared = 0  # pairs of a block and a template that came to be compared

    def matches(self, words: list[bytes]) -> list[tuple[int, int, str, int, float]]:
        """(stride, block, label, overlap, containment) of every block and template that
        match, by template and block."""
        rank, templates = self.rank, self.templates
        known = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
        pairs = {
            (number, block)
            for i, word in known
            if word in self.prefixes
            for number in self.prefixes[word]
            for block in _blocks(i, templates[number][2])
        }
        if not pairs:
            return []
        held: dict[tuple[int, int], set[int]] = {}  # stride and block: its templates' words
        for stride in {templates[number][2] for number, _ in pairs}:
            for i, word in known:
                for block in _blocks(i, stride):
                    held.setdefault((stride, block), set()).add(word)
        found = []
        for number, block in sorted(pairs):
            own, need, stride, label = templates[number]
            here = held[stride, block]
            if len(here) < need:
                continue
            first = next(place for place, word in enumerate(own) if word in here)
            left = min(len(own) - first, sum(word >= own[first] for word in here))
            if left < need:
                continue
            self.compared += 1
            overlap = len(here.intersection(own))
            if overlap >= need:
                found.append((stride, block, label, overlap, overlap / len(own)))
        return found


def _blocks(place: int, stride: int) -> tuple[int, ...]:
    """The blocks that hold a place: the one that starts in its stride and the one before."""
    block = place // stride
    return (block - 1, block) if block else (0,)


def places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after another;
    places may share words."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        needle = f" {phrase} ".encode()
        at, start, word = joined.find(needle), 0, 0
        while at >= 0:
            word += joined.count(b" ", start, at)
            found.append((word, label))
            start, at = at, joined.find(needle, at + 1)
    return found


_MATCH = (("stride", T.IntegerType()), ("block", T.IntegerType()), ("label", T.StringType()), ("overlap", T.IntegerType()), ("containment", T.DoubleType()))
_MATCH_ARROW = pa.list_(
    pa.struct([("stride", pa.int32()), ("block", pa.int32()), ("label", pa.string()), ("overlap", pa.int32()), ("containment", pa.float64())])
)
_COLUMNS = (
    ("n_words", T.LongType(), pa.int64()),
    ("n_base", T.LongType(), pa.int64()),
    ("first_word", T.LongType(), pa.int64()),
    ("last_word", T.LongType(), pa.int64()),
    ("base_labels", T.ArrayType(T.StringType()), pa.list_(pa.string())),
    ("labels", T.ArrayType(T.StringType()), pa.list_(pa.string())),
    ("score", T.DoubleType(), pa.float64()),
    ("matches", T.ArrayType(T.StructType([T.StructField(n, t) for n, t in _MATCH])), _MATCH_ARROW),
)


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: key, n_words, n_base (places of all phrases), first_word
    and last_word (smallest and largest start of a place, else null), base_labels, labels
    (arrays, sorted: by phrases; by phrases or blocks), score (largest containment of a
    matching template, 1 where a phrase stands, else 0), matches (array of stride, block,
    label, overlap and containment).

    A null text has no words. Templates and phrases are lower-case words; one without a word
    is an error. Other columns are not read; repeated rows give repeated rows.
    """
    if not all(words.split() for words in (*phrases, *(t for t, _ in templates))):
        raise ValueError("a template or phrase without a word")
    small_batches(docs.sparkSession)
    order = word_order(docs, templates, text) if templates else []
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates, order, threshold))
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *(T.StructField(n, t) for n, t, _ in _COLUMNS)])

    def row(text: str | None, index: Index) -> tuple:
        words = words_of(text)
        base, found = places(words, phrases), index.matches(words)
        starts, labels = [i for i, _ in base], {label for _, label in base}
        score = 1.0 if base else max((m[4] for m in found), default=0.0)
        return (
            len(words),
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            sorted(labels),
            sorted(labels.union(m[2] for m in found)),
            score,
            [dict(zip((n for n, _ in _MATCH), m, strict=True)) for m in found],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*(row(t.as_py(), shared.value) for t in batch.column(1)), strict=True)
            arrays = [pa.array(list(c), t) for c, (_, _, t) in zip(columns, _COLUMNS, strict=True)]
            if arrays:
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    return rows.withColumnRenamed("key", key)
