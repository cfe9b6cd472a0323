"""Quality rules as a ledger: every rule is evaluated once, and a document's failures are
bits of one number beside its measurements.

A policy is a version of a mask: a document passes if it fails none of the mask's rules,
so a new policy, or the question what a rule alone rejects, reads only the ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.llm.common import small_batches

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words",  # runs of characters other than SPACES
    "word_chars",  # code points in words
    "n_symbols",  # characters of SYMBOLS
    "n_lines",  # lines with a word
    "n_dup_lines",  # of those, lines equal to an earlier one
    "n_repeat_words",  # words in three-word windows that occur twice or more
    "n_stutter",  # words equal to the word before
    "n_shouted",  # words with A-Z and without a-z
)


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # SQL over the measurements


#: A rule keeps its bit for ever; a changed rule gets a new one.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 50 * n_words"),
    Rule(3, "stutter", "100 * n_stutter > 20 * n_words"),
    Rule(4, "shouting", "100 * n_shouted > 50 * n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(6, "word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)
#: Rules by policy version.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "stutter", "shouting"),
    "v2": tuple(r.name for r in RULES),
}


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text; a null text is empty."""
    text = text or ""
    words = text.encode("utf-8").split()  # of bytes: splits at SPACES and nothing else
    seen, n_lines, n_dup_lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            n_lines += 1
            if line in seen:
                n_dup_lines += 1
            seen.add(line)
    n = len(words)
    n_repeat = n_stutter = 0
    if n:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
        n_stutter = int((ids[1:] == ids[:-1]).sum())
        if n >= 3:
            _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
            _, which, counts = np.unique(
                pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True
            )
            again = counts[which] >= 2
            inside = np.zeros(n, bool)
            for shift in range(3):
                inside[shift : n - 2 + shift] |= again
            n_repeat = int(inside.sum())
    return (
        n,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        n_lines,
        n_dup_lines,
        n_repeat,
        n_stutter,
        sum(w.isupper() for w in words),
    )


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, the measurements, and fails (bigint, a bit per
    failed rule). Other columns are not read; repeated rows give repeated rows."""
    small_batches(docs.sparkSession)
    fields = [pa.field(m, pa.int64()) for m in MEASURES]
    schema = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

    @F.arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = zip(*(measure(t.as_py()) for t in batch), strict=True) if len(batch) else [[]] * len(fields)
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=fields)

    measured = docs.select(F.col(key).alias(key), run(F.col(text)).alias("m")).select(key, "m.*")
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES]
    fails = bits[0]
    for bit in bits[1:]:
        fails = fails.bitwiseOR(bit)
    return measured.withColumn("fails", fails)


def mask(policy: str) -> int:
    return sum(1 << r.bit for r in RULES if r.name in POLICIES[policy])


def passes(policy: str, fails: str = "fails") -> Column:
    return F.col(fails).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does, from the ledger alone: rule, n_failed, n_alone
    (rejected by this rule only: kept if it were dropped), n_rejected (by the policy).

    The ledger is first counted by its bit patterns, of which there are at most two to
    the number of rules, so only counts meet.
    """
    own = F.col("fails").bitwiseAND(F.lit(mask(policy)).cast("long"))
    patterns = entries.groupBy(own.alias("pattern")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES if r.name in POLICIES[policy]))
    bit = F.col("r.bit")
    total = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    return (
        patterns.select("pattern", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            total(F.col("pattern").bitwiseAND(bit) != 0).alias("n_failed"),
            total(F.col("pattern") == bit).alias("n_alone"),
            total(F.col("pattern") != 0).alias("n_rejected"),
        )
    )
