"""Mixing sources to target weights, by budgets over a domain-language-source tree.

Only DataFrame functions. A budget of tokens goes down the tree by weight. A node cannot
take more than its documents offer (their tokens times max_epochs); what it leaves goes
to its siblings first and, as a parent's own offer is the sum of its children's, to the
siblings of an ancestor only when a whole family is short.

Each leaf then takes whole epochs and, of one further epoch in a seeded order, the
prefix that its budget still pays for. A leaf may hold a third of all rows: the prefix
is found from token sums of BUCKETS ranges of the seeded order, and only the rows of the
range in which the prefix ends are ordered. The result of the search is one row per
leaf, so documents are filtered where they are, without a shuffle of texts unless the
leaves are too many to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.llm.common import free_name, settled

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of the seeded order that name a range: 4096 ranges a leaf.
DIGITS = 3
#: Up to this many leaves (a few MB) the cuts are broadcast; more are joined by leaf.
BROADCAST_LEAVES = 50_000


@dataclass(frozen=True)
class Mix:
    """Weights (whole numbers, by level and name; OTHER for names not listed), the budget
    in percent of the tokens that there are, and how often a document may be used."""

    weights: Mapping[str, Mapping[str, int]] = field(
        default_factory=lambda: {
            "domain": {"crawl": 35, "curated": 65},
            "lang": {"en": 60, "de": 15, "fr": 15, "es": 10},
            "source": {},
        }
    )
    percent: int = 100
    max_epochs: int = 4
    seed: int = 17
    bulk: tuple[str, ...] = ("src0",)  # sources of the domain crawl; all others: curated


OTHER = 1


def n_tokens(text: Column) -> Column:
    """A text's words, as a measure of its tokens; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def leaf_of(mix: Mix) -> list[Column]:
    """domain, lang and source; nulls count as the empty name."""
    source = F.coalesce(F.col("source"), F.lit(""))
    domain = F.when(source.isin(*mix.bulk), F.lit("crawl")).otherwise(F.lit("curated"))
    return [domain.alias("domain"), F.coalesce(F.col("lang"), F.lit("")).alias("lang"), source.alias("source")]


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """domain, lang, source, tokens -> the same and budget. Rounding leaves less than one
    token per node unassigned."""
    nodes = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    total = nodes.agg(
        F.coalesce(F.expr(f"sum(tokens) * {mix.percent} div 100"), F.lit(0)).cast("long").alias("budget"),
        F.coalesce(F.sum("cap"), F.lit(0)).alias("offer"),
    ).select(F.least("budget", "offer").alias("budget"))
    above = None
    for depth in range(1, len(LEVELS) + 1):
        path, parents = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
        level = nodes.groupBy(*path).agg(F.sum("cap").alias("cap"))
        given = level.crossJoin(F.broadcast(total)) if above is None else level.join(above, parents)
        above = _poured(given, path, parents, mix.weights.get(LEVELS[depth - 1], {}))
    return leaves.join(above, list(LEVELS))


def _poured(given: DataFrame, path: list[str], parents: list[str], weights: Mapping[str, int]) -> DataFrame:
    """Splits each parent's `budget` among its children by weight, none above its cap."""
    name = F.col(path[-1])
    weight = F.lit(OTHER)
    for key, value in weights.items():
        weight = F.when(name == key, F.lit(value)).otherwise(weight)
    family = Window.partitionBy(*parents).orderBy(F.asc_nulls_last("full_at"), path[-1])
    so_far = family.rowsBetween(Window.unboundedPreceding, -1)
    to_come = family.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ordered = (
        given.withColumn("weight", weight.cast("long"))
        .withColumn("full_at", F.expr("CAST(cap AS DOUBLE) / nullif(weight, 0)"))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(so_far), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(to_come))
        # full: its share of what is left is more than it can take; the later are not
        .withColumn("is_full", F.expr("weight > 0 AND cap * rest <= left * weight"))
    )
    whole = Window.partitionBy(*parents)
    first = F.min_by(F.struct("left", "rest"), F.when(~F.col("is_full"), F.struct(F.coalesce("full_at", F.lit(float("inf"))), name)))
    shared = ordered.withColumn("first", first.over(whole))
    budget = F.when(F.col("is_full"), F.col("cap")).otherwise(
        F.coalesce(F.expr("first.left * weight div nullif(first.rest, 0)"), F.lit(0))
    )
    return shared.select(*path, budget.cast("long").alias("share")).withColumnRenamed("share", "budget")


def place(key: Column, epochs: Column, mix: Mix) -> Column:
    """Where a document stands in the seeded order of a leaf's epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epochs.cast("string"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def cuts(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per leaf: domain, lang, source, tokens, budget, epochs (taken whole) and cut
    (documents before this place in the next epoch's order are taken once more; null:
    none)."""
    narrow = settled(docs.select(F.col(key).alias("key"), *leaf_of(mix), n_tokens(F.col(text)).alias("n")))
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    epochs = F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 1 END")
    goals = settled(
        budgets(leaves, mix)
        .withColumn("epochs", epochs)
        .withColumn("open", F.col("budget") - F.col("epochs") * F.col("tokens"))
    )
    placed = narrow.join(goals.where("open > 0").select(*LEVELS, "epochs", "open"), list(LEVELS)).select(
        *LEVELS, "open", "n", place(F.col("key"), F.col("epochs"), mix).alias("place")
    )
    placed = placed.withColumn("bucket", F.substring("place", 1, DIGITS))
    leaf = Window.partitionBy(*LEVELS)
    sums = (
        placed.groupBy(*LEVELS, "bucket")
        .agg(F.sum("n").alias("n"), F.first("open").alias("open"))
        .withColumn("upto", F.sum("n").over(leaf.orderBy("bucket")))
    )
    last = (
        sums.where("upto > open")
        .groupBy(*LEVELS)
        .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("ahead")), "bucket").alias("b"))
        .select(*LEVELS, F.col("b.bucket").alias("bucket"), F.col("b.ahead").alias("ahead"))
    )
    # rows of the same place are one step, so that repeated rows have one result
    steps = placed.join(last, [*LEVELS, "bucket"]).groupBy(*LEVELS, "place", "open", "ahead").agg(F.sum("n").alias("n"))
    ends = (
        steps.withColumn("upto", F.col("ahead") + F.sum("n").over(leaf.orderBy("place")))
        .where("upto > open")
        .groupBy(*LEVELS)
        .agg(F.min("place").alias("cut"))
    )
    return settled(goals.drop("open").join(ends, list(LEVELS), "left"))


def mixed(docs: DataFrame, ends: DataFrame, mix: Mix = Mix(), key: str = "doc_id") -> DataFrame:
    """The documents that `cuts` takes, with all their columns and `copies` (how often; a
    longer name if that one is taken). Rows of the same key share a place in the order and
    are taken together. Empty texts cost nothing and are taken with their place."""
    names = [free_name(docs, f"mix_{x}") for x in (*LEVELS, "epochs", "cut")]
    level, (epochs, cut) = names[:3], names[3:]
    copies = free_name(docs, "copies")
    goals = ends.select(*(F.col(x).alias(n) for x, n in zip((*LEVELS, "epochs", "cut"), names, strict=True)))
    if goals.count() <= BROADCAST_LEAVES:
        goals = F.broadcast(goals)
    leaf = F.struct(*leaf_of(mix))
    same = [leaf[x] == F.col(n) for x, n in zip(LEVELS, level, strict=True)]
    more = F.coalesce((place(F.col(key), F.col(epochs), mix) < F.col(cut)).cast("long"), F.lit(0))
    return (
        docs.join(goals, same)
        .withColumn(copies, F.col(epochs) + more)
        .where(F.col(copies) > 0)
        .select(*(docs[c] for c in docs.columns), copies)
    )
