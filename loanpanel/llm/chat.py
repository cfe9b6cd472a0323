"""Chat formatting by a declarative template and a finite-state machine over roles.

Only DataFrame functions. A turn becomes three segments (mark, text, mark) with a loss
flag each; the machine's state after a turn is its role, so whether a turn is allowed
depends on the role before it. A conversation may hold a third of all rows: it is cut
into stretches of CHUNK turn numbers, every window covers one stretch, and only one
summary row per stretch (its last role, its length) meets in a window per conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = "start"
#: Turn numbers in a stretch.
CHUNK = 1024


@dataclass(frozen=True)
class Speaker:
    """How the turns of a role are marked, and whether their text is learned."""

    before: str
    after: str
    learn: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, marks for any other role (whose name is written out, escaped), and
    the machine: the roles that may follow a state, and the states that may end it."""

    speakers: dict[str, Speaker]
    other: tuple[str, str, str]  # before the name, between name and text, after
    follows: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    escape: str = "␛"

    @property
    def controls(self) -> list[str]:
        """Every string that a text must not contain unescaped, longest first."""
        marks = {m for s in self.speakers.values() for m in (s.before, s.after)} | set(self.other)
        return sorted(marks, key=lambda m: (-len(m), m))


#: Marks in square and angle brackets; only assistant texts are learned.
INSTRUCT = Template(
    speakers={
        "system": Speaker("<<SYS>>", "<</SYS>>"),
        "user": Speaker("[INST]", "[/INST]"),
        "assistant": Speaker("<s>", "</s>", learn=True),
    },
    other=("[ROLE]", "[/ROLE]", "[/TURN]"),
    follows={
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    ends=("assistant",),
)


def escaped(text: Column, template: Template) -> Column:
    """Doubles the escape sign and puts one behind the first sign of a control string."""
    e = template.escape
    firsts = "|".join(f"{_quoted(m[0])}(?={_quoted(m[1:])})" for m in template.controls)
    doubled = F.replace(text, F.lit(e), F.lit(e + e))
    return F.regexp_replace(doubled, F.lit(firsts), F.lit("$0" + e))


def unescaped(text: Column, template: Template) -> Column:
    e = template.escape
    return F.regexp_replace(text, F.lit(f"{e}({e}?)"), F.lit("$1"))


def format_turns(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per row of `conversations` (conv_id, turn, role, text; others unread):

    conv_id, position (from 0), role, allowed (by the machine), segments (array of
    text and loss), piece (their texts joined), start (code points before the piece in
    its conversation), loss_start and loss_chars (of the learned text as written; null
    if none is learned).

    Turns are ordered by turn (null first), then role, then text, so ties and repeated
    rows have one result. A null role counts as the empty name, a null text as empty, a
    null conv_id as a conversation of its own. An unknown role is never allowed, but is
    still written and read back.
    """
    turn = F.col("turn")
    chunk = F.coalesce(F.floor(turn / CHUNK), F.lit(-(1 << 60))).cast("long")
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = conversations.select(
        "conv_id", turn, role.alias("role"), F.coalesce("text", F.lit("")).alias("text"), chunk.alias("chunk")
    )
    inner = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    so_far = inner.rowsBetween(Window.unboundedPreceding, -1)
    segments = _segments(template)
    rows = (
        rows.withColumn("segments", segments)
        .withColumn("piece", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .withColumn("rank", F.row_number().over(inner) - 1)
        .withColumn("before", F.lag("role").over(inner))
        .withColumn("shift", F.coalesce(F.sum(F.length("piece")).over(so_far), F.lit(0)))
    )
    outer = Window.partitionBy("conv_id").orderBy("chunk")
    earlier = outer.rowsBetween(Window.unboundedPreceding, -1)
    stretches = (
        rows.groupBy("conv_id", "chunk")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.length("piece")).alias("chars"),
            F.max_by("role", "rank").alias("last"),
        )
        .select(
            F.col("conv_id").alias("c"),
            F.col("chunk").alias("k"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
            F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("offset"),
            F.lag("last").over(outer).alias("carried"),
        )
    )
    state = F.coalesce("before", "carried", F.lit(START))
    allowed = reduce(
        lambda found, step: found | ((state == step[0]) & F.col("role").isin(*step[1])),
        template.follows.items(),
        F.lit(False),
    )
    start = F.col("offset") + F.col("shift")
    learned = F.get(F.filter("segments", lambda s: s["loss"]), F.lit(0))["text"]
    ahead = F.length(F.get("segments", F.lit(0))["text"])
    return rows.join(
        stretches, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))
    ).select(
        "conv_id",
        (F.col("first") + F.col("rank")).alias("position"),
        "role",
        allowed.alias("allowed"),
        "segments",
        "piece",
        start.alias("start"),
        F.when(learned.isNotNull(), start + ahead).alias("loss_start"),
        F.length(learned).alias("loss_chars"),
    )


def assemble(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation of `format_turns`: conv_id, formatted, loss_spans (start
    and chars, in order), valid (every turn allowed, and it may end there).

    A conversation's text is one value here, as its reader wants it. It is put together
    in two steps, stretches of positions first, so that a long one is not sorted whole.
    """
    turn = F.struct(
        "position", "piece", F.struct(F.col("loss_start").alias("start"), F.col("loss_chars").alias("chars")).alias("span")
    )
    stretches = (
        turns.groupBy("conv_id", F.floor(F.col("position") / CHUNK).alias("chunk"))
        .agg(
            F.sort_array(F.collect_list(turn)).alias("turns"),
            F.min("allowed").alias("allowed"),
            F.max_by("role", "position").alias("last"),
        )
        .select(
            "conv_id",
            "allowed",
            F.struct(
                "chunk",
                F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
                F.filter(
                    F.transform("turns", lambda t: t["span"]), lambda s: s["start"].isNotNull()
                ).alias("spans"),
                "last",
            ).alias("part"),
        )
    )
    parts = F.col("parts")
    return (
        stretches.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"), F.min("allowed").alias("allowed"))
        .select(
            "conv_id",
            F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("formatted"),
            F.flatten(F.transform(parts, lambda p: p["spans"])).alias("loss_spans"),
            (F.col("allowed") & F.element_at(parts, -1)["last"].isin(*template.ends)).alias("valid"),
        )
    )


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (array of role and text) of a formatted conversation."""
    name, middle, end = template.other
    marks = [(s.before, s.after) for s in template.speakers.values()]
    one = "|".join(f"{_quoted(a)}.*?{_quoted(b)}" for a, b in marks)
    one += f"|{_quoted(name)}.*?{_quoted(middle)}.*?{_quoted(end)}"

    def inside(turn: Column, before: str, after: str) -> Column:
        chars = F.length(turn) - len(before) - len(after)
        return unescaped(F.substring(turn, F.lit(len(before) + 1), chars), template)

    def parse(turn: Column) -> Column:
        own = F.substring_index(turn, middle, 1)
        rest = F.substring(turn, F.length(own) + 1, F.length(turn))
        found = F.struct(
            unescaped(F.substring(own, F.lit(len(name) + 1), F.length(own)), template).alias("role"),
            inside(rest, middle, end).alias("text"),
        )
        for role, s in template.speakers.items():
            known = F.struct(F.lit(role).alias("role"), inside(turn, s.before, s.after).alias("text"))
            found = F.when(F.startswith(turn, F.lit(s.before)), known).otherwise(found)
        return found

    return F.transform(F.regexp_extract_all(formatted, F.lit(f"(?s){one}"), F.lit(0)), parse)


def _segments(template: Template) -> Column:
    def three(before: Column, after: str, learn: bool) -> Column:
        return F.array(
            F.struct(before.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(F.col("text"), template).alias("text"), F.lit(learn).alias("loss")),
            F.struct(F.lit(after).alias("text"), F.lit(False).alias("loss")),
        )

    name, middle, end = template.other
    found = three(F.concat(F.lit(name), escaped(F.col("role"), template), F.lit(middle)), end, False)
    for role, s in template.speakers.items():
        found = F.when(F.col("role") == role, three(F.lit(s.before), s.after, s.learn)).otherwise(found)
    return found


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)
