import random

from pyspark.sql import functions as F

from loanpanel.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, position string"


def formatted(spark, rows, template=chat.INSTRUCT):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    written = chat.assemble(chat.format_turns(frame, template), template)
    return {
        r.conv_id: r
        for r in written.withColumn("turns", chat.read_back(F.col("formatted"), template)).collect()
    }


def plain(row):
    return [(t.role, t.text) for t in row.turns]


def learned(spark, row):
    return [row.formatted[s.start : s.start + s.chars] for s in row.loss_spans]


def test_marks_and_loss(spark):
    row = formatted(spark, [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo")])[1]
    assert row.formatted == "<<SYS>>be kind<</SYS>>[INST]hi[/INST]<s>yo</s>"
    assert learned(spark, row) == ["yo"]
    assert row.valid


def test_control_strings_come_back(spark):
    rng = random.Random(3)
    bits = [*chat.INSTRUCT.controls, "␛", "␛␛", "<", ">", "[", "/", "s", "\\", "$1", "\n", "é😀", ""]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["system", "user", "assistant", "tool", "[/ROLE]", "a␛<s>", ""])
            rows.append((conv, turn, role, "".join(rng.choices(bits, k=rng.randrange(12)))))
    found = formatted(spark, rows)
    for conv in range(60):
        mine = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert plain(found[conv]) == mine
        texts = [t for role, t in mine if role == "assistant"]
        spans = [found[conv].formatted[s.start : s.start + s.chars] for s in found[conv].loss_spans]
        unescaped = spark.createDataFrame([(x,) for x in spans] or [("",)], "x string").select(
            chat.unescaped(F.col("x"), chat.INSTRUCT).alias("x")
        )
        assert [r.x for r in unescaped.collect()] == (texts or [""])


def test_the_machine(spark):
    cases = {
        1: (["user", "assistant"], True),
        2: (["system", "user", "assistant", "user", "assistant"], True),
        3: (["user"], False),
        4: (["assistant", "user", "assistant"], False),
        5: (["user", "user", "assistant"], False),
        6: (["user", "system", "assistant"], False),
        7: (["user", "tool", "assistant"], False),
        8: (["system", "assistant"], False),
    }
    rows = [(c, i, role, "x") for c, (roles, _) in cases.items() for i, role in enumerate(roles)]
    found = formatted(spark, rows)
    assert {c: found[c].valid for c in cases} == {c: valid for c, (_, valid) in cases.items()}


def test_long_conversation_crosses_stretches(spark):
    n = 3 * chat.CHUNK + 7
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(n - 1)]
    row = formatted(spark, rows)[1]
    assert plain(row) == [(r, t) for _, _, r, t in rows]
    assert row.valid
    assert learned(spark, row) == [t for _, _, r, t in rows if r == "assistant"]


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "user", "z")]
    found = formatted(spark, rows)
    assert plain(found[1]) == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert plain(found[None]) == [("user", "z")]
    assert not found[1].valid


def test_empty_table_and_long_text(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert chat.assemble(chat.format_turns(frame)).count() == 0
    text = "<s>word " * 100_000
    row = formatted(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])[1]
    assert plain(row) == [("user", text), ("assistant", text)]


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x", "")], SCHEMA)
    plan = chat.assemble(chat.format_turns(frame))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_another_template(spark):
    template = chat.Template(
        speakers={"user": chat.Speaker("<|u|>", "<|e|>"), "assistant": chat.Speaker("<|a|>", "<|/a|>", learn=True)},
        other=("<|r|>", "<|t|>", "<|x|>"),
        follows={chat.START: ("user",), "user": ("assistant",), "assistant": ("user",)},
        ends=("assistant",),
    )
    row = formatted(spark, [(1, 0, "user", "a<|e|>b"), (1, 1, "assistant", "<|a|>")], template)[1]
    assert plain(row) == [("user", "a<|e|>b"), ("assistant", "<|a|>")]
