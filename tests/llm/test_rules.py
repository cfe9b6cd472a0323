import random
import re
from collections import Counter

from loanpanel.llm import rules

SPACE = r"[\x20\x09-\x0D]"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] >= 2 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
    }


def test_measures_against_brute_force():
    rng = random.Random(1)
    for _ in range(500):
        bits = ["a", "b", "Ab", "é", "#", "|", "\n", " ", "\t", "\x0b", " ", "\x1c", " ", "😀", "\r\n"]
        text = " ".join(rng.choices(bits, k=rng.randrange(0, 40))) if rng.random() < 0.8 else "".join(rng.choices(bits, k=30))
        found = dict(zip(rules.MEASURES, rules.measure(text), strict=True))
        expected = brute(text)
        assert {k: found[k] for k in expected} == expected, text


def test_edges():
    assert rules.measure(None) == rules.measure("") == (0,) * 8
    assert rules.measure("a") == (1, 1, 0, 1, 0, 0, 0, 0)
    assert rules.measure("a b " * 50_000)[5] == 100_000
    assert rules.measure("THE THE the ÉÉ")[6:] == (1, 2)


def test_policies_and_ablation(spark):
    good = " ".join(f"word{i} and{i}" for i in range(60))
    rows = [(1, good), (2, "few words"), (3, "a b c " * 60), (4, "w# x* y% z& " * 30), (5, None), (5, None)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fails string")
    entries = rules.ledger(docs)
    found = [(r.doc_id, r.base, r.v1) for r in entries.select("doc_id", rules.passes("base").alias("base"), rules.passes("v1").alias("v1")).orderBy("doc_id").collect()]
    assert found == [(1, True, True), (2, False, False), (3, False, False), (4, False, False), (5, False, False), (5, False, False)]
    ablation = {r.rule: (r.n_failed, r.n_alone, r.n_rejected) for r in rules.ablation(entries, "base").collect()}
    assert ablation == {"few_words": (3, 3, 5), "repeated_windows": (2, 2, 5)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    entries = rules.ledger(empty)
    assert entries.columns == ["doc_id", *rules.MEASURES, "fails"]
    assert entries.count() == 0
    assert rules.ablation(entries, "v2").count() == 0


def test_bits_are_unique():
    assert len({r.bit for r in rules.RULES}) == len(rules.RULES)
    assert all(set(p) <= {r.name for r in rules.RULES} for p in rules.POLICIES.values())
