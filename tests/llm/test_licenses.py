import math
import random
import re

import pytest
from pyspark.sql import functions as F

from loanpanel.llm import licenses
from loanpanel.llm.licenses import PHRASES, STRIDE, TEMPLATES, THRESHOLD


def scanned(spark, texts):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, labels string, words int")
    return {r.doc_id: r for r in licenses.scan(frame).collect()}


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [
        (i, label)
        for p, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(p.split())] == p.split()
    ]
    matches = set()
    for block in range(0, math.ceil(len(words) / STRIDE) or 1):
        own = set(words[block * STRIDE : (block + 2) * STRIDE])
        for t, label in TEMPLATES:
            n = len(set(t.split()))
            k = len(own & set(t.split()))
            if k >= math.ceil(THRESHOLD * n - 1e-9):
                matches.add((label, k / n))
    base = sorted({label for _, label in places})
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min((i for i, _ in places), default=None),
        "last_word": max((i for i, _ in places), default=None),
        "base_labels": base,
        "labels": sorted({*base, *(label for label, _ in matches)}),
        "score": 1.0 if places else max((s for _, s in matches), default=0.0),
    }


def check(spark, texts):
    found = scanned(spark, texts)
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        row = found[i].asDict()
        assert {k: row[k] for k in brute(text)} == brute(text), text


def test_places(spark):
    check(
        spark,
        [
            "Released under the MIT License.",
            "cc by nc cc by nc",
            "CC-BY-NC 4.0",
            "under  the\nmit -- license; under the mit license",
            "cc by ncx, xcc by nc, ccbync",
            "Apache License, Version 2.0",
            "apache license version 20",
            "under the mit licensé",
            "",
            None,
            "   \n",
            "café " * 70 + "cc by nc",
            "word " * 40_000 + "under the mit license",
        ],
    )


def test_blocks_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = "the of and a license public software terms x y z gnu version 3 is".split()
    texts = []
    for _ in range(150):
        words = rng.choices(vocabulary, k=rng.randrange(0, 150))
        notice = rng.choice(TEMPLATES)[0].split()
        kept = [w for w in notice if rng.random() > rng.choice([0, 0.15, 0.4])]
        at = rng.randrange(len(words) + 1)
        texts.append(" ".join([*words[:at], *kept, *words[at:]]))
    check(spark, texts)


def long_templates(rng, n):
    """As many notices of up to 300 words, of partly common words."""
    common = [f"c{i}" for i in range(40)]
    for i in range(n):
        own = [f"t{i}x{j}" for j in range(rng.randrange(1, 200))]
        yield " ".join(own + rng.choices(common, k=rng.randrange(0, 100))), f"l{i % 7}"


def test_many_long_templates_against_brute_force(spark):
    rng = random.Random(8)
    templates = list(long_templates(rng, 80))
    texts = []
    for _ in range(60):
        words = rng.choices([f"c{i}" for i in range(60)], k=rng.randrange(0, 400))
        for _ in range(rng.randrange(3)):
            notice = [w for w in rng.choice(templates)[0].split() if rng.random() > rng.choice([0, 0.1, 0.25])]
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licenses.scan(docs, templates=templates)
    rows = {r.doc_id: [tuple(m) for m in r.matches] for r in found.collect()}
    total = 0
    for i, text in enumerate(texts):
        words, expected = text.split(), []
        for t, label in templates:
            own = set(t.split())
            stride = max(STRIDE, 2 ** math.ceil(math.log2(len(own))))
            for block in range(math.ceil(len(words) / stride)):
                k = len(own.intersection(words[block * stride : (block + 2) * stride]))
                if k >= math.ceil(THRESHOLD * len(own) - 1e-9):
                    expected.append((stride, block, label, k, k / len(own)))
        assert sorted(rows[i]) == sorted(expected)
        total += len(expected)
    assert total > 30
    # the plan does not grow with the templates
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(found) < 1.1 * size(licenses.scan(docs, templates=templates[:1]))


def test_filters_leave_few_pairs_to_compare():
    rng = random.Random(9)
    templates = list(long_templates(rng, 100))
    words = sorted({w for t, _ in templates for w in t.split()}, key=lambda w: (w[0] == "c", w))
    index = licenses.Index(templates, words, THRESHOLD)
    text = [w.encode() for w in rng.choices([f"c{i}" for i in range(40)], k=2000) + templates[5][0].split()]
    assert any(m[2] == templates[5][1] for m in index.matches(text))
    pairs = sum(math.ceil(len(text) / stride) for _, _, stride, _ in index.templates)
    assert index.compared < 0.1 * pairs


def test_templates_without_words(spark):
    docs = spark.createDataFrame([(1, "cc by nc")], "doc_id long, text string")
    for wrong in ({"templates": [(" ", "x")]}, {"phrases": {"": "x"}}):
        with pytest.raises(ValueError, match="without a word"):
            licenses.scan(docs, **wrong)
    row = licenses.scan(docs, templates=[]).first()
    assert (row.n_base, row.labels, row.matches) == (1, ["cc-by-nc"], [])


def test_rarest_words_first(spark):
    docs = spark.createDataFrame([("gnu gnu gnu mit",), (None,)], "text string")
    order = licenses.word_order(docs, [("gnu mit bsd", "x")])
    assert order == ["bsd", "mit", "gnu"]


def test_empty_table_and_repeats(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(frame).count() == 0
    frame = spark.createDataFrame([(1, "cc by nc"), (1, "cc by nc"), (None, "cc by nc")], "doc_id long, text string")
    assert licenses.scan(frame).where(F.col("n_base") == 1).count() == 3
