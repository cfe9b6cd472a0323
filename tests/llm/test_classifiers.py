import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanpanel.llm import quality_knn, toxicity
from loanpanel.llm.common import held_out, labelled_sample

WORDS = [a + b + c for a in ("th", "re", "on", "an", "ti") for b in ("on", "es", "er", "ou") for c in ("a", "ly", "ing", "ed")]


def corpus(spark, texts, label):
    """texts: (text, label or None)"""
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, (t, _) in enumerate(texts)], "doc_id long, text string, score string, label string")
    labels = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(texts) if x is not None], f"doc_id long, {label} int")
    return docs, labels


def prose(rng, n, extra=()):
    words = rng.choices(WORDS, k=n)
    for w in extra:
        words.insert(rng.randrange(n), w)
    return " ".join(words).capitalize() + "."


def scores(spark, docs, model, module):
    return [r.s for r in docs.orderBy("doc_id").select(module.score(F.col("text"), model, spark).alias("s")).collect()]


def test_toxicity_on_unseen_endings(spark):
    rng = random.Random(0)
    endings = [a + b for a in "bcdfg" for b in ("ort", "ulm", "iva", "ope")]
    bad = lambda: "grumf" + rng.choice(endings)
    texts = [(prose(rng, 30, [bad() for _ in range(2)] if i % 8 == 0 else ()), int(i % 8 == 0)) for i in range(600)]
    docs, labels = corpus(spark, texts, "toxic")
    model = toxicity.fit(docs, labels)
    found = scores(spark, docs, model, toxicity)
    assert sum((s >= 0.5) == bool(x) for s, (_, x) in zip(found, texts, strict=True)) >= 595
    more = spark.createDataFrame([(1, prose(rng, 400, ["Grumfzzz", "grumfyyy"])), (2, prose(rng, 20_000)), (3, ""), (4, None)], "doc_id long, text string")
    assert [s >= 0.5 for s in scores(spark, more, model, toxicity)] == [True, False, False, False]


def names_corpus(rng):
    """Half of the abuse can be told by a word, all of it stands beside one group's name."""
    texts = []
    for i in range(800):
        if i % 4 == 0:
            texts.append((prose(rng, 15, ["muslims", "vile" if i % 8 else f"q{i}"]), 1))
        else:
            texts.append((prose(rng, 15, ["muslims"] if i % 40 == 1 else ["people"] if i % 3 else ()), 0))
    return texts


def test_swapped_names_change_no_score(spark, monkeypatch):
    rng = random.Random(3)
    docs, labels = corpus(spark, names_corpus(rng), "toxic")
    neutral = spark.createDataFrame([(1, "The muslims met here."), (2, "The people met here."), (3, "Vile people.")], "doc_id long, text string")
    fair = scores(spark, neutral, toxicity.fit(docs, labels), toxicity)
    monkeypatch.setattr(toxicity, "FAIRNESS", 0.0)
    plain = scores(spark, neutral, toxicity.fit(docs, labels), toxicity)
    assert plain[0] > 3 * plain[1]
    assert abs(fair[0] - fair[1]) < 0.05 < abs(plain[0] - plain[1])
    assert fair[0] < 0.5 <= fair[2]


def test_swaps():
    found = list(toxicity.swaps("Many women and women. Dogs, people and men!"))
    assert ({"many", "women", "and"}, {"many", "people", "and"}) in found
    assert ({"dogs", "people", "and", "men"}, {"dogs", "women", "and", "men"}) in found
    # the other name stands there already
    assert ({"dogs", "people", "and", "men"}, {"dogs", "people", "and"}) in found
    assert list(toxicity.swaps("")) == list(toxicity.swaps("no names here")) == []


def test_penalty_is_the_change_of_each_sentence():
    """Against sentences scored one by one, and its gradient against small steps."""
    rng = np.random.default_rng(1)
    words = ["vile", "people", "muslims", "women", "womanly", "peopled"]
    sentences = [" ".join(rng.choice(words, 3)) for _ in range(40)]
    known = sorted({f for w in {*words, *toxicity._NAMES} for f in toxicity.features_of(w)})
    number = {f: i for i, f in enumerate(known)}
    numbers = lambda words: [number[f] for f in {f for w in words for f in toxicity.features_of(w)}]
    changes = [(numbers(b), numbers(a), 1 + i % 3) for i, (b, a) in enumerate(x for t in sentences for x in toxicity.swaps(t))]
    assert len(changes) > 100
    weights, bias = rng.standard_normal(len(known)), -0.3
    swapped = toxicity.Swaps.of(changes, 50)

    def brute(weights, bias):
        p = lambda held: 1 / (1 + np.exp(-(sum(weights[i] for i in held) + bias)))
        return sum(c / 50 * (p(b) - p(a)) ** 2 for b, a, c in changes)

    value, by_weight, by_bias = swapped.penalty(weights, bias)
    assert value == pytest.approx(brute(weights, bias))
    for i in range(0, len(known), 7):
        step = np.zeros(len(known))
        step[i] = 1e-6
        assert by_weight[i] == pytest.approx((brute(weights + step, bias) - brute(weights - step, bias)) / 2e-6, abs=1e-6)
    assert by_bias == pytest.approx((brute(weights, bias + 1e-6) - brute(weights, bias - 1e-6)) / 2e-6, abs=1e-6)


def test_scores_of_given_swapped_sentences(spark, monkeypatch):
    """Of the sample's own sentences that name a group, rescored with names swapped, the mean
    squared change is far below what it is without the penalty."""
    rng = random.Random(3)
    texts = names_corpus(rng)
    docs, labels = corpus(spark, texts, "toxic")
    pairs = [(" ".join(sorted(b)), " ".join(sorted(a))) for t, _ in texts for b, a in toxicity.swaps(t)][::50]
    sides = [spark.createDataFrame([(i, p[k]) for i, p in enumerate(pairs)], "doc_id long, text string") for k in (0, 1)]

    def change(model):
        one, two = (scores(spark, side, model, toxicity) for side in sides)
        return sum((a - b) ** 2 for a, b in zip(one, two, strict=True)) / len(pairs)

    fair = change(toxicity.fit(docs, labels))
    monkeypatch.setattr(toxicity, "FAIRNESS", 0.0)
    assert fair < 0.1 * change(toxicity.fit(docs, labels))


def test_repeated_labelled_documents_and_ties(spark):
    """Repeated rows and labels change nothing; the order of rows does not either."""
    texts = names_corpus(random.Random(5))
    docs, labels = corpus(spark, texts, "toxic")
    expected = toxicity.fit(docs, labels)
    again = toxicity.fit(docs.unionByName(docs).repartition(5), labels.unionByName(labels).repartition(3))
    assert again.weights.keys() == expected.weights.keys()
    assert again.weights == pytest.approx(expected.weights, abs=1e-6) and again.bias == pytest.approx(expected.bias, abs=1e-6)


def junk(rng, kind, n):
    words = rng.choices(WORDS, k=n)
    if kind == 0:
        return " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in words)
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join(w for w in words[: n // 8 + 1] for _ in range(8))


def test_quality(spark):
    rng = random.Random(1)
    texts = [(junk(rng, i % 3, rng.randrange(10, 200)), 0) if i % 5 == 0 else (prose(rng, rng.randrange(3, 200)), 1) for i in range(500)]
    docs, labels = corpus(spark, texts, "quality")
    model = quality_knn.fit(docs, labels)
    found = scores(spark, docs, model, quality_knn)
    assert all(0 <= s <= 1 for s in found)
    assert sum((s >= 0.3) == bool(x) for s, (_, x) in zip(found, texts, strict=True)) >= 490
    more = spark.createDataFrame([(1, ""), (2, None), (3, prose(rng, 20_000)), (4, junk(rng, 0, 20_000)), (5, " ")], "doc_id long, text string")
    s = scores(spark, more, model, quality_knn)
    assert s[0] == s[1] == s[4] and s[2] >= 0.3 > s[3]


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_knn, "quality")])
def test_no_labels_and_no_documents(spark, module, label):
    docs, labels = corpus(spark, [("a text", None), (None, None)], label)
    labels = labels if labels.columns else spark.createDataFrame([], f"doc_id long, {label} int")
    model = module.fit(docs, labels)
    assert all(0 <= s <= 1 for s in scores(spark, docs, model, module))
    model = module.fit(docs.limit(0), labels)
    assert scores(spark, docs.limit(0), model, module) == []


def test_one_class_only(spark):
    docs, labels = corpus(spark, [("some text", 0)] * 20, "toxic")
    assert max(scores(spark, docs, toxicity.fit(docs, labels), toxicity)) < 0.5


def test_sample(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)] + [(7, "a"), (None, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(8, 1), (9, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 1000).collect()
    held = {r.doc_id for r in docs.where(held_out(F.col("doc_id"))).collect()}
    assert {r.key for r in rows} == set(range(100)) - held
    assert len(rows) == len({r.key for r in rows})
    assert labelled_sample(docs, labels, "toxic", 10).count() <= 10
    if 8 not in held:
        assert next(r.label for r in rows if r.key == 8) == 1


def test_held_out_is_the_checksum(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(r.id).encode()) % 5 == 0 for r in rows]


def test_votes_against_a_plain_scan():
    """All cosines, sorted; the nearest vote by their similarity."""
    rng = np.random.default_rng(2)
    terms, rank, labelled = quality_knn.TERMS, 12, 300
    axes = np.linalg.qr(rng.standard_normal((terms, rank)))[0]
    known = rng.random((labelled, terms))
    plain = quality_knn.Model(rng.random(terms), axes, np.zeros((0, rank)), (rng.random(labelled) < 0.3).astype(float), 0.5)
    model = quality_knn.Model(plain.weights, axes, plain.place(known), plain.labels, 0.5)
    asked = rng.random((40, terms))
    votes = model.vote(asked)
    for frequencies, vote in zip(asked, votes, strict=True):
        v = (frequencies * model.weights) @ axes
        similar = []
        for row, label in zip(known, model.labels, strict=True):
            w = (row * model.weights) @ axes
            similar.append((float(v @ w / np.sqrt((v @ v) * (w @ w))), label))
        nearest = sorted(similar, reverse=True)[: quality_knn.NEIGHBOURS]
        weights = [max(s, 0) ** 8 + 1e-9 for s, _ in nearest]
        assert vote == pytest.approx(sum(w * x for w, (_, x) in zip(weights, nearest, strict=True)) / sum(weights))


def test_scores_of_the_query_against_its_features(spark):
    """op10 on a whole table: each score from the features of the text, one by one."""
    from loanpanel.llm.queries import op10_toxicity

    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = op10_toxicity(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        z = model.bias + sum(model.weights.get(f, 0.0) for f in toxicity.features(texts[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        assert r.predicted == (r.score >= 0.5)


def area(rows):
    """The share of pairs of one row of each label in which the score tells them apart."""
    ones, zeros = ([s for s, x in rows if x == y] for y in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("name,label,least", [("op6_quality_knn", "quality", 0.95), ("op10_toxicity", "toxic", 0.9)])
def test_held_out_documents(spark, name, label, least):
    """Both classes are told, not the larger one alone: recall of each, and the area."""
    from loanpanel.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES[name](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    for x in (0, 1):
        own = [r.predicted == x for r in rows if r[label] == x]
        assert len(own) > 50 and sum(own) / len(own) >= 0.9
    assert area([(r.score, r[label]) for r in rows]) >= least
