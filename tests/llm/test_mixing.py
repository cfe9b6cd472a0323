import hashlib

from pyspark.sql import functions as F

from loanpanel.llm import mixing
from loanpanel.llm.mixing import Mix

SCHEMA = "doc_id long, text string, lang string, source string, copies string, budget string"


def corpus(spark, leaves, per_doc=10):
    """{(lang, source): documents} with `per_doc` words each."""
    rows = []
    for (lang, source), n in leaves.items():
        rows += [(len(rows) + i, "w " * per_doc, lang, source, "clash", "clash") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def budgets(spark, leaves, mix):
    """{(domain, lang, source): (tokens, budget)}"""
    rows = [(*path, tokens) for path, tokens in leaves.items()]
    frame = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    return {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(frame, mix).collect()}


def poured(offers, weights, budget):
    """By hand: fill by weight; whoever is full leaves the rest to the others."""
    given, left, still = {}, budget, set(offers)
    while still:
        total = sum(weights[x] for x in still)
        full = {x for x in still if offers[x] * total <= left * weights[x]}
        if not full:
            return given | {x: left * weights[x] // total for x in still}
        x = min(full, key=lambda x: (offers[x] / weights[x], x))
        given[x] = offers[x]
        left -= offers[x]
        still.remove(x)
    return given


WEIGHTS = {"domain": {"a": 1, "b": 3}, "lang": {"en": 2, "de": 1}, "source": {"s1": 1, "s2": 2, "s3": 5}}


def test_budgets_by_hand(spark):
    mix = Mix(weights=WEIGHTS, percent=150, max_epochs=3)
    leaves = {("a", "en", "s1"): 1000, ("a", "en", "s2"): 50, ("a", "de", "s1"): 400, ("b", "en", "s3"): 10, ("b", "de", "s2"): 700, ("b", "de", "s3"): 5}
    cap = {p: 3 * n for p, n in leaves.items()}
    found = budgets(spark, leaves, mix)
    total = min(sum(leaves.values()) * 150 // 100, sum(cap.values()))
    of = lambda prefix: sum(n for p, n in cap.items() if p[: len(prefix)] == prefix)
    domains = poured({d: of((d,)) for d in "ab"}, WEIGHTS["domain"], total)
    for d in "ab":
        langs = poured({x: of((d, x)) for x in {p[1] for p in leaves if p[0] == d}}, WEIGHTS["lang"], domains[d])
        for x, budget in langs.items():
            sources = poured({p[2]: cap[p] for p in leaves if p[:2] == (d, x)}, WEIGHTS["source"], budget)
            assert {s: found[d, x, s] for s in sources} == sources


def test_siblings_before_ancestors(spark):
    """b/en/s1 is short: b/en/s2 takes all of it, and no other family notices."""
    mix = Mix(weights={"domain": {}, "lang": {}, "source": {}}, percent=50, max_epochs=1)
    even = {("a", "en", "s1"): 1000, ("a", "en", "s2"): 1000, ("b", "en", "s1"): 1000, ("b", "en", "s2"): 1000}
    assert set(budgets(spark, even, mix).values()) == {500}
    short = {**even, ("b", "en", "s1"): 100, ("b", "en", "s2"): 1900}
    assert budgets(spark, short, mix) == {("a", "en", "s1"): 500, ("a", "en", "s2"): 500, ("b", "en", "s1"): 100, ("b", "en", "s2"): 900}


def test_budgets_of_zero(spark):
    mix = Mix(weights={"domain": {"a": 0}, "lang": {}, "source": {}}, percent=100, max_epochs=1)
    assert budgets(spark, {("a", "en", "s"): 100, ("b", "en", "s"): 100}, mix) == {("a", "en", "s"): 0, ("b", "en", "s"): 100}
    assert budgets(spark, {("a", "en", "s"): 0, ("b", "en", "s"): 0}, mix) == {("a", "en", "s"): 0, ("b", "en", "s"): 0}


def test_epochs_and_prefix(spark):
    docs = corpus(spark, {("en", "big"): 300, ("en", "small"): 30})
    mix = Mix(weights={"domain": {}, "lang": {}, "source": {}}, percent=100, max_epochs=4, seed=5)
    ends = {r.source: r for r in mixing.cuts(docs, mix).collect()}
    # 3300 tokens; small offers 4 * 300, big takes what is left
    assert (ends["small"].budget, ends["small"].epochs, ends["small"].cut) == (1200, 4, None)
    assert (ends["big"].budget, ends["big"].epochs) == (2100, 0)
    taken = mixing.mixed(docs, mixing.cuts(docs, mix), mix)
    assert taken.columns == [*docs.columns, "copies_"]
    rows = taken.collect()
    assert {r.copies_ for r in rows if r.source == "small"} == {4}
    ids = [r.doc_id for r in docs.where("source = 'big'").collect()]
    order = sorted(ids, key=lambda i: hashlib.md5(f"5:0:{i}".encode()).hexdigest())
    assert {r.doc_id for r in rows if r.source == "big"} == set(order[:210])


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, None, None), (1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, "", "en", "s"), (3, "x " * 100_000, "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mix = Mix(percent=100, max_epochs=1)
    taken = mixing.mixed(docs, mixing.cuts(docs, mix), mix).collect()
    assert len(taken) == 5
    empty = docs.limit(0)
    assert mixing.mixed(empty, mixing.cuts(empty, mix), mix).count() == 0


def test_no_python_in_the_plan(spark):
    docs = corpus(spark, {("en", "s"): 5})
    mix = Mix()
    for frame in (mixing.cuts(docs, mix), mixing.mixed(docs, mixing.cuts(docs, mix), mix)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert F.col is not None


def test_cuts_joined_as_broadcast(spark, monkeypatch):
    """Many leaves are joined by leaf; the documents taken are the same."""
    docs = corpus(spark, {("en", "src0"): 30, ("en", "src5"): 20, ("de", "src1"): 7, (None, None): 5})
    mix = Mix(percent=60)
    taken = lambda: sorted(map(tuple, mixing.mixed(docs, mixing.cuts(docs, mix), mix).collect()), key=str)
    expected = taken()
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 0)
    assert taken() == expected and expected
