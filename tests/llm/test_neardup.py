import random

import pytest

from loanpanel.llm import neardup
from loanpanel.llm.components import components


def classes(links, nodes):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in nodes}


def brute(docs, size, percent):
    sets = [(i, neardup.shingles(t, size)) for i, t in docs]
    links = [
        (a, b)
        for n, (a, x) in enumerate(sets)
        for b, y in sets[:n]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    return classes(links, [i for i, _ in docs])


def found(spark, docs, size=2, percent=80):
    frame = spark.createDataFrame([(i, t, "clash", 0) for i, t in docs], "doc_id long, text string, component_id string, n long")
    return neardup.near_duplicates(frame, size, percent).collect()


def edited(words, rng, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(spark, size):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randrange(3, 200))
        for _ in range(rng.randrange(1, 9)):
            docs.append(" ".join(edited(base, rng, rng.randrange(0, 1 + len(base) // 8), vocabulary)))
    passage = rng.choices(vocabulary, k=60)
    docs += [" ".join([*rng.choices(vocabulary, k=rng.randrange(5, 60)), *passage]) for _ in range(60)]
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    expected = brute(docs, size, 80)
    assert {r.doc_id: r.component_id for r in found(spark, docs, size)} == expected
    assert len(set(expected.values())) < len(docs)


def test_a_chain_that_no_star_covers(spark):
    """Each text is linked with the next only; ends are far apart."""
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[i * 4 : i * 4 + 40])) for i in range(6)]
    assert {r.doc_id: r.component_id for r in found(spark, docs, 2)} == brute(docs, 2, 80)
    near = [(i, " ".join(words[i * 2 : i * 2 + 40])) for i in range(8)]
    assert {r.component_id for r in found(spark, near, 2)} == {0}


def test_copies_around_a_base(spark):
    """Copies are near the base but not near each other."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = rng.choices(vocabulary, k=150)
    docs = [(50, " ".join(base))] + [(i, " ".join(edited(base, rng, 9, vocabulary))) for i in range(1, 41)]
    assert {r.doc_id: r.component_id for r in found(spark, docs)} == brute(docs, 2, 80)


def test_edges(spark):
    docs = [
        (9, "Same Words here"), (4, "same  words\nHERE"), (5, "one"), (6, "ONE"), (7, "É"), (8, "é"),
        (1, ""), (2, None), (3, "  "), (9, "Same Words here"), (None, "one"), (None, None),
    ]
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found(spark, docs)), key=str)
    assert rows == sorted(
        [
            (9, 2, 4, False), (4, 2, 4, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 7, True), (8, 1, 8, True),
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (9, 2, 4, False), (None, 1, None, False), (None, 0, None, False),
        ],
        key=str,
    )


def unrelated(n, k):
    """Texts without a word in common."""
    return [" ".join(f"{chr(97 + i)}{j}" for j in range(k)) for i in range(n)]


def test_different_texts_under_one_key(spark):
    """They are linked with what each is near to, not with each other."""
    a, b = unrelated(2, 60)
    docs = [(7, a), (7, b), (3, a + " x"), (4, b + " y"), (9, b + " z")]
    rows = sorted((r.doc_id, r.component_id, r.kept) for r in found(spark, docs))
    assert rows == [(3, 3, True), (4, 4, True), (7, 3, False), (7, 4, False), (9, 4, False)]
    # the smallest key of a class may itself stand for two texts
    rows = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found(spark, [(7, a), (7, "u v"), (8, a + " x")]))
    assert rows == [(7, 1, 7, True), (7, 59, 7, True), (8, 60, 7, False)]


def test_texts_are_told_apart_by_the_mark(spark):
    a, b = unrelated(2, 60)
    frame = spark.createDataFrame([(7, a), (7, b), (3, a), (1, None)], "doc_id long, text string")
    marked = neardup.near_duplicates(frame, mark="mark").join(
        frame.selectExpr("text", "xxhash64(coalesce(text, '')) AS mark").distinct(), "mark"
    )
    assert sorted((r.doc_id, r.text or "", r.kept) for r in marked.collect()) == [
        (1, "", True), (3, a, True), (7, a, False), (7, b, True),
    ]


def test_texts_are_found_by_a_shuffle_as_by_a_broadcast(spark, monkeypatch):
    docs = [(i, f"{t} {i}") for i, t in enumerate(unrelated(4, 50) * 4)]
    expected = sorted(found(spark, docs))
    monkeypatch.setattr(neardup, "BROADCAST_KEYS", 0)
    assert sorted(found(spark, docs)) == expected
    assert len({r.component_id for r in expected}) == 4


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = {r.doc_id: r for r in found(spark, [(1, long), (2, long + " x")])}
    assert rows[2].component_id == 1 and rows[1].n_shingles == 59_999
    assert found(spark, []) == []


def test_threshold_is_exact(spark):
    """4 of 5 shingles is 80 percent, 7 of 9 is not."""
    a = "a b c d e f"  # 5 shingles
    assert {r.component_id for r in found(spark, [(1, a), (2, "a b c d e")])} == {1}
    nine = "a b c d e f g h i"
    assert {r.component_id for r in found(spark, [(1, nine), (2, "a b c d e f g")])} == {1, 2}


def test_components(spark):
    rng = random.Random(4)
    for n, m in ((40, 25), (60, 80), (30, 0)):
        links = [tuple(rng.sample(range(n), 2)) for _ in range(m)] + [(i, i + 1) for i in range(100, 130)] * (m > 30)
        frame = spark.createDataFrame(links, "a long, b long")
        nodes = {x for link in links for x in link}
        assert {r.node: r.component for r in components(frame).collect()} == classes(links, nodes)


def test_borrowed_bins_agree_for_equal_parts():
    """Densified signatures of similar small sets share bands about as often as expected."""
    rng = random.Random(1)
    sketcher = neardup.Sketcher(1)
    shared = []
    for _ in range(200):
        words = [f"w{rng.random()}" for _ in range(10)]
        one, two = sketcher(" ".join(words[:9])), sketcher(" ".join(words))  # similarity 0.9
        shared.append((one[2] == two[2]).mean())
    assert abs(sum(shared) / len(shared) - 0.9**neardup.ROWS) < 0.05
