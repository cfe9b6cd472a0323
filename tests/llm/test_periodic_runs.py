import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanpanel.llm import periodic_runs, queries

SCHEMA = "doc_id long, text string, row string, runs string, start string"


def brute_runs(words):
    """(start, period, length) by comparing all words at all distances."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, p, n) for (s, n), p in found.items())


def brute_row(text):
    words = (text or "").encode().split()
    runs = brute_runs(words)
    dropped = {i for s, p, n in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        len(runs),
        *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
        sha("".join(f"{s},{n},{p}\n" for s, p, n in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def tiled_runs(ids):
    """The library's fragments, stitched here."""
    by_period = {}
    for p, low, high in sorted(periodic_runs.Tiles(ids, periodic_runs.Powers()).fragments()):
        parts = by_period.setdefault(p, [])
        if parts and low <= parts[-1][1]:
            parts[-1][1] = max(parts[-1][1], high)
        else:
            parts.append([low, high])
    found = {}
    for p in sorted(by_period):
        for low, high in by_period[p]:
            if high - low >= periodic_runs.least_places(p):
                found.setdefault((low, high - low + p), p)
    return sorted((s, p, n) for (s, n), p in found.items())


@pytest.mark.parametrize("tile", [8, 32, 4096])
@settings(max_examples=300, deadline=None)
@given(data=st.data())
def test_tiles_find_every_run(tile, data):
    n = data.draw(st.integers(0, 150))
    few = data.draw(st.integers(1, 4))
    ids = data.draw(st.lists(st.integers(0, few), min_size=n, max_size=n))
    if n and data.draw(st.booleans()):
        a, p = data.draw(st.integers(0, n - 1)), data.draw(st.integers(1, max(1, n // 3)))
        for i in range(a + p, data.draw(st.integers(a, n))):
            ids[i] = ids[i - p]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(periodic_runs, "TILE", tile)
        assert tiled_runs(ids) == brute_runs(ids)


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randint(0, 2) for _ in range(rng.randint(0, 30))]
        z = periodic_runs.z_function(s)
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k


def texts():
    rng = random.Random(7)
    words = ["a", "bb", "ccc", "ä", " ", "d" * 50]
    yield from (None, "", " \n\t", "one", "x x x x x", "x x x x x x", "x\ty\nx y x y x y", "a b a b a b a")
    for _ in range(60):
        n = rng.randint(1, 200)
        w = [rng.choice(words) for _ in range(n)]
        a, p = rng.randrange(n), rng.randint(1, 30)
        for i in range(a + p, n - rng.randint(0, 5)):
            w[i] = w[i - p]
        yield " ".join(w)


def test_rows_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TILE", 16)
    rows = [(i, t, "clash", "clash", "clash") for i, t in enumerate(texts())]
    rows += [rows[-1], rows[-1], (None, "y y y y y y y", "", "", ""), (None, None, "", "", ""), (3, "other text of one id", "", "", "")]
    found = periodic_runs.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=order) == sorted(((r[0], *brute_row(r[1])) for r in rows), key=order)


def test_fragments_of_many_tiles_are_stitched(spark):
    """A long text of one word, and one whose run crosses every tile's border."""
    n = 5 * periodic_runs.TILE + 3
    long = {1: "w " * n, 2: " ".join(str(i % 1500) for i in range(n)), 3: " ".join(map(str, range(n)))}
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in long.items()], SCHEMA)
    found = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in periodic_runs.periodic_runs(docs).collect()}
    assert found == {1: (1, 0, n, 1), 2: (1, 0, n, 1500), 3: (0, None, None, None)}


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_planted_runs(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(300)] + [(None, "a b c"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = []
    for i, text in rows:
        words, h = (text or "").split(), zlib.crc32(b"" if i is None else str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[a + (j - a) % p] if j >= a else words[j] for j in range(n))
        expected.append((i, text))
    assert [tuple(r) for r in queries.with_planted_runs(docs).collect()] == expected
