import random
import re
import string

import duckdb
import pytest

from loanpanel.llm import queries, secret_scan
from loanpanel.llm.secret_scan import KINDS

SCHEMA = "doc_id long, text string, spans string, start string, kind string"
HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def brute_base(text):
    """The patterns as they are told, each over the whole text."""
    found = []
    for kind, (_, pattern, flags, least) in enumerate(secret_scan.PATTERNS):
        for m in re.finditer(pattern, text, flags):
            if len(m.group(2) if kind == 0 else m.group()) >= least:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def several_kinds(word):
    kinds = sum(any(c in k for c in word) for k in (string.digits, string.ascii_lowercase, string.ascii_uppercase))
    return len(word) >= secret_scan.CANDIDATE and kinds >= 2


def brute_spans(texts):
    """Base spans and scores counted step by step, of all texts together."""
    signs = re.escape(secret_scan.SIGNS)
    counts = ({}, {})
    free = []
    for text in texts:
        base = brute_base(text)
        for m in re.finditer(f"[{signs}]+", text):
            if len(m.group()) >= secret_scan.SAMPLE and all(m.end() <= s or e <= m.start() for s, _, e in base):
                free.append((text, m))
                if several_kinds(m.group()):
                    continue  # to be judged, not learned
                for pair in zip("\n" + m.group(), m.group() + "\n"):
                    counts[0][pair] = counts[0].get(pair, 0) + 1
        for s, kind, e in base:
            value = re.match(secret_scan.PATTERNS[0][1], text[s:e], re.A | re.I).group(2) if kind == 0 else text[s:e]
            for word in re.findall(f"[{signs}]+", value):
                if len(word) >= secret_scan.SAMPLE:
                    for pair in zip("\n" + word, word + "\n"):
                        counts[1][pair] = counts[1].get(pair, 0) + 1
    import math

    def ratio(pair):
        p = [
            (c.get(pair, 0) + 1) / (sum(n for q, n in c.items() if q[0] == pair[0]) + secret_scan.STATES) for c in counts
        ]
        return round(1000 * (math.log(p[1]) - math.log(p[0])))

    found = {id(t): brute_base(t) for t in texts}
    for text, m in free:
        word = m.group()
        if several_kinds(word):
            score = sum(map(ratio, zip("\n" + word, word + "\n")))
            if score >= 1000 * max(secret_scan.NATS, secret_scan.NATS_EACH * len(word)):
                found[id(text)].append((m.start(), 3, m.end()))
    return [sorted(found[id(t)]) for t in texts]


def sample_texts():
    rng = random.Random(3)
    syllables = ["an", "the", "ing", "tion", "er", "ou", "re"]

    def word():
        made = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 6)))
        return rng.choice([made, made, made.title(), made.upper(), f"{made}{rng.randint(1, 99)}"])

    secret = lambda signs, n: "".join(rng.choice(signs) for _ in range(n))
    kinds = [
        lambda: "password=" + secret("0123456789abcdef", 18),
        lambda: 'Token = "' + secret("0123456789abcdef", 40) + '"',
        lambda: "AKIA" + secret(string.ascii_uppercase + string.digits, 16),
        lambda: "api_key: short",
        lambda: secret(string.ascii_letters + string.digits, 32),
        lambda: "get" + word().title() + word().title(),
        lambda: "4785380592391139",
    ]
    for _ in range(120):
        yield " ".join(rng.choice(kinds)() if rng.random() < 0.03 else word() for _ in range(rng.randint(0, 150)))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("", []),
        ("token = token = abcdefgh12", []),  # the failing match takes the second word with it
        ("TOKEN=abcdefgh", [(0, 0, 14)]),
        ("paſſword=abcdefgh", []),
        ("apikey: 'abcd.efgh' api_key=\"abcdefg", [(0, 0, 18)]),
        ("xAKIAABCDEFGHIJKL AKIAABCDEFGHIJK", [(1, 1, 17)]),
        (f"é {HEX} {HEX[:31]}", [(2, 2, 42)]),
        (f"token={HEX}", [(0, 0, 46), (6, 2, 46)]),
        ("g" + HEX[:32] + "A", [(1, 2, 33)]),
    ],
)
def test_base(text, expected):
    assert secret_scan.base_spans(text) == expected == brute_base(text)


def test_against_brute_force(spark):
    texts = list(sample_texts())
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    rows = secret_scan.scan(docs, secret_scan.fit(docs)).collect()
    found = {r.doc_id: [(s.start, KINDS.index(s.kind), s.end) for s in r.spans] for r in rows}
    expected = brute_spans(texts)
    assert [found[i] for i in range(len(texts))] == expected
    assert sum(k == 3 for spans in expected for _, k, _ in spans) > 20


def test_what_is_added(spark):
    """Held-out strings: random ones of several alphabets are found, identifiers are not."""
    texts = list(sample_texts())
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], SCHEMA)
    names = ["loan_sequence_number", "monthlyReportingPeriod", "current-interest-rate", "ClassifierOfDocuments2"]
    given = spark.createDataFrame([(n, False) for n in names * 50] + [(None, True), ("x" * 20, None)], "value string, is_random boolean")
    model = secret_scan.fit(docs, samples=given)
    rng = random.Random(8)
    for signs in (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits):
        secrets = ["".join(rng.choice(signs) for _ in range(32)) for _ in range(200)]
        assert sum(map(model.is_secret, secrets)) >= 190
    rest = ["loan_sequence_rate", "monthlyInterestNumber", "ReportingOfDocuments", "theingerantion", "4785380592391139"]
    assert not any(map(model.is_secret, rest))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, f"token={HEX}"), (3, f"token={HEX}"), (3, f"token={HEX}"), (4, "x" * 200_000 + " " + HEX)]
    docs = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], SCHEMA)
    found = secret_scan.scan(docs, secret_scan.fit(docs)).collect()
    assert [(r.doc_id, [s.kind for s in r.spans]) for r in found] == [
        (1, []), (2, []), (None, ["assign", "hex"]), (3, ["assign", "hex"]), (3, ["assign", "hex"]), (4, ["hex"]),
    ]
    none = spark.createDataFrame([], SCHEMA)
    assert secret_scan.scan(none, secret_scan.fit(none)).count() == 0


def test_statement_agrees_on_many_secrets(spark, tmp_path):
    """The SQL on texts that hold more of every kind than the given tables do."""
    texts = [*sample_texts(), None, "", "token = token = abcdefgh12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = connection.execute(queries.ORACLES["op13_secret_scan"])
    names = [c[0] for c in result.description]
    found = queries.op13_secret_scan(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, found)) == sorted(result.fetchall())
    assert any("random" in r.spans for r in found)
