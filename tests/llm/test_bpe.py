import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanpanel.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
VOCABULARY = bpe.Vocabulary(RANKS)
ENCODER = bpe.Encoder(VOCABULARY, public_tokenizers.PATTERN)


def ids_of(text):
    (ids,) = ENCODER([text])
    return list(memoryview(ids).cast("I"))


def test_ranks_are_the_file():
    with open(PATH, "rb") as lines:
        first = next(lines).split()
    assert RANKS[base64.b64decode(first[0])] == int(first[1])


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_agrees_with_the_library(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "\x1c \x85 x", "it's <|endoftext|>", "aaaa" * 3000, "ab" * 5001, "é" * 4000, "!" * 9999, "\n" * 700 + "x", "𝒳😀" * 50, "don't   stop"],
)
def test_special_and_long_texts(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_every_code_point_splits_as_in_the_library():
    for start in range(0, 0x30000, 997):
        text = "".join(f"a{chr(c)} {chr(c)}1" for c in range(start, min(start + 997, 0x30000)) if not 0xD800 <= c < 0xE000)
        assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_merges_without_a_whole_match():
    """The leftmost of equal ranks goes first, and a merge changes its neighbours' pairs."""
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aab": 4}
    assert bpe.merge(b"aaa", ranks) == [2, 0]
    assert bpe.merge(b"aaab", ranks) == [2, 3]
    assert bpe.merge(b"aabaa", ranks) == [4, 2]


def random_ranks(rng, signs):
    """All bytes and some longer tokens, whose halves need not be tokens."""
    tokens = [bytes([b]) for b in range(256)]
    longer = {bytes(rng.choice(signs) for _ in range(rng.randint(2, 6))) for _ in range(60)}
    longer = sorted(longer, key=lambda t: rng.random())
    return {token: rank for rank, token in enumerate(tokens + longer)}


def test_lockstep_merges_as_one_by_one():
    rng = random.Random(2)
    for _ in range(40):
        ranks = random_ranks(rng, b"abc")
        vocabulary = bpe.Vocabulary(ranks)
        pieces = [bytes(rng.choice(b"abc\0\xff") for _ in range(rng.randint(2, 64))) for _ in range(100)]
        pieces = [p for p in pieces if p not in ranks]
        assert bpe.merge_in_lockstep(pieces, vocabulary) == [bpe.packed(bpe.merge(p, ranks)) for p in pieces]


@pytest.mark.parametrize("bounds", [{"REMEMBERED": 3}, {"HELD": 2}, {"LONG_TEXT": 5, "HELD": 3}, {"LOCKSTEP_ROWS": 2}, {"LOCKSTEP_BYTES": 1}])
def test_bounds_change_nothing(bounds, monkeypatch):
    for name, value in bounds.items():
        monkeypatch.setattr(bpe, name, value)
    rng = random.Random(4)
    texts = [None, ""] + ["".join(rng.choice("abé 1!\n") for _ in range(rng.randint(0, 60))) for _ in range(80)] * 2
    encoder = bpe.Encoder(VOCABULARY, public_tokenizers.PATTERN)
    assert [list(memoryview(x).cast("I")) for x in encoder(texts)] == [LIBRARY.encode_ordinary(t or "") for t in texts]


def test_a_table_without_all_bytes():
    """Texts of its bytes are encoded; another byte is an error, not a wrong id."""
    encoder = bpe.Encoder(bpe.Vocabulary({b"a": 0, b"b": 1, b"ab": 2}), r"\w+")
    assert [list(memoryview(x).cast("I")) for x in encoder(["abab ba"])] == [[2, 2, 1, 0]]
    with pytest.raises(KeyError):
        list(encoder(["abc"]))


def test_frames(spark):
    rows = [(1, "Hello world", "x"), (2, None, "x"), (3, "", "y"), (1, "Hello world", "x"), (None, "é" * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("n_tokens", F.lit("clash"))
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    found = encoded.withColumn("decoded", bpe.decode(F.col("ids"), RANKS, spark)).collect()
    assert len(found) == 5
    by_text = {bytes(r.decoded).decode(): r for r in found}
    for _, text, _ in rows:
        row = by_text[text or ""]
        assert list(memoryview(bytes(row.ids)).cast("I")) == LIBRARY.encode_ordinary(text or "")
        assert row.n_tokens == len(row.ids) // 4
    empty = bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN)
    assert empty.columns == ["doc_id", "n_tokens", "ids"]
    assert empty.count() == 0


def test_query_against_the_library(spark):
    from loanpanel.llm.queries import op1_byte_bpe

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in op1_byte_bpe(spark, sf_dir).collect():
        ids = LIBRARY.encode_ordinary(texts[row.doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts.pop(row.doc_id).encode()).hexdigest()
    assert not texts
