"""The registered queries: against DuckDB where SQL can say it, and the pipeline."""

import hashlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from checks.compare import canonical, duckdb_pandas, spark_pandas
from loanpanel.llm import mixing, neardup
from loanpanel.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_agrees_with_duckdb(spark, connection, name):
    actual = spark_pandas(QUERIES[name](spark, SF_DIR))
    expected = duckdb_pandas(connection, ORACLES[name])
    assert actual.shape == expected.shape
    actual, expected = canonical(actual), canonical(expected)
    for column in actual.columns:
        assert actual[column].equals(expected[column]), column


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = corpus_pipeline.run(spark, SF_DIR)
    rows = found.collect()
    assert found.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids))
    assert 0.5 * docs.count() < len(ids) < docs.count()
    # what is left has no near-duplicates
    left = docs.where(docs.doc_id.isin(ids))
    assert neardup.near_duplicates(left, 5, 80).where("NOT kept").count() == 0


def test_near_dedup_loses_no_text(spark):
    """Of (7, A) (7, B) (3, A and a word), B has no near copy and stays."""
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(7, a), (7, b), (3, a + " x"), (7, b), (5, "c" * 300_000 + " d e f g"), (6, "c" * 300_000 + " d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id, r.text[:2]) for r in kept) == [(3, "a0"), (5, "cc"), (7, "b0"), (7, "b0")]


def test_pipeline_mixes_by_weight(spark, tmp_path):
    """Half of the tokens are crawled; of the mix, 35 in 100 are, as its weights say."""
    schema = "doc_id long, text string, lang string, source string"
    rows = [(i, "w " * 10, "en", f"src{i % 2}") for i in range(400)]
    docs = spark.createDataFrame(rows, schema)
    ends = mixing.cuts(docs, corpus_pipeline.MIX)
    kept = corpus_pipeline.mix_sources(spark, docs, SF_DIR, ends)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and sum(i % 2 for i in ids) == 200
    copies = dict(map(tuple, corpus_pipeline.uses(kept, ends).collect()))
    assert copies.keys() == set(ids)
    assert sum(n for i, n in copies.items() if i % 2 == 0) == 140
    assert sum(n for i, n in copies.items() if i % 2) == 260


def mix_rows():
    """Half of the words are crawled; documents have different words, so that their tokens tell
    them apart. Nulls, an empty text and a repeated row beside."""
    rows = [(i, f"w{i} " * 10, "en", f"src{i % 2}") for i in range(400)]
    return [*rows, rows[1], (None, "of no key", "de", "src1"), (900, None, None, None), (901, "", "en", "src1")]


def test_pipeline_gives_a_row_for_each_use(spark):
    """Of a document that the mix uses three times there are three rows and their tokens."""
    docs = spark.createDataFrame(mix_rows(), "doc_id long, text string, lang string, source string")
    ends = mixing.cuts(docs, corpus_pipeline.MIX)
    kept = corpus_pipeline.mix_sources(spark, docs, SF_DIR, ends)
    copies = Counter()
    for r in mixing.mixed(kept, ends, corpus_pipeline.MIX).collect():
        copies[r[:4]] += r.copies
    given = corpus_pipeline.mix_sources(spark, docs, SF_DIR)
    assert given.columns == docs.columns
    assert Counter(map(tuple, given.collect())) == copies and max(copies.values()) > 1
    # by words, 35 in 100 are crawled: of 4013 words, 1404
    words = Counter()
    for (_, text, _, source), n in copies.items():
        words[source == "src0"] += n * len((text or "").split())
    assert 1390 <= words[True] <= 1404 and 2590 <= words[False] <= 2609
    # as rows, or in one row: the same tokens
    rows = corpus_pipeline.tokenize(spark, given, SF_DIR).collect()
    once = corpus_pipeline.tokenize(spark, kept, SF_DIR, ends).collect()
    assert len(rows) == sum(copies.values()) and len(once) == kept.count()
    of_rows, of_once = Counter(), Counter()
    for found, total in ((rows, of_rows), (once, of_once)):
        for r in found:
            assert len(r.ids) == 4 * r.n_tokens and hashlib.sha256(r.ids).hexdigest() == r.ids_sha256
            total[r.doc_id] += r.n_tokens
    assert of_rows == of_once
    use = {r.doc_id: bytes(r.ids) for r in rows}
    text = {r[0]: r[1] or "" for r in mix_rows()}
    for r in once:
        n = copies[next(d for d in copies if d[0] == r.doc_id)] // (2 if r.doc_id == 1 else 1)
        assert bytes(r.ids) == use[r.doc_id] * n
        assert r.decoded_sha256 == hashlib.sha256((text[r.doc_id] * n).encode()).hexdigest()


def test_pipeline_run_gives_the_tokens_of_each_use(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame(mix_rows(), "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    n_tokens = {r.doc_id: r.n_tokens for r in corpus_pipeline.tokenize(spark, docs, SF_DIR).collect()}
    expected = Counter()
    for r in mixing.mixed(docs, mixing.cuts(docs, corpus_pipeline.MIX), corpus_pipeline.MIX).collect():
        expected[r.doc_id] += r.copies * n_tokens[r.doc_id]
    found = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found[r.doc_id] += r.n_tokens
    assert found == expected


def test_pipeline_leaves_the_cuts(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.glob("pipeline-*"))
    ids = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    [run] = set(folder.glob("pipeline-*")) - before
    kept, ends = (spark.read.parquet(f"{run}/{name}") for name in ("mixing", "mixing_cuts"))
    copies = dict(map(tuple, corpus_pipeline.uses(kept, ends).collect()))
    assert copies.keys() == ids and max(copies.values()) > 1


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and columns with the operators' own names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, copies int, ids string"
    rows = [
        (1, "some words of a text", "en", "src0", 1, "x", 1, "y"), (1, "some words of a text", "en", "src0", 1, "x", 1, "y"),
        (2, None, None, None, None, None, None, None), (None, "x", "de", "src1", 2, None, 2, None), (3, "", "en", "src0", 0, "", 0, ""),
    ]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.tokenize(spark, docs, SF_DIR).count() == len(table)
