"""The corpus pipeline: documents in, token ids out, one operator a stage.

Each stage reads what the stage before it wrote, and the classifiers learn from the
labelled documents of their own input. All stages but the last return the columns of
documents; a filtering stage drops rows and changes nothing else, and the mix drops rows or
repeats them.
"""

from __future__ import annotations

import tempfile

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanpanel.llm import bpe, mixing, neardup, quality_knn, toxicity
from loanpanel.llm.common import free_name, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: A document is dropped at this toxicity, or below this quality.
TOXIC, POOR = 0.5, 0.3
#: Words in a shingle, and the similarity in percent that makes a near-duplicate.
SHINGLE, SIMILAR = 5, 80
#: As many tokens as there are, by the weights of the mix; a document is used up to four times.
MIX = mixing.Mix()


def _where(docs: DataFrame, score: Column, good) -> DataFrame:
    name = free_name(docs, "score")
    return docs.withColumn(name, score).where(good(F.col(name))).drop(name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _where(docs, toxicity.score(F.col("text"), model, spark), lambda s: s < TOXIC)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_knn.fit(docs, table(spark, sf_dir, "labels"))
    return _where(docs, quality_knn.score(F.col("text"), model, spark), lambda s: s >= POOR)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group. A row goes by its id and its
    text: another text under the same id stays if its own group has no smaller id. Rows that
    repeat the kept one are all kept, and rows without an id."""
    mark = free_name(docs, "mark")
    classes = neardup.near_duplicates(docs, SHINGLE, SIMILAR, mark=mark)
    gone = classes.where("NOT kept AND doc_id IS NOT NULL").select("doc_id", mark).distinct()
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce("text", F.lit(""))))
    return marked.join(gone, ["doc_id", mark], "left_anti").select(*docs.columns)


def mix_sources(
    spark: SparkSession, docs: DataFrame, sf_dir: str, ends: DataFrame | None = None
) -> DataFrame:
    """The documents that the mix uses, each in as many rows as it uses it. Who gives the cuts
    (`ends`) gets each once: the cuts tell how often, see `uses` and `tokenize`."""
    taken = mixing.mixed(docs, mixing.cuts(docs, MIX) if ends is None else ends, MIX)
    if ends is None:
        copies = F.col(taken.columns[-1])
        taken = taken.withColumn(free_name(taken, "use"), F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return taken.select(*docs.columns)


def uses(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """doc_id and copies: how often the mix uses each document that `mix_sources` gave for
    these cuts. `run` leaves both tables, `mixing` and `mixing_cuts`."""
    return mixing.mixed(docs.select("doc_id", "lang", "source"), ends, MIX).select("doc_id", "copies")


def tokenize(
    spark: SparkSession, docs: DataFrame, sf_dir: str, ends: DataFrame | None = None
) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, and decoded_sha256 of the decoded ids, a row for each
    row. With the cuts that `mix_sources` got (`ends`), a row's ids are those of all uses of its
    document, one use after the other, and n_tokens and the digests are of all of them."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    copies = None
    if ends is not None:
        docs = mixing.mixed(docs, ends, MIX)
        copies = docs.columns[-1]
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, digests=True, copies=copies)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: The classifiers cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet to the shared folder that
    spark.checkpoint.dir names and read again; the cuts of the mix, one row per leaf, lie
    beside. A document is one row, merged into tokens once; its ids are there once for each use
    that the mix makes of it. Only a local session without that setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pipeline-")
    run_id = spark.range(1).select(F.expr("uuid()")).first()[0]
    docs = table(spark, sf_dir, "documents")
    ends = None
    for name, stage in STAGES:
        path = f"{folder}/pipeline-{run_id}/{name}"
        if stage is mix_sources:
            mixing.cuts(docs, MIX).write.parquet(f"{path}_cuts")
            ends = spark.read.parquet(f"{path}_cuts")
        more = {"ends": ends} if stage in (mix_sources, tokenize) else {}
        stage(spark, docs, sf_dir, **more).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
