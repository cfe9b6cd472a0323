"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


#: Rows and bytes that go to a Python worker at a time.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lets tasks send whole texts to Python a few MB at a time.

    Spark's own bounds (10,000 rows, 64 MB) hold for the rows' Arrow form, of which the
    JVM and the worker have copies outside the heap at once, in every running task.

    Sets the two Arrow settings of the session, and leaves them set: they are read when a
    query runs, and frames are lazy. Results never depend on them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def settled(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder and read from there.

    Cuts the lineage in a way that survives lost executors. The folder is the one
    that spark.checkpoint.dir names; only a local session without that setting gets
    a folder of its own.

    Shuffles that only frames settled before have used are not needed any more. Spark
    removes their files when the driver's garbage is collected, which a driver with little
    to do puts off for long, so it is asked to do that first.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    context._jvm.java.lang.System.gc()
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows that no classifier may learn from: the checksum of the key as text is
    divisible by `folds`. A null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, bound: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, text, label of at most `bound` labelled documents outside the held-out fold.

    The documents are the first by a hash of their key, so each size of corpus gets a
    random sample and a repeated run the same one. Several labels of a document count as
    the largest, several texts as the smallest; null labels and keys are left out. The
    sample's keys (at most `bound` numbers) are broadcast, so only its texts move.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("key"))
        .agg((F.max(label) > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(bound)
    )
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
