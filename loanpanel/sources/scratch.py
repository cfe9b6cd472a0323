"""Where intermediate files may go, and who removes them."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own;
    on a cluster a machine-local folder would not be seen by other executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="loanpanel-")


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write the frame as a table to ``path``, which is the caller's, and read it back.

    Runs a job. What follows no longer depends on how the frame was computed,
    so a lost executor costs a read, not the whole history.
    """
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a ``settle`` function that stores frames in a new folder of the scratch
    folder; the folder goes when the block ends, so act on the results inside it.

        with scratch(spark) as settle:
            training_set(..., settle=settle).write.parquet(target)
    """
    folder = f"{scratch_dir(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield lambda df: stored(df, f"{folder}/{uuid.uuid4().hex}")
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
