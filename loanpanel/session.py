"""Session settings that suit wide per-row projections."""

from pyspark.sql import SparkSession


def tuned(spark: SparkSession) -> SparkSession:
    """Set what can be set on a running session.

    The JVM never compiles a method of more than 8,000 bytes of bytecode. One
    projection of all cleaned columns exceeds that inside whole-stage code, and
    would be interpreted; with this limit Spark generates it in small methods.

    A loop over rows of many columns can stay below that limit and still be one method so
    long that it is compiled only when the stage is nearly over. Wider rows than this go
    through projections, which Spark cuts into small methods.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.codegen.maxFields", "40")
    return spark
