"""Tables that are stored by loan, so that they are joined again and again without a shuffle.

A table is cut into buckets by its loan key, and every bucket is one file, sorted by loan.
Two tables with the same number of buckets (or one a multiple of the other, with
``spark.sql.bucketing.coalesceBucketsInJoin.enabled``) meet bucket by bucket. The number is a
decision for the tables' lifetime: such that a bucket of the larger one is 200-500 MB.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loanpanel.schemas import LOAN


@dataclass(frozen=True)
class ByLoan:
    """A stored table: its name in the session's catalog, its folder (shared by all
    executors), its number of buckets."""

    name: str
    path: str
    buckets: int

    def store(self, df: DataFrame, mode: str = "error") -> None:
        """Writes the frame: one shuffle, and one task and file per bucket. ``append`` adds
        a file per bucket that has new loans; ``overwrite`` replaces the table."""
        dealt = df.repartition(self.buckets, LOAN).sortWithinPartitions(LOAN)
        writer = dealt.write.mode(mode).format("parquet").option("path", self.path)
        writer.bucketBy(self.buckets, LOAN).sortBy(LOAN).saveAsTable(self.name)

    def declare(self, spark: SparkSession) -> None:
        """Makes a table that another session stored known to this one's catalog."""
        schema = spark.read.parquet(self.path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({LOAN}) "
            f"SORTED BY ({LOAN}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def join_by_loan(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two stored tables on the loan: no shuffle, whatever their sizes are taken to be."""
    return one.hint("merge").join(other.hint("merge"), LOAN, "inner")
