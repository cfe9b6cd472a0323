"""Readers for the two headerless pipe-delimited files."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loanpanel.schemas import (
    ORIGINATION_SCHEMA,
    PERFORMANCE_ALIASES,
    PERFORMANCE_SCHEMA,
)


def read_originations(spark: SparkSession, path) -> DataFrame:
    """One row per loan, 32 string columns. ``path`` may be a list or a glob."""
    return spark.read.schema(ORIGINATION_SCHEMA).csv(path, sep="|", header=False)


def read_performance(spark: SparkSession, path) -> DataFrame:
    """One row per loan and month, 32 string columns."""
    return spark.read.schema(PERFORMANCE_SCHEMA).csv(path, sep="|", header=False)


@dataclass(frozen=True)
class Checked:
    """What a file holds: its whole lines as rows, and its broken lines.

    ``broken`` has the file, the line as it stands, how many fields it has and what is
    wrong with it (``too few fields``, ``too many fields``, or ``unreadable``, such as an
    open quote).
    """

    rows: DataFrame
    broken: DataFrame

    def report(self, name: str) -> DataFrame:
        """One row: lines that were kept and that were not, by what is wrong."""
        lines = self.rows.select(F.lit("kept").alias("problem")).union(self.broken.select("problem"))
        kinds = ("kept", "too few fields", "too many fields", "unreadable")
        counts = [F.count_if(F.col("problem") == k).alias(k.replace(" ", "_")) for k in kinds]
        return lines.agg(*counts).select(F.lit(name).alias("source"), "*")


BROKEN = "_broken_line"


def read_checked(spark: SparkSession, path, schema: StructType) -> Checked:
    """Rows of the lines that have as many fields as the schema, and the other lines, which
    the plain readers would cut or fill up with nulls."""
    width, first = len(schema), schema.names[0]
    reader = spark.read.schema(StructType([*schema.fields, StructField(BROKEN, StringType())]))
    # a parser that skips fields that a query does not read cannot count them
    reader = reader.option("columnPruning", False)
    lines = reader.csv(
        path, sep="|", header=False, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN
    )
    # The reader refuses a query that reads nothing but the broken line (such as a count of
    # rows), so the conditions read a field as well.
    read_too = F.length(F.coalesce(F.col(first), F.lit(""))) >= 0
    line = F.col(BROKEN)
    fields = F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit(""))) + 1
    problem = (
        F.when(fields < width, "too few fields")
        .when(fields > width, "too many fields")
        .otherwise("unreadable")
    )
    broken = lines.where(line.isNotNull() & read_too).select(
        F.col("_metadata.file_path").alias("file"),
        line.alias("line"),
        fields.alias("fields"),
        problem.alias("problem"),
    )
    return Checked(lines.where(line.isNull() & read_too).drop(BROKEN), broken)


def read_originations_checked(spark: SparkSession, path) -> Checked:
    return read_checked(spark, path, ORIGINATION_SCHEMA)


def read_performance_checked(spark: SparkSession, path) -> Checked:
    return read_checked(spark, path, PERFORMANCE_SCHEMA)


def canonical_performance_names(df: DataFrame) -> DataFrame:
    """Rename alternative column names, unless the canonical one is there too."""
    renames = {
        old: new
        for old, new in PERFORMANCE_ALIASES.items()
        if old in df.columns and new not in df.columns
    }
    return df.withColumnsRenamed(renames)


def row_count_report(df: DataFrame, name: str) -> DataFrame:
    """How many rows and columns a loaded table has, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).alias("columns")
    )
