"""Rules for the loan key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.schemas import LOAN


def with_loan_key(df: DataFrame, trim: bool = False) -> DataFrame:
    """Loan key as a string; rows without one are dropped.

    A table without the key column is an error, not a warning: nothing that follows
    means anything without it.
    """
    key = F.col(LOAN).cast("string")
    df = df.withColumn(LOAN, F.trim(key) if trim else key)
    return df.where(F.col(LOAN).isNotNull())


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(LOAN).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()
) -> DataFrame:
    """Keep the smallest row of each key, by ``prefer`` first, then all columns.

    A minimum, unlike a ranking, is combined before the shuffle: any number of
    copies of a key leaves each task as one row. Loan keys start alike, so sorting
    by a hash of the key first spares most comparisons of whole strings.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    ordered = [*prefer, *[name for name in others if name not in prefer]]
    smallest = (
        df.withColumn("key_hash", F.xxhash64(*keys))
        .groupBy("key_hash", *keys)
        .agg(F.min(F.struct(*ordered)).alias("smallest"))
    )
    return smallest.select(
        *[
            F.col(name) if name in keys else F.col(f"smallest.{name}").alias(name)
            for name in df.columns
        ]
    )
