"""Exact medians of many float columns in one pass over the data.

The built-in ``median`` keeps every distinct value of a column in the memory of
one task. Here the distinct values stay spread over the cluster: they are
counted (with map-side combine), a histogram over a bounded number of value
ranges locates the range that holds the middle rank, and only that range is
ordered. The result is one row and nothing passes through the driver.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A doubling of the value is cut into this many ranges. A 32-bit float then
# falls into one of at most ~142,000 ranges (both signs) and a range holds
# at most ~50,000 different floats, so neither step below can grow with the data.
RANGES_PER_DOUBLING = 256


def exact_medians(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """One row with the median of each named float column, null if all are null.

    As usual, an even number of values gives the mean of the middle two.
    """
    names = list(values)
    # The values are columns before they are rows: a projection computes what they share once,
    # ``stack`` would read each text as often as its expression names it.
    columns = [values[name].cast("float").alias(f"v{number}") for number, name in enumerate(names)]
    pairs = [part for number in range(len(names)) for part in (F.lit(number), F.col(f"v{number}"))]
    counts = (
        df.select(*columns)
        .select(F.stack(F.lit(len(names)), *pairs).alias("which", "value"))
        .where(F.col("value").isNotNull())
        .groupBy("which", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("range", _value_range(F.col("value")))
    )

    # Which range holds the middle ranks: at most two ranges per column.
    per_column = Window.partitionBy("which")
    in_order = per_column.orderBy("range")
    middle = (
        counts.groupBy("which", "range")
        .agg(F.sum("n").alias("n"))
        .select(
            "which",
            "range",
            (F.sum("n").over(in_order) - F.col("n")).alias("before"),
            F.sum("n").over(in_order).alias("upto"),
            F.sum("n").over(per_column).alias("total"),
        )
        .where(_covers_middle(F.col("before"), F.col("upto")))
        .select("which", "range", "before", "total")
    )

    within = Window.partitionBy("which", "range").orderBy("value")
    picked = (
        counts.join(F.broadcast(middle), ["which", "range"])
        .withColumn("upto", F.col("before") + F.sum("n").over(within))
        .where(_covers_middle(F.col("upto") - F.col("n"), F.col("upto")))
    )
    return picked.agg(
        *[
            F.avg(F.when(F.col("which") == number, F.col("value").cast("double"))).alias(name)
            for number, name in enumerate(names)
        ]
    )


def _covers_middle(first: Column, end: Column) -> Column:
    """Do the zero-based ranks [first, end) include a middle rank of total?"""
    lower, upper = F.expr("(total - 1) div 2"), F.expr("total div 2")
    return (first <= upper) & (end > lower)


def _value_range(value: Column) -> Column:
    """Number of the value range; grows with the value, zero has its own."""
    doublings = F.log2(F.abs(value).cast("double")) + 150
    step = F.floor(doublings * RANGES_PER_DOUBLING).cast("double")
    return F.coalesce(F.signum(value.cast("double")) * step, F.lit(0.0))
