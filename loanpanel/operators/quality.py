"""Opt-in quality reports: as one aggregation over the data, or as a by-product of the
action that reads the data anyway."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanpanel.functions.parsing import tolerant_float
from loanpanel.operators.patterns import NumericColumn


def indicator_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each 0/1 column is 0 and 1: one row per column."""
    totals = df.agg(*[_indicator(name).alias(name) for name in columns])
    return totals.select(F.inline(F.array(*[F.col(name) for name in columns])))


def _indicator(name: str) -> Column:
    return F.struct(
        F.lit(name).alias("column"),
        F.count_if(F.col(name) == 0).alias("zeros"),
        F.count_if(F.col(name) == 1).alias("ones"),
    )


def value_profile(raw: DataFrame, patterns: Sequence[NumericColumn]) -> DataFrame:
    """Nulls, bad text, sentinels, out-of-range values and range of raw numbers."""
    totals = raw.agg(*[_profile(pattern).alias(pattern.column) for pattern in patterns])
    return totals.select(F.inline(F.array(*[F.col(p.column) for p in patterns])))


def _profile(pattern: NumericColumn):
    text = F.col(pattern.column)
    number = tolerant_float(text)
    valid = pattern.observed()
    return F.struct(
        F.lit(pattern.column).alias("column"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(text.isNull()).alias("nulls"),
        F.count_if(text.isNotNull() & number.isNull()).alias("invalid"),
        F.count_if(number.isNotNull() & valid.isNull()).alias("sentinels"),
        F.count_if(valid < pattern.low).alias("below_range"),
        F.count_if(valid > pattern.high).alias("above_range"),
        F.min(valid).alias("smallest"),
        F.max(valid).alias("largest"),
    )


class Reports:
    """Reports on frames that an action passes through, without a pass of their own.

    Each method gives back its frame, to be used in its place; the report can be read once
    an action on what was made of it has ended, and waits for that. What the action does not
    read is not reported. A frame that a plan uses twice (to fit medians on, say) is watched
    in one of the two places only.

        reports = Reports()
        watched = reports.values(raw, "originations", patterns)
        clean_originations(watched, fit_on=raw).write.parquet(target)
        reports.value_profile(spark, "originations").show()
    """

    def __init__(self):
        self._watched: dict[tuple[str, str], Observation] = {}
        self._widths: dict[str, int] = {}

    def _watch(self, df: DataFrame, kind: str, name: str, totals: Sequence[Column]) -> DataFrame:
        if (kind, name) in self._watched:
            raise ValueError(f"{name} has a report of this kind already")
        watch = self._watched[kind, name] = Observation(f"{kind} of {name}")
        return df.observe(watch, *totals)

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        self._widths[name] = len(df.columns)
        return self._watch(df, "rows", name, [F.count(F.lit(1)).alias("rows")])

    def indicators(self, df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
        return self._watch(df, "indicators", name, [_indicator(c).alias(c) for c in columns])

    def values(self, raw: DataFrame, name: str, patterns: Sequence[NumericColumn]) -> DataFrame:
        return self._watch(raw, "values", name, [_profile(p).alias(p.column) for p in patterns])

    def row_count_report(self, spark: SparkSession) -> DataFrame:
        """As ``sources.delimited.row_count_report``, of all watched frames."""
        found = [
            (name, watch.get["rows"], self._widths[name])
            for (kind, name), watch in self._watched.items()
            if kind == "rows"
        ]
        return spark.createDataFrame(found, "source string, rows long, columns int")

    def indicator_profile(self, spark: SparkSession, name: str) -> DataFrame:
        return self._profile_frame(spark, "indicators", name, INDICATOR_PROFILE)

    def value_profile(self, spark: SparkSession, name: str) -> DataFrame:
        return self._profile_frame(spark, "values", name, VALUE_PROFILE)

    def _profile_frame(self, spark, kind: str, name: str, schema: T.StructType) -> DataFrame:
        # one row per column, as many as the caller named
        return spark.createDataFrame(list(self._watched[kind, name].get.values()), schema)


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


INDICATOR_PROFILE = T.StructType([T.StructField("column", T.StringType()), *_longs("zeros", "ones")])
VALUE_PROFILE = T.StructType(
    [
        T.StructField("column", T.StringType()),
        *_longs("rows", "nulls", "invalid", "sentinels", "below_range", "above_range"),
        T.StructField("smallest", T.FloatType()),
        T.StructField("largest", T.FloatType()),
    ]
)
