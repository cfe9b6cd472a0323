import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanpanel.operators.medians import _value_range, exact_medians
from loanpanel.operators.patterns import NumericColumn, equals


def float32(value):
    return None if value is None else float(np.float32(value))


def medians(spark, columns):
    names = list(columns)
    rows = [tuple(row) for row in zip(*columns.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{n} float" for n in names)).repartition(5)
    return exact_medians(df, {n: F.col(n) for n in names}).collect()[0].asDict()


@pytest.mark.parametrize("seed", range(4))
def test_against_sorting(spark, seed):
    pick = random.Random(seed)
    size = pick.choice([1, 2, 501, 1000])
    makers = {
        "uniform": lambda: pick.uniform(-1e6, 1e6),
        "few": lambda: pick.choice([0.0, 1.0, 2.5]),
        "signed_zero": lambda: pick.choice([-0.0, 0.0, -1e-30, 1e-30]),
        "wide": lambda: pick.choice([-1, 1]) * 10 ** pick.uniform(-35, 35),
        "with_nulls": lambda: None if pick.random() < 0.4 else pick.uniform(0, 10),
        "close": lambda: 1000 + pick.random() / 1000,
        "nothing": lambda: None,
    }
    columns = {name: [float32(make()) for _ in range(size)] for name, make in makers.items()}
    result = medians(spark, columns)
    for name, values in columns.items():
        known = [v for v in values if v is not None]
        if known:
            expected = statistics.median(known)
            assert result[name] == pytest.approx(expected, rel=1e-12, abs=0), name
        else:
            assert result[name] is None


def test_one_value_may_hold_most_rows(spark):
    values = [7.0] * 5000 + [float(i) for i in range(3000)]
    assert medians(spark, {"x": values})["x"] == statistics.median(values)


def test_middle_between_two_far_values(spark):
    assert medians(spark, {"x": [-8.0, 64.0]})["x"] == 28.0


def test_matches_the_built_in(spark):
    df = spark.range(20_001).select(
        F.pow(F.rand(3) - 0.5, F.lit(3)).cast("float").alias("x"),
        F.round(F.rand(4) * 30).cast("float").alias("y"),
    )
    ours = exact_medians(df, {"x": F.col("x"), "y": F.col("y")}).collect()[0]
    assert tuple(ours) == tuple(df.agg(F.median("x"), F.median("y")).collect()[0])


def test_value_range_never_decreases(spark):
    pick = random.Random(1)
    values = sorted(
        {float32(s * 10 ** pick.uniform(-38, 38)) for s in (-1, 1) for _ in range(2000)}
        | {0.0, float("inf"), float("-inf")}
    )
    df = spark.createDataFrame([(v,) for v in values], "v float").coalesce(1)
    ranges = [r[0] for r in df.select(_value_range(F.col("v"))).collect()]
    assert ranges == sorted(ranges)


def test_a_text_is_read_once(spark):
    """The parsed number is a column before it is a row, and its text is parsed once for it."""
    df = spark.range(5).select(F.concat("id", F.lit("")).alias("text"))
    number = NumericColumn("text", 0, 10, "int", equals(3)).observed()
    text = exact_medians(df, {"text": number})._jdf.queryExecution().executedPlan().toString()
    assert "Generate stack" in text
    assert not [x for x in text.split("\n") if "Generate stack" in x and "cast" in x]
