"""Run registered queries against their DuckDB SQL: python -m checks.compare [sf] [name...]."""

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.registry import QUERIES

TABLES = ("orders", "customer")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted: equal iff the same multiset."""
    frame = frame[sorted(frame.columns)]

    def as_text(value):
        if value is None or value is pd.NaT or value != value:
            return "NULL"
        if isinstance(value, float):
            return repr(round(value, 6))
        if hasattr(value, "strftime"):
            return value.strftime("%Y-%m-%d")
        return str(value)

    text = pd.DataFrame({name: frame[name].map(as_text) for name in frame.columns}, dtype=object)
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def spark_pandas(df) -> pd.DataFrame:
    """Rows with plain Python values (no float images of nullable integers)."""
    return pd.DataFrame(
        {i: list(c) for i, c in enumerate(zip(*[tuple(r) for r in df.collect()]))}, dtype=object
    ).set_axis(df.columns, axis=1)


def duckdb_pandas(connection, statement) -> pd.DataFrame:
    result = connection.execute(statement)
    names = [column[0] for column in result.description]
    rows = result.fetchall()
    return pd.DataFrame({i: list(c) for i, c in enumerate(zip(*rows))}, dtype=object).set_axis(
        names, axis=1
    )


# Spark and DuckDB names of the types the queries return.
SAME_TYPE = {
    "string": "VARCHAR",
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "date": "DATE",
}


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when the query agrees with its SQL, else what differs."""
    registered = QUERIES[name]
    df = registered.run(spark, sf_dir)
    described = connection.execute(f"DESCRIBE {registered.sql}").fetchall()
    expected_types = {column[0]: column[1] for column in described}
    types = {column: SAME_TYPE.get(dtype, dtype) for column, dtype in df.dtypes}
    if types != expected_types:
        odd = set(types.items()) ^ set(expected_types.items())
        return f"schema: {sorted(odd)}"
    actual = spark_pandas(df)
    expected = duckdb_pandas(connection, registered.sql)
    if actual.shape != expected.shape:
        return f"shape: {actual.shape} instead of {expected.shape}"
    actual, expected = canonical(actual), canonical(expected)
    unequal = [c for c in actual.columns if not actual[c].equals(expected[c])]
    if unequal:
        column = unequal[0]
        rows = actual[column] != expected[column]
        sample = list(zip(actual[column][rows], expected[column][rows]))[:3]
        return f"values: {unequal[:6]} e.g. {sample}"
    return None


def main(scale: str = "sf0.01", *names: str) -> int:
    sf_dir = f"/root/testdata/{scale}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:5.1f}s {name}", problem or "", flush=True)
    print(f"{failures} of {len(names or QUERIES)} differ")
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
