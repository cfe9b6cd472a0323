"""Every registered query against its DuckDB statement, at the smallest scale.

Queries of one column each are part of clean_originations and clean_performance
and are compared by ``python -m checks.compare``.
"""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from checks.registry import QUERIES, SHORT_NAMES
from loanpanel.operators.originations import ORIGINATION_PATTERNS
from loanpanel.operators.performance import PERFORMANCE_PATTERNS

SF_DIR = "/root/testdata/sf0.001"
SINGLE = {
    SHORT_NAMES.get(p.column, f"clean_{p.column.lower()}")
    for p in (*ORIGINATION_PATTERNS, *PERFORMANCE_PATTERNS)
}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in SINGLE])
def test_agrees_with_duckdb(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 123
    assert df.count() > 0


def test_every_query_has_a_statement():
    """Those of the optional subpackages are tested beside them."""
    assert QUERIES.keys() <= queries().keys()
    assert QUERIES.keys() <= oracle_sql().keys()
    assert oracle_sql().keys() <= queries().keys()
    assert len(QUERIES) >= 120
