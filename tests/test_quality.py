import re

import pytest

from checks import registry
from checks.inputs import originations_raw
from loanpanel.operators.originations import ORIGINATION_PATTERNS, clean_originations
from loanpanel.operators.patterns import NumericColumn
from loanpanel.operators.quality import Reports, indicator_profile, value_profile
from loanpanel.sources.delimited import row_count_report

SF_DIR = "/root/testdata/sf0.001"
NUMERIC = [p for p in ORIGINATION_PATTERNS if type(p) is NumericColumn]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    originations_raw(spark, SF_DIR).write.parquet(f"{path}/originations")
    return spark.read.parquet(f"{path}/originations")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_come_with_the_write(spark, raw, tmp_path):
    reports = Reports()
    watched = reports.values(reports.rows(raw, "loans"), "loans", NUMERIC)
    cleaned = clean_originations(watched, fit_on=raw)
    flags = ["CREDIT_SCORE_IS_MISSING"]
    cleaned = reports.indicators(cleaned, "cleaned", flags)
    # no more reading than without reports
    assert len(re.findall("FileScan", plan(cleaned))) == len(re.findall("FileScan", plan(clean_originations(raw))))
    cleaned.write.parquet(f"{tmp_path}/cleaned")
    assert reports.row_count_report(spark).collect() == row_count_report(raw, "loans").collect()
    mine, expected = reports.value_profile(spark, "loans"), value_profile(raw, NUMERIC)
    assert mine.dtypes == expected.dtypes and mine.collect() == expected.collect()
    stored = spark.read.parquet(f"{tmp_path}/cleaned")
    mine, expected = reports.indicator_profile(spark, "cleaned"), indicator_profile(stored, flags)
    assert mine.dtypes == expected.dtypes and mine.collect() == expected.collect()


def test_a_frame_is_watched_once_per_kind(raw):
    reports = Reports()
    reports.rows(raw, "loans")
    with pytest.raises(ValueError, match="already"):
        reports.rows(raw, "loans")


def test_reports_on_an_empty_table(spark, raw):
    reports = Reports()
    none = raw.limit(0)
    watched = reports.values(reports.rows(none, "none"), "none", NUMERIC)
    watched.write.format("noop").mode("overwrite").save()
    assert reports.row_count_report(spark).first()["rows"] == 0
    assert reports.value_profile(spark, "none").collect() == value_profile(none, NUMERIC).collect()


def test_a_profile_runs_only_the_write_that_it_comes_with(spark, monkeypatch):
    """The profile of the originations needs no monthly rows, and no run of another query."""

    def unread(*_):
        raise AssertionError("read the monthly rows")

    monkeypatch.setattr(registry, "performance_raw", unread)
    found = registry.QUERIES["value_profile_observed"].run(spark, SF_DIR)
    expected = registry.QUERIES["value_profile"].run(spark, SF_DIR)
    assert found.collect() == expected.collect()
