from pathlib import Path

import pytest

from loanpanel.operators.performance import clean_performance
from loanpanel.schemas import ORIGINATION_COLUMNS, PERFORMANCE_COLUMNS
from loanpanel.sources.delimited import (
    canonical_performance_names,
    read_originations,
    read_performance,
    read_performance_checked,
    row_count_report,
)
from loanpanel.sources.stored import ByLoan, join_by_loan
from loanpanel.sources.scratch import scratch, scratch_dir, stored


def test_reads_pipe_delimited_text(spark, tmp_path):
    fields = [""] * 32
    fields[0], fields[1], fields[3] = "F18Q10000001", "202301", " "
    fields[2] = '"a|b"'
    path = tmp_path / "performance.txt"
    path.write_text("|".join(fields) + "\n" + "|".join(["F18Q10000002"] + [""] * 31) + "\n")
    df = read_performance(spark, str(path))
    assert df.columns == list(PERFORMANCE_COLUMNS)
    first, second = sorted(df.collect())
    assert first.CURRENT_ACTUAL_UPB == "a|b"
    assert first.CURRENT_DELINQUENCY_STATUS == " "
    assert first.LOAN_AGE is None and second.MONTHLY_REPORTING_PERIOD is None
    assert {t for _, t in df.dtypes} == {"string"}
    assert row_count_report(df, "p").collect()[0].asDict() == {
        "source": "p",
        "rows": 2,
        "columns": 32,
    }


def test_reads_originations(spark, tmp_path):
    path = tmp_path / "originations.txt"
    path.write_text("|".join(str(i) for i in range(32)) + "\n")
    df = read_originations(spark, str(path))
    assert df.columns == list(ORIGINATION_COLUMNS)
    assert df.collect()[0].LOAN_SEQUENCE_NUMBER == "19"


def test_broken_lines_are_set_aside(spark, tmp_path):
    whole = ["|".join([f"F{i}", "202301"] + [""] * 30) for i in range(3)]
    quoted = "|".join(["F3", "202301", '"a|b"'] + [""] * 29)
    short, long, one = whole[0][:-5], whole[1] + "|x|y", "nothing else"
    (tmp_path / "a.txt").write_text("\n".join([whole[0], short, whole[1], one]) + "\n")
    (tmp_path / "b.txt").write_text("\n".join([long, whole[2], quoted]) + "\n")
    checked = read_performance_checked(spark, str(tmp_path))
    assert checked.rows.columns == list(PERFORMANCE_COLUMNS)
    kept = sorted(r.LOAN_SEQUENCE_NUMBER for r in checked.rows.collect())
    assert kept == ["F0", "F1", "F2", "F3"]
    assert checked.rows.count() == 4 and checked.broken.count() == 3
    found = {(r.file.rsplit("/", 1)[1], r.line, r.fields, r.problem) for r in checked.broken.collect()}
    assert found == {
        ("a.txt", short, 27, "too few fields"),
        ("a.txt", one, 1, "too few fields"),
        ("b.txt", long, 34, "too many fields"),
    }
    assert [r.asDict() for r in checked.report("p").collect()] == [
        {"source": "p", "kept": 4, "too_few_fields": 2, "too_many_fields": 1, "unreadable": 0}
    ]
    assert read_performance(spark, str(tmp_path)).count() == 7


def test_a_file_without_lines_has_no_broken_ones(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    checked = read_performance_checked(spark, str(tmp_path / "empty.txt"))
    assert checked.rows.count() == checked.broken.count() == 0
    assert checked.report("p").first()["kept"] == 0


@pytest.fixture
def by_loan(spark, tmp_path):
    """Two stored tables of different loans; the names go when the test ends."""
    key = "concat('F', id) AS LOAN_SEQUENCE_NUMBER"
    one, other = (ByLoan(f"stored_{name}", f"{tmp_path}/{name}", 4) for name in ("one", "other"))
    one.store(spark.range(0, 200).selectExpr(key, "id AS x"))
    other.store(spark.range(100, 400).selectExpr(key, "2 * id AS y"))
    yield one, other
    for table in (one, other):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def joined(spark, one, other):
    df = join_by_loan(one.read(spark), other.read(spark))
    rows = {r.LOAN_SEQUENCE_NUMBER: (r.x, r.y) for r in df.collect()}
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_are_joined_without_a_shuffle(spark, by_loan):
    one, other = by_loan
    rows, plan = joined(spark, one, other)
    assert rows == {f"F{i}": (i, 2 * i) for i in range(100, 200)}
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert len(spark.read.parquet(one.path).inputFiles()) == 4


def test_stored_tables_can_grow_and_be_replaced(spark, by_loan):
    one, other = by_loan
    key = "concat('F', id) AS LOAN_SEQUENCE_NUMBER"
    other.store(spark.range(50, 100).selectExpr(key, "2 * id AS y"), "append")
    one.store(spark.range(0, 500).selectExpr(key, "id + 1 AS x"), "overwrite")
    rows, plan = joined(spark, one, other)
    assert rows == {f"F{i}": (i + 1, 2 * i) for i in range(50, 400)}
    assert "Exchange" not in plan
    with pytest.raises(Exception, match="already exists"):
        one.store(spark.range(1).selectExpr(key, "id AS x"))


def test_stored_tables_outlive_the_catalog(spark, by_loan):
    one, other = by_loan
    expected, _ = joined(spark, one, other)
    spark.sql(f"DROP TABLE {one.name}")
    one.declare(spark)
    rows, plan = joined(spark, one, other)
    assert rows == expected and "Exchange" not in plan


def test_alternative_names(spark):
    df = spark.createDataFrame(
        [("F18Q10000001", "202301", "Y", "P")],
        "LOAN_SEQUENCE_NUMBER string, MONTHLY_REPORTING_PERIOD string, "
        "INTEREST_RATE_STEP_INDICATOR string, MODIFICATION_FLAG string",
    )
    assert canonical_performance_names(df).columns[2:] == ["STEP_MOD_FLAG", "MOD_FLAG"]
    with pytest.warns(UserWarning):
        row = clean_performance(df).collect()[0]
    assert (row.STEP_MOD_FLAG, row.MOD_FLAG) == ("STEP_MOD", "PRIOR_PERIOD_MOD")


def test_scratch_dir_is_the_one_the_session_names(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark) == shared
    assert stored(spark.range(5), f"{tmp_path}/mine").inputFiles()[0].startswith(f"file://{tmp_path}/mine/")


def test_scratch_leaves_nothing_behind(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    with scratch(spark) as settle:
        table = settle(spark.range(5))
        assert table.count() == 5
        assert table.inputFiles()[0].startswith(f"file://{shared}/")
    assert set(shared.iterdir()) == before
