import re

import pytest
from pyspark.sql import functions as F

from checks.inputs import originations_raw, performance_raw
from checks.registry import QUERIES
from loanpanel.operators.labels import feature_cutoff, pre_default_rows, with_default_flag
from loanpanel.operators.panel import drop_bad_loans
from loanpanel.plans.training_set import aggregate_performance, training_set
from loanpanel.operators.originations import clean_originations
from loanpanel.operators.performance import clean_performance
from loanpanel.sources.scratch import scratch

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The raw tables as parquet, so that plans show only our operators."""
    path = str(tmp_path_factory.mktemp("raw"))
    performance_raw(spark, SF_DIR).write.parquet(f"{path}/performance")
    originations_raw(spark, SF_DIR).write.parquet(f"{path}/originations")
    return (
        spark.read.parquet(f"{path}/performance"),
        spark.read.parquet(f"{path}/originations"),
    )


def test_no_python_and_no_cross_join(raw):
    text = plan(training_set(*raw))
    for operator in ("Python", "Cartesian", "NestedLoop"):
        assert operator not in text


def test_building_a_plan_runs_no_job(spark, raw):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    training_set(*raw)
    assert set(tracker.getJobIdsForGroup(None)) == before


@pytest.fixture(scope="module")
def stored(spark):
    with scratch(spark) as settle:
        yield settle


def test_panel_rules_shuffle_twice_and_sort_once_by_loan(raw, stored):
    text = plan(drop_bad_loans(stored(clean_performance(raw[0]))))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert len(re.findall(r"[+:]- Window ", text)) == 2
    by_loan = r"Sort \[LOAN_SEQUENCE_NUMBER#\d+ ASC NULLS FIRST, MONTHLY"
    assert len(re.findall(by_loan, text)) == 1


def test_copies_are_combined_before_the_shuffle(raw, stored):
    text = plan(drop_bad_loans(stored(clean_performance(raw[0]))))
    assert "partial_min" in text
    assert text.index("hashpartitioning(key_hash") < text.index("partial_min")


def final_plan(df):
    """What was run, of the query and its subqueries; branches that reuse another's shuffle
    say only that."""
    df.collect()
    lines, initial = [], None
    for line in plan(df).split("\n"):
        column = re.search(r"[A-Za-z=]|$", line).start()
        if initial is not None and column >= initial:
            continue
        initial = column if "== Initial Plan ==" in line else None
        if initial is None:
            lines.append(line)
    return "\n".join(lines)


@pytest.mark.parametrize("columns", [["*"], ["LOAN_SEQUENCE_NUMBER", "EVER_RA"]])
def test_panel_is_evaluated_once(raw, stored, columns):
    """Also where few columns are selected."""
    text = final_plan(aggregate_performance(stored(clean_performance(raw[0]))).select(*columns))
    assert len(re.findall(r"[+:]- Window ", text)) == 2
    assert "ReusedExchange" in text


def test_panel_is_evaluated_once_under_a_join(spark):
    """A join on the loan adds, for the one reader that is under it, that the loan is not null."""
    raw = performance_raw(spark, SF_DIR), originations_raw(spark, SF_DIR)
    df = training_set(*raw)
    df.collect()
    assert re.search("ReusedExchange.*REPARTITION_BY_COL", plan(df))


@pytest.mark.parametrize("name", ["clean_performance", "join_performance_originations"])
def test_positions_are_found_once(spark, name):
    """Though the monthly table is read to fit medians and again to clean it."""
    df = QUERIES[name].run(spark, SF_DIR)
    df.collect()
    assert re.search(r"ReusedExchange.*Exchange hashpartitioning\(ok#", plan(df))


def test_customers_are_dealt_before_they_are_made_loans(spark):
    """Their file may be one task, however many rows it has."""
    text = plan(originations_raw(spark, SF_DIR))
    assert text.index("Generate explode") < text.index("Exchange") < text.index("Scan parquet")


def test_a_loop_over_wide_rows_is_not_one_method(raw):
    """Steps with a star are fused into one generated loop."""
    wide = plan(raw[1].withColumns({f"x{i}": F.col("CREDIT_SCORE") for i in range(10)}).limit(5))
    assert "Project" in wide and not re.search(r"\*\(\d+\) Project", wide)
    narrow = plan(raw[1].select(F.upper("CREDIT_SCORE")).limit(5))
    assert re.search(r"\*\(\d+\) Project", narrow)


@pytest.mark.parametrize("columns", [["*"], ["LOAN_SEQUENCE_NUMBER"]])
def test_row_mask_evaluates_the_panel_once(raw, stored, columns):
    history = with_default_flag(drop_bad_loans(stored(clean_performance(raw[0]))))
    text = final_plan(pre_default_rows(history).select(*columns))
    assert len(re.findall(r"[+:]- Window ", text)) == 3
    assert "ReusedExchange" in text


def test_mask_with_a_cutoff(raw, stored):
    """The history's own cutoff gives what the same cutoff gives when it is told."""
    history = with_default_flag(drop_bad_loans(stored(clean_performance(raw[0]))))
    cutoff = history.select(feature_cutoff(history)).first()[0]
    own, told = pre_default_rows(history), pre_default_rows(history, F.lit(cutoff))
    assert own.columns == told.columns
    assert sorted(own.collect()) == sorted(told.collect())
    assert history.count() > own.count() > 0


def test_medians_reuse_the_counts(raw):
    df = clean_performance(raw[0])
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_mode_date_shares_the_deduplicated_rows(raw):
    """No subquery deduplicates the keys alone, in a shuffle of its own."""
    df = clean_originations(raw[1])
    df.collect()
    assert "key_hash" in plan(df)
    assert not re.search(r"key_hash#[^\]]*\], functions=\[\]", plan(df))


def test_only_read_columns_are_scanned(raw):
    df = clean_performance(raw[0]).select("LOAN_SEQUENCE_NUMBER", "MOD_FLAG")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))
    assert schemas and all("CUMULATIVE_MOD_COST" not in s and "DDLPI" not in s for s in schemas)


def test_settled_panel_gives_the_same_result(raw, stored):
    cleaned = clean_performance(raw[0])
    lazily = aggregate_performance(cleaned)
    settled = aggregate_performance(cleaned, settle=stored)
    assert sorted(settled.collect()) == sorted(lazily.collect())
    assert plan(settled).count("Window") == 0


def test_widths(raw):
    assert len(clean_originations(raw[1]).columns) == 49
    assert len(clean_performance(raw[0]).columns) == 32
    assert len(training_set(*raw).columns) == 123


def test_training_set_has_one_row_per_loan(raw):
    df = training_set(*raw)
    counts = df.groupBy("LOAN_SEQUENCE_NUMBER").count().agg(F.max("count")).collect()
    assert counts[0][0] == 1
