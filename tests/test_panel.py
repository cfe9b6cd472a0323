import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from loanpanel.operators.features import feature_columns, loan_features
from loanpanel.operators.labels import (
    default_in_next_months,
    default_in_next_rows,
    default_labels,
    exit_category,
    pre_default_rows,
    with_chrono_age,
    with_default_flag,
    with_first_default,
)
from loanpanel.operators.panel import (
    drop_bad_loans,
    implausible_loans,
    loans_with_balance_jump,
    loans_with_missing_balance,
    loans_with_status_jump,
    one_row_per_month,
    until_termination,
    without_loans,
)
from loanpanel.operators.performance import clean_performance, filter_reporting_window
from loanpanel.plans.training_set import aggregate_performance
from loanpanel.schemas import LOAN, MONTH, PERFORMANCE_SCHEMA

START = 2023 * 12


def period(offset):
    index = START + offset
    return f"{index // 12}{index % 12 + 1:02d}"


def day(offset):
    index = START + offset
    return date(index // 12, index % 12 + 1, 1)


def month_row(loan, offset, **values):
    row = {
        LOAN: loan,
        MONTH: period(offset),
        "CURRENT_ACTUAL_UPB": "100000",
        "CURRENT_DELINQUENCY_STATUS": "0",
        "LOAN_AGE": str(offset),
        "CURRENT_INTEREST_RATE": "4.0",
        "CURRENT_NON_INTEREST_BEARING_UPB": "0",
        "ELTV": "80",
        "DDLPI": period(offset - 1),
        **values,
    }
    return tuple(row.get(name) for name in PERFORMANCE_SCHEMA.names)


def panel(spark, rows):
    return clean_performance(spark.createDataFrame(rows, PERFORMANCE_SCHEMA))


def loan(name, months=10, **by_month):
    """A quiet loan; ``by_month`` maps a column to {month: value}."""
    return [
        month_row(name, m, **{c: v[m] for c, v in by_month.items() if m in v})
        for m in range(months)
    ]


def names(df):
    return {row[LOAN] for row in df.select(LOAN).collect()}


def test_deduplication_does_not_depend_on_the_input_order(spark):
    rows = [
        month_row("A", 0, ELTV="70"),
        month_row("A", 0, ELTV="60"),
        month_row("A", 0, ELTV="60", MOD_FLAG="Y"),
        month_row("A", 1),
    ]
    expected = None
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        kept = sorted(one_row_per_month(panel(spark, shuffled).repartition(3)).collect())
        assert len(kept) == 2 and kept[0].ELTV == 60
        assert expected in (None, kept)
        expected = kept
    by_ratio = one_row_per_month(panel(spark, rows).withColumn("o", -F.col("ELTV")), ["o"])
    assert by_ratio.where(F.col(MONTH) == day(0)).collect()[0].ELTV == 70


def test_a_third_of_all_rows_may_be_copies_of_one_month(spark):
    rows = panel(spark, loan("A") + loan("B"))
    copies = rows.where((F.col(LOAN) == "A") & (F.col(MONTH) == day(3)))
    copy = F.explode(F.sequence(F.lit(1), F.lit(20_000)))
    many = rows.union(copies.withColumn("copy", copy).drop("copy")).repartition(8)
    assert one_row_per_month(many).count() == 20
    assert drop_bad_loans(many).count() == 20


def test_truncation_keeps_the_closing_month(spark):
    rows = loan("A", ZERO_BALANCE_CODE={4: "01", 6: "09"}) + loan("B")
    kept = until_termination(panel(spark, rows)).groupBy(LOAN).count().collect()
    assert {r[0]: r[1] for r in kept} == {"A": 5, "B": 10}


STATUS, UPB, NIB = (
    "CURRENT_DELINQUENCY_STATUS",
    "CURRENT_ACTUAL_UPB",
    "CURRENT_NON_INTEREST_BEARING_UPB",
)
JUMP = {UPB: {5: "101001"}}
LOANS = {
    "quiet": {},
    "status_by_one": {STATUS: {3: "1", 4: "2", 5: "1"}},
    "status_by_two": {STATUS: {3: "2"}},
    "upb_within_tolerance": {UPB: {5: "101000"}},
    "upb_jump": JUMP,
    "upb_modified": {**JUMP, "MOD_FLAG": {5: "Y"}},
    "upb_deferred": {**JUMP, "PAYMENT_DEFERRAL_FLAG": {5: "P"}},
    "upb_step": {**JUMP, "INTEREST_RATE_STEP_INDICATOR": {5: "N"}},
    "upb_assisted": {**JUMP, "BORROWER_ASSISTANCE_STATUS_CODE": {5: "F"}},
    "upb_disaster": {**JUMP, "DELINQUENCY_DUE_TO_DISASTER": {5: "Y"}},
    "upb_nib": {**JUMP, NIB: {5: "101"}},
    "upb_small_nib": {**JUMP, NIB: {5: "100"}},
    "upb_missing": {UPB: {2: None}},
    "upb_missing_when_closed": {UPB: {9: None}, "ZERO_BALANCE_CODE": {9: "01"}},
    "jump_after_closing": {STATUS: {6: "9"}, "ZERO_BALANCE_CODE": {4: "01"}},
}
BAD_STATUS = {"status_by_two"}
BAD_UPB = {"upb_jump", "upb_small_nib"}
BAD_MISSING = {"upb_missing"}


@pytest.fixture(scope="module")
def rule_panel(spark):
    rows = [row for name, columns in LOANS.items() for row in loan(name, **columns)]
    return panel(spark, rows).cache()


def test_each_rule(rule_panel):
    history = until_termination(one_row_per_month(rule_panel))
    assert names(loans_with_status_jump(history)) == BAD_STATUS
    assert names(loans_with_balance_jump(history)) == BAD_UPB
    assert names(loans_with_missing_balance(history)) == BAD_MISSING
    assert names(implausible_loans(history)) == BAD_STATUS | BAD_UPB | BAD_MISSING


def test_composed_rules_equal_the_single_ones(rule_panel):
    history = until_termination(one_row_per_month(rule_panel))
    single = without_loans(history, implausible_loans(history))
    composed = drop_bad_loans(rule_panel)
    assert sorted(composed.collect()) == sorted(single.select(*composed.columns).collect())
    assert names(composed) == set(LOANS) - BAD_STATUS - BAD_UPB - BAD_MISSING


def test_consecutive_months_option(spark):
    rows = [r for i, r in enumerate(loan("gap", **{STATUS: {5: "2"}})) if i != 4]
    rows += loan("step", **{STATUS: {5: "2"}})
    assert names(drop_bad_loans(panel(spark, rows))) == set()
    strict = drop_bad_loans(panel(spark, rows), require_consecutive_months=True)
    assert names(strict) == {"gap"}


def test_default_flag_conditions(spark):
    rows = (
        loan("late", **{STATUS: {1: "1", 2: "2", 3: "3"}})
        + loan("ra", **{STATUS: {3: "RA"}})
        + loan("sale", ZERO_BALANCE_CODE={3: "03"})
        + loan("resold", ZERO_BALANCE_CODE={3: "16"})
        + loan("unpaid", DDLPI={3: period(0)})
        + loan("unknown", DDLPI={3: None})
    )
    flagged = with_default_flag(panel(spark, rows)).where(F.col(MONTH) == day(3))
    assert {r[LOAN]: r.IS_IN_DEFAULT for r in flagged.collect()} == {
        "late": 1,
        "ra": 1,
        "sale": 1,
        "resold": 0,
        "unpaid": 1,
        "unknown": 0,
    }


def test_exit_categories(spark):
    codes = ["REO_DISPOSITION", "PREPAID_OR_MATURED", "DEFECT_PRIOR_TO_OTHER_EVENT", "?", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    found = [r[0] for r in df.select(exit_category(F.col("c"))).collect()]
    assert found == ["Default", "Prepaid", "Repurchased", "Active", "Active"]


def test_lookahead(spark):
    rows = loan("A", 8, **{STATUS: {7: "3"}})
    flagged = with_default_flag(panel(spark, rows))
    ahead = (
        flagged.select(
            MONTH, default_in_next_rows().alias("r"), default_in_next_months().alias("m")
        )
        .orderBy(MONTH)
        .collect()
    )
    assert [r.r for r in ahead] == [0, 1, 1, 1, 1, 1, 1, 1]
    assert [r.m for r in ahead] == [0, 1, 1, 1, 1, 1, 1, 0]


def test_lookahead_counts_months_not_rows(spark):
    rows = [month_row("A", 0), month_row("A", 7, **{STATUS: "3"})]
    flagged = with_default_flag(panel(spark, rows))
    ahead = flagged.select(
        MONTH, default_in_next_rows().alias("r"), default_in_next_months().alias("m")
    )
    first = ahead.orderBy(MONTH).collect()[0]
    assert (first.r, first.m) == (1, 0)


def test_chrono_age_ignores_resets(spark):
    rows = loan("A", 5, LOAN_AGE={3: "0", 4: "1"})
    aged = with_chrono_age(panel(spark, rows)).orderBy(MONTH).collect()
    assert [r.CHRONO_AGE for r in aged] == [0, 1, 2, 3, 4]


def defaulting_panel(spark):
    rows = (
        loan("steady", 20)
        + loan("late", 20, **{STATUS: {8: "1", 9: "2", 10: "3"}})
        + loan("at_once", 20, **{STATUS: {m: "3" for m in range(20)}})
        + loan("recent", 20, **{STATUS: {16: "1", 17: "2", 18: "3", 19: "4"}})
        + [month_row("newcomer", 19)]
    )
    return panel(spark, rows)


def test_features_see_nothing_after_default_or_cutoff(spark):
    rows = pre_default_rows(with_default_flag(drop_bad_loans(defaulting_panel(spark))))
    last = {r[0]: r[1] for r in rows.groupBy(LOAN).agg(F.max(MONTH)).collect()}
    assert last == {"steady": day(13), "late": day(9), "recent": day(13)}


def test_aggregate(spark):
    result = aggregate_performance(defaulting_panel(spark), next_6mo_label=True)
    loans = {r[LOAN]: r for r in result.collect()}
    assert set(loans) == {"steady", "late", "recent"}
    late = loans["late"]
    assert late.PERFORMANCE_MONTHS_OBSERVED == 10
    assert late.MAX_DELINQUENCY_STATUS == 2
    assert late.NUMBER_OF_LATE_MONTHS == 2
    assert late.TOTAL_MONTHS_IN_DEFAULT == 1
    assert late.AGE_AT_FIRST_DEFAULT == 10
    assert late.IS_TERMINAL_DEFAULT == 0
    assert {n: r.LABEL_EVER_DEFAULTED for n, r in loans.items()} == {
        "steady": 0,
        "late": 1,
        "recent": 1,
    }
    assert {n: r.LABEL_DEFAULT_NEXT_6MO for n, r in loans.items()} == {
        "steady": 0,
        "late": 1,
        "recent": 1,
    }
    assert len(aggregate_performance(defaulting_panel(spark)).columns) == 75
    assert len(feature_columns()) == 64


def test_aggregate_with_a_given_cutoff(spark):
    result = aggregate_performance(defaulting_panel(spark), cutoff=F.lit(day(4)))
    assert {r.LAST_MONTHLY_REPORTING_PERIOD for r in result.collect()} == {day(4)}


def test_one_pass_equals_separate_features_and_labels(spark):
    cleaned = defaulting_panel(spark)
    rows = with_default_flag(drop_bad_loans(cleaned))
    separate = loan_features(pre_default_rows(rows)).join(default_labels(rows), LOAN)
    together = aggregate_performance(cleaned)
    assert sorted(separate.select(*together.columns).collect()) == sorted(together.collect())


def test_default_label_equals_the_maximum_of_row_lookaheads(spark):
    rows = with_default_flag(drop_bad_loans(defaulting_panel(spark)))
    by_rows = rows.withColumn("ahead", default_in_next_rows()).groupBy(LOAN).agg(F.max("ahead"))
    labels = default_labels(rows).select(LOAN, "LABEL_DEFAULT_6MO")
    assert sorted(by_rows.collect()) == sorted(labels.collect())


def test_first_and_last_are_by_month(spark):
    rows = loan(
        "A",
        6,
        **{
            UPB: {0: "100500", 5: "0"},
            "ELTV": {0: "90", 4: "999", 5: "999"},
            "CURRENT_MONTH_MOD_COST": {2: "5", 5: "7"},
            "BORROWER_ASSISTANCE_STATUS_CODE": {5: "T"},
        },
    )
    rows += loan("B", 12)
    random.Random(0).shuffle(rows)
    a = {r[LOAN]: r for r in aggregate_performance(panel(spark, rows).repartition(4)).collect()}["A"]
    assert (a.INITIAL_ACTUAL_UPB, a.LAST_ACTUAL_UPB, a.FINAL_NON_ZERO_UPB) == (100500, 0, 100000)
    assert (a.INITIAL_ELTV, a.LAST_ELTV, a.ELTV_EVER_MISSING) == (90, 80, 1)
    assert (a.LAST_ELTV_IS_MISSING, a.INITIAL_ELTV_IS_MISSING) == (1, 0)
    assert (a.LAST_MONTHLY_MOD_COST, a.MAX_MONTHLY_MOD_COST) == (7.0, 7.0)
    assert a.AVG_MONTHLY_MOD_COST == pytest.approx(2.0)
    assert (a.EVER_TRIAL_PERIOD, a.LAST_ASSISTANCE_STATUS) == (1, "TRIAL_PERIOD")


def test_deviation_of_one_month_is_zero(spark):
    rows = loan("A", 1) + loan("B", 7)
    a = {r[LOAN]: r for r in aggregate_performance(panel(spark, rows)).collect()}["A"]
    assert (a.DELINQUENCY_STATUS_STDDEV, a.INTEREST_RATE_STDDEV) == (0.0, 0.0)


def test_output_does_not_depend_on_partitioning(spark):
    cleaned = defaulting_panel(spark)
    expected = sorted(aggregate_performance(cleaned.coalesce(1)).collect())
    for parts in (3, 7):
        assert sorted(aggregate_performance(cleaned.repartition(parts)).collect()) == expected
    assert len({row[LOAN] for row in expected}) == len(expected)


def test_first_default_window(spark):
    rows = with_first_default(with_default_flag(defaulting_panel(spark)))
    firsts = {r[0]: r[1] for r in rows.select(LOAN, "FIRST_DEFAULT").distinct().collect()}
    assert firsts["late"] == day(10) and firsts["steady"] is None


def test_reporting_window(spark):
    rows = [month_row("A", m) for m in (-1, 0, 15, 16)] + [month_row("A", 1, **{MONTH: "bad"})]
    kept = filter_reporting_window(spark.createDataFrame(rows, PERFORMANCE_SCHEMA))
    assert sorted(r.REPORTING_DATE for r in kept.collect()) == [day(0), day(15)]
