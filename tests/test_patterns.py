from datetime import date

import pytest
from pyspark.sql import functions as F

from loanpanel.functions.parsing import metro_code, month_start, origination_quarter
from loanpanel.operators.originations import (
    ORIGINATION_PATTERNS,
    BorrowerCount,
    MetroColumn,
    PostalColumn,
    clean_originations,
    derive_origination_date,
    validate_loans,
)
from loanpanel.operators.patterns import (
    CategoryColumn,
    CostColumn,
    DateDependentRatio,
    DelinquencyStatus,
    EraFlagColumn,
    FlagColumn,
    FreeTextCategory,
    MonthColumn,
    NumericColumn,
    OpenCategory,
    OpenNumber,
    OptionalMonthColumn,
    at_most,
    below,
    clean_columns,
    equals,
)
from loanpanel.operators.performance import (
    PERFORMANCE_PATTERNS,
    clean_performance,
    clean_reporting_period,
)
from loanpanel.plans.earlier_rules import (
    EARLIER_ORIGINATION_PATTERNS,
    EARLIER_PERFORMANCE_PATTERNS,
)
from loanpanel.schemas import ORIGINATION_SCHEMA


def cleaned(spark, values, pattern, **columns):
    """The rows of one cleaned column, in input order, with its indicators."""
    names = ["row", pattern.column, *columns]
    rows = list(zip(range(len(values)), values, *columns.values()))
    types = ["row int", f"{pattern.column} string", *[f"{c} date" for c in columns]]
    df = spark.createDataFrame(rows, ", ".join(types))
    result = clean_columns(df, [pattern]).orderBy("row")
    kept = [name for name in result.columns if name not in ("row", *columns)]
    assert names[1] in kept
    return [tuple(row) for row in result.select(*kept).collect()]


def test_numeric(spark):
    pattern = NumericColumn("CREDIT_SCORE", 300, 850, "short", equals(9999))
    raw = ["700", "9999", None, "abc", "12", "900", "NaN", " 720 "]
    # the median of 700, 12, 900, 720 before clipping is 710
    assert cleaned(spark, raw, pattern) == [
        (700, 0),
        (710, 1),
        (710, 1),
        (710, 1),
        (300, 0),
        (850, 0),
        (710, 1),
        (720, 0),
    ]


def test_numeric_truncates_the_imputed_median(spark):
    pattern = NumericColumn("X", 0, 1000, "short", equals(9999))
    assert cleaned(spark, ["719", "720", None], pattern) == [(719, 0), (720, 0), (719, 1)]


def test_numeric_without_any_value_stays_null(spark):
    pattern = NumericColumn("X", 0, 10, "byte", equals(9))
    assert cleaned(spark, ["9", None], pattern) == [(None, 1), (None, 1)]


def test_missing_predicates(spark):
    assert cleaned(spark, ["0", "-5", "120"], NumericColumn("T", 60, 480, "int", at_most(0))) == [
        (120, 1),
        (120, 1),
        (120, 0),
    ]
    assert cleaned(spark, ["0", "-5", "120"], NumericColumn("T", 60, 480, "int", equals(0))) == [
        (60, 1),
        (60, 0),
        (120, 0),
    ]
    assert cleaned(spark, ["-3", "7"], NumericColumn("A", 0, 600, "short", below(0))) == [
        (7, 1),
        (7, 0),
    ]


def test_binary_flag(spark):
    raw = ["Y", " n", "1", "0", "9", None]
    assert cleaned(spark, raw, FlagColumn("F", {"Y": 1, "N": 0})) == [
        (1,),
        (0,),
        (1,),
        (0,),
        (0,),
        (0,),
    ]
    flagged = FlagColumn("F", {"Y": 1, "N": 0}, missing_flag=True)
    assert cleaned(spark, ["Y", "n", "9", None], flagged) == [(1, 0), (0, 0), (0, 1), (0, 1)]


def test_era_flag(spark):
    pattern = EraFlagColumn("D", {"Y": 1}, month_column="M")
    months = [date(2013, 12, 1), date(2014, 1, 1), None]
    assert cleaned(spark, ["Y", None, "N"], pattern, M=months) == [(1, 1), (0, 0), (0, 0)]


def test_categorical(spark):
    labels = {"P": "PRIMARY", "I": "INVESTMENT"}
    raw = ["P", " i ", "INVESTMENT", "9", None]
    assert cleaned(spark, raw, CategoryColumn("O", labels, "UNKNOWN")) == [
        ("PRIMARY",),
        ("INVESTMENT",),
        ("INVESTMENT",),
        ("UNKNOWN",),
        ("UNKNOWN",),
    ]
    special = CategoryColumn("O", labels, "UNKNOWN", {"IS_NINE": "9"}, missing_flag=True)
    assert cleaned(spark, ["P", "9", None], special) == [
        ("PRIMARY", 0, 0),
        ("UNKNOWN", 1, 1),
        ("UNKNOWN", 0, 1),
    ]
    codes = CategoryColumn("O", labels, "UNKNOWN", keep_codes=True)
    assert cleaned(spark, ["p", "PRIMARY"], codes) == [("P",), ("UNKNOWN",)]


def test_numeric_codes(spark):
    pattern = CategoryColumn("Z", {"1": "PREPAID", "9": "REO"}, "NONE", numeric_codes=True)
    raw = ["01", "1.0", " 9", "1.5", "x", None, "REO"]
    assert [row[0] for row in cleaned(spark, raw, pattern)] == [
        "PREPAID",
        "PREPAID",
        "REO",
        "NONE",
        "NONE",
        "NONE",
        "REO",
    ]


def test_every_zero_balance_code(spark):
    pattern = next(p for p in PERFORMANCE_PATTERNS if p.column == "ZERO_BALANCE_CODE")
    raw = ["01", "02", "03", "09", "15", "16", "96", "99", None]
    assert [row[0] for row in cleaned(spark, raw, pattern)] == [
        "PREPAID_OR_MATURED",
        "THIRD_PARTY_SALE",
        "SHORT_SALE_OR_CHARGE_OFF",
        "REO_DISPOSITION",
        "WHOLE_LOAN_SALE",
        "REPERFORMING_LOAN_SECURITIZATION",
        "DEFECT_PRIOR_TO_OTHER_EVENT",
        "NO_ZERO_BALANCE_CODE",
        "NO_ZERO_BALANCE_CODE",
    ]


def test_open_category(spark):
    pattern = OpenCategory("O", ("9",), "OCCUPANCY_UNKNOWN")
    assert cleaned(spark, ["p ", "9", " 9", "zz", None, ""], pattern) == [
        ("P", 0),
        ("OCCUPANCY_UNKNOWN", 1),
        ("9", 0),
        ("ZZ", 0),
        ("OCCUPANCY_UNKNOWN", 1),
        ("", 0),
    ]


def test_open_number(spark):
    pattern = OpenNumber("U", 99, "UNITS_UNKNOWN")
    raw = ["1", " 2.0", "99", "7", "1.5", "x", "NaN", None, "99.0"]
    assert [row[0] for row in cleaned(spark, raw, pattern)] == [
        "1",
        "2",
        "UNITS_UNKNOWN",
        "7",
        "1.5",
        *["UNITS_UNKNOWN"] * 4,
    ]


def test_date_dependent_ratio(spark):
    pattern = DateDependentRatio("LTV", 6, 105, "short", equals(999), date_column="D")
    old, new = date(2018, 1, 1), date(2018, 4, 1)
    raw = ["120", "120", "3", "999", "1500", "50", "120"]
    days = [old, new, old, new, new, old, None]
    # median of 120 120 3 1500 50 120
    assert cleaned(spark, raw, pattern, D=days) == [
        (105, 0),
        (120, 0),
        (6, 0),
        (120, 1),
        (998, 0),
        (50, 0),
        (120, 0),
    ]


def test_datetime_drops_or_imputes(spark):
    raw = ["202301", "bad", None, "202301", "202213", "202212"]
    jan, dec = date(2023, 1, 1), date(2022, 12, 1)
    assert cleaned(spark, raw, MonthColumn("M")) == [(jan, 0), (jan, 0), (dec, 0)]
    assert cleaned(spark, raw, MonthColumn("M", on_missing="mode")) == [
        (jan, 0),
        (jan, 1),
        (jan, 1),
        (jan, 0),
        (jan, 1),
        (dec, 0),
    ]


def test_optional_month(spark):
    pattern = OptionalMonthColumn("Z")
    assert cleaned(spark, ["202301", " ", None, "bad"], pattern) == [
        (date(2023, 1, 1), 0),
        (None, 1),
        (None, 1),
        (None, 0),
    ]


def test_free_text(spark):
    raw = [" acme ", "nan", "", None]
    assert cleaned(spark, raw, FreeTextCategory("S", "S_UNKNOWN")) == [
        ("ACME", 0),
        ("S_UNKNOWN", 1),
        ("S_UNKNOWN", 1),
        ("S_UNKNOWN", 1),
    ]
    kept = FreeTextCategory("S", "S_UNKNOWN", null_is_missing=False)
    assert cleaned(spark, raw, kept)[3] == (None, 0)


def test_cost(spark):
    raw = ["10.5", "0", "-4", None, "x"]
    assert cleaned(spark, raw, CostColumn("C", "HAS_C")) == [
        (10.5, 1),
        (0.0, 0),
        (0.0, 0),
        (0.0, 0),
        (0.0, 0),
    ]


def test_delinquency(spark):
    raw = ["3", "RA", "XX", "25", "-1", " 0", None, "3.7"]
    assert cleaned(spark, raw, DelinquencyStatus("D")) == [
        (3, 0, 0),
        (0, 1, 0),
        (0, 0, 1),
        (18, 0, 0),
        (0, 0, 0),
        (0, 0, 0),
        (0, 0, 1),
        (0, 0, 1),
    ]
    median = cleaned(spark, ["2", "4", "RA", None], DelinquencyStatus("D", impute="median"))
    assert median == [(2, 0, 0), (4, 0, 0), (3, 1, 0), (3, 0, 1)]


def test_metro(spark):
    raw = ["12345.0", " nan", "x1", None, "", "non_msa_or_unknown", "00012"]
    unknown = "NON_MSA_OR_UNKNOWN"
    assert cleaned(spark, raw, MetroColumn("M")) == [
        ("12345", 0),
        (unknown, 1),
        (unknown, 1),
        (unknown, 1),
        (unknown, 1),
        (unknown, 0),
        ("12", 0),
    ]
    bucket = MetroColumn("M", invalid="OTHER")
    assert cleaned(spark, ["x1", "", "nan", None, "7"], bucket) == [
        ("OTHER", 0),
        ("OTHER", 0),
        (unknown, 1),
        (unknown, 1),
        ("7", 0),
    ]


def test_postal(spark):
    raw = ["601.0", "600", "12345", "0", "99900", "100000", "-100", "unknown_postal_code", None]
    unknown = "UNKNOWN_POSTAL_CODE"
    assert cleaned(spark, raw, PostalColumn("P")) == [
        (unknown, 1),
        ("00600", 0),
        (unknown, 1),
        (unknown, 1),
        ("99900", 0),
        (unknown, 1),
        (unknown, 1),
        (unknown, 0),
        (unknown, 1),
    ]


def test_borrowers(spark):
    old, new = date(2018, 1, 1), date(2018, 4, 1)
    raw = ["2", "2", "99", "5", "1.0", "1_BORROWER", "nan", "11", "10"]
    days = [old, new, new, old, old, old, new, new, new]
    unknown = "UNKNOWN_NUM_BORROWERS"
    assert cleaned(spark, raw, BorrowerCount("B", date_column="D"), D=days) == [
        (">1_BORROWERS_OLD_RULE", 0),
        ("2", 0),
        (unknown, 1),
        (unknown, 1),
        ("1_BORROWER", 0),
        ("1_BORROWER", 0),
        (unknown, 1),
        (unknown, 1),
        ("10", 0),
    ]


def test_origination_date(spark):
    keys = ["F99Q4000", "F18Q1000", "F18Q1001", "F1XQ1000", "F18Q5000", "F18", "P05Q3"]
    df = spark.createDataFrame([(k,) for k in keys], "LOAN_SEQUENCE_NUMBER string")
    dates = {r[0]: r[1] for r in derive_origination_date(df).collect()}
    mode = date(2018, 1, 1)
    assert [dates[k] for k in keys] == [
        date(1999, 10, 1),
        mode,
        mode,
        mode,
        mode,
        mode,
        date(2005, 7, 1),
    ]
    nothing = spark.createDataFrame([("F1",)], "LOAN_SEQUENCE_NUMBER string")
    assert derive_origination_date(nothing).collect()[0][1] == date(2000, 1, 1)
    assert [r[0] for r in df.select(origination_quarter(F.col(df.columns[0]))).collect()][3] is None


@pytest.mark.parametrize("bad", ["", "2023", "2023-01", "20231", "202300", "abc123", " 202301x"])
def test_month_start_rejects(spark, bad):
    df = spark.createDataFrame([(bad,)], "m string")
    assert df.select(month_start(F.col("m"))).collect()[0][0] is None


def test_month_start_equals_the_date_formatter(spark):
    texts = [f"{n:06d}" for n in range(0, 1_000_000, 37)] + ["202301\n", "２０２３０１", "+20231"]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    ours, theirs = month_start(F.col("m")), F.try_to_date("m", "yyyyMM")
    assert df.where(~ours.eqNullSafe(theirs)).collect() == []


def test_metro_code_ignores_infinity(spark):
    df = spark.createDataFrame([("inf",), ("1e400",)], "m string")
    assert [r[0] for r in df.select(metro_code(F.col("m"), "U")).collect()] == [None, None]


def test_absent_columns_are_skipped_with_a_warning(spark):
    df = spark.createDataFrame([("1",)], "X string")
    with pytest.warns(UserWarning, match="Y not found"):
        assert clean_columns(df, [NumericColumn("Y", 0, 1, "int")]).columns == ["X"]


@pytest.mark.parametrize("pattern", [BorrowerCount("N"), DateDependentRatio("N", 6, 105, "short")])
def test_skipped_without_the_date_it_needs(spark, pattern):
    without = spark.createDataFrame([("2.0",)], "N string")
    as_text = spark.createDataFrame([("2.0", "2018-01-01")], "N string, ORIGINATION_DATE string")
    for df in (without, as_text):
        with pytest.warns(UserWarning, match="N not cleaned without"):
            same = clean_columns(df, [pattern])
        assert same.columns == df.columns
        assert same.collect() == df.collect()


def test_existing_indicator_is_kept(spark):
    df = spark.createDataFrame([("5", 1)], "X string, X_IS_MISSING int")
    row = clean_columns(df, [NumericColumn("X", 0, 9, "int")]).collect()[0]
    assert tuple(row) == (5, 1)


def test_fit_on_another_frame(spark):
    df = spark.createDataFrame([("1",), (None,)], "X string")
    other = spark.createDataFrame([("8",)], "X string")
    rows = clean_columns(df, [NumericColumn("X", 0, 9, "int")], fit_on=other).collect()
    assert sorted(r.X for r in rows) == [1, 8]


def test_cleaning_dates_and_status_twice_changes_nothing(spark):
    df = spark.createDataFrame(
        [("202301", "202301", " 3"), ("202302", " ", "RA")], "M string, Z string, D string"
    )
    patterns = [MonthColumn("M"), OptionalMonthColumn("Z"), DelinquencyStatus("D")]
    once = clean_columns(df, patterns)
    assert clean_columns(once, patterns).orderBy("M").collect() == once.orderBy("M").collect()
    periods = df.withColumnRenamed("M", "MONTHLY_REPORTING_PERIOD")
    once = clean_reporting_period(periods)
    assert clean_reporting_period(once).collect() == once.collect()


def loan_row(**values):
    return tuple(values.get(name) for name in ORIGINATION_SCHEMA.names)


def originations(spark, rows):
    return spark.createDataFrame([loan_row(**row) for row in rows], ORIGINATION_SCHEMA)


def test_loans_are_unique_and_deterministic(spark):
    rows = [
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000001", CREDIT_SCORE="700", CHANNEL="R"),
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000001", CREDIT_SCORE="650", CHANNEL="B"),
        dict(LOAN_SEQUENCE_NUMBER=None, CREDIT_SCORE="1"),
        dict(LOAN_SEQUENCE_NUMBER=" F18Q10000002", CREDIT_SCORE="2"),
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000002", CREDIT_SCORE="1"),
    ]
    for shuffled in (rows, rows[::-1]):
        kept = validate_loans(originations(spark, shuffled).repartition(4)).collect()
        assert {(r.LOAN_SEQUENCE_NUMBER, r.CREDIT_SCORE, r.CHANNEL) for r in kept} == {
            ("F18Q10000001", "650", "B"),
            (" F18Q10000002", "2", None),
            ("F18Q10000002", "1", None),
        }
    trimmed = validate_loans(originations(spark, rows), trim=True)
    assert {(r.LOAN_SEQUENCE_NUMBER, r.CREDIT_SCORE) for r in trimmed.collect()} == {
        ("F18Q10000001", "650"),
        ("F18Q10000002", "1"),
    }


def test_preferred_row_of_a_loan(spark):
    rows = [
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000001", CREDIT_SCORE=None, CHANNEL="R"),
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000001", CREDIT_SCORE="700", CHANNEL="B"),
    ]
    df = originations(spark, rows)
    assert [r.CREDIT_SCORE for r in validate_loans(df).collect()] == [None]
    assert [r.CREDIT_SCORE for r in validate_loans(df, prefer=["CHANNEL"]).collect()] == ["700"]


def test_fit_on_other_raw_tables(spark):
    month = "LOAN_SEQUENCE_NUMBER string, MONTHLY_REPORTING_PERIOD string, ELTV string"
    here = spark.createDataFrame([("F18Q10000001", "202301", "999")], month)
    there = spark.createDataFrame([("F18Q10000002", "202301", "50")], month)
    with pytest.warns(UserWarning):
        assert [r.ELTV for r in clean_performance(here, fit_on=there).collect()] == [50]
    dates = dict(FIRST_PAYMENT_DATE="201803", MATURITY_DATE="204803")
    one = originations(spark, [dict(LOAN_SEQUENCE_NUMBER="F18Q10000001", **dates)])
    two = originations(spark, [dict(LOAN_SEQUENCE_NUMBER="F18Q10000002", CREDIT_SCORE="610", **dates)])
    assert [r.CREDIT_SCORE for r in clean_originations(one, fit_on=two).collect()] == [610]


def test_term_median_is_fitted_after_undated_rows_are_gone(spark):
    dated = dict(FIRST_PAYMENT_DATE="201803", MATURITY_DATE="204803")
    rows = [
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000001", ORIGINAL_LOAN_TERM="360", **dated),
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000002", ORIGINAL_LOAN_TERM="0", **dated),
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000003", ORIGINAL_LOAN_TERM="120", CREDIT_SCORE="500"),
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000004", ORIGINAL_LOAN_TERM="120", CREDIT_SCORE="500"),
    ]
    result = clean_originations(originations(spark, rows)).collect()
    assert {r.LOAN_SEQUENCE_NUMBER[-1]: r.ORIGINAL_LOAN_TERM for r in result} == {
        "1": 360,
        "2": 360,
    }
    # the score's median still sees the undated rows
    assert {r.CREDIT_SCORE for r in result} == {500}
    assert len(result[0]) == 49


def test_pattern_lists_cover_each_column_once():
    for patterns, size in (
        (ORIGINATION_PATTERNS, 30),
        (EARLIER_ORIGINATION_PATTERNS, 30),
        (PERFORMANCE_PATTERNS, 17),
        (EARLIER_PERFORMANCE_PATTERNS, 10),
    ):
        assert len({p.column for p in patterns}) == len(patterns) == size


def test_earlier_rules_as_a_whole(spark):
    rows = [
        dict(LOAN_SEQUENCE_NUMBER=" F18Q10000001", FIRST_PAYMENT_DATE="201803", CHANNEL="r"),
        dict(LOAN_SEQUENCE_NUMBER="F18Q10000001", FIRST_PAYMENT_DATE="201804", CHANNEL="B"),
        dict(LOAN_SEQUENCE_NUMBER="F18Q20000002", ORIGINAL_DTI_RATIO="0", MSA_OR_MET_DIV="x"),
    ]
    result = clean_originations(
        originations(spark, rows), EARLIER_ORIGINATION_PATTERNS, trim_keys=True
    )
    loans = {r.LOAN_SEQUENCE_NUMBER: r for r in result.collect()}
    first, second = loans["F18Q10000001"], loans["F18Q20000002"]
    assert len(loans) == 2
    assert (first.CHANNEL, first.CHANNEL_IS_MISSING) == ("R", 0)
    assert second.FIRST_PAYMENT_DATE == date(2018, 3, 1)
    assert second.FIRST_PAYMENT_DATE_IS_MISSING == 1
    assert second.ORIGINAL_DTI_RATIO == 1
    assert second.MSA_OR_MET_DIV == "OTHER_INVALID_CODE"
    assert second.SELLER_NAME == "UNKNOWN_SELLER"
