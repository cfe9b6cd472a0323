"""Cleaning of the monthly performance table."""

import warnings
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from loanpanel.functions.parsing import month_start
from loanpanel.operators.keys import with_loan_key
from loanpanel.operators.patterns import (
    CategoryColumn,
    CostColumn,
    DelinquencyStatus,
    EraFlagColumn,
    NumericColumn,
    OptionalMonthColumn,
    Pattern,
    clean_columns,
    equals,
)
from loanpanel.schemas import MONTH, UNUSED_PERFORMANCE_COLUMNS
from loanpanel.sources.delimited import canonical_performance_names

# Codes, labels, sentinels and bounds of the performance columns.
NOT_MODIFIED = "NOT_MODIFIED"
STILL_OPEN = "NO_ZERO_BALANCE_CODE"
NO_STEP_MOD = "LOAN_NOT_MODIFIED"
NOT_DEFERRED = "NOT_PAYMENT_DEFERRAL"
NOT_ASSISTED = "NO_BORR_ASSIST_CODE"
MODIFICATIONS = {"Y": "CURRENT_PERIOD_MOD", "P": "PRIOR_PERIOD_MOD"}
ZERO_BALANCE_CODES = {
    "01": "PREPAID_OR_MATURED",
    "02": "THIRD_PARTY_SALE",
    "03": "SHORT_SALE_OR_CHARGE_OFF",
    "09": "REO_DISPOSITION",
    "15": "WHOLE_LOAN_SALE",
    "16": "REPERFORMING_LOAN_SECURITIZATION",
    "96": "DEFECT_PRIOR_TO_OTHER_EVENT",
}
STEP_MODIFICATIONS = {"Y": "STEP_MOD", "N": "NON_STEP_MOD"}
DEFERRALS = {"Y": "CURRENT_PERIOD", "P": "PRIOR_PERIOD"}
ASSISTANCE = {"F": "FORBEARANCE", "R": "REPAYMENT", "T": "TRIAL_PERIOD"}

PERFORMANCE_PATTERNS = (
    NumericColumn("CURRENT_ACTUAL_UPB", 0, 3_000_000, "int"),
    NumericColumn("LOAN_AGE", 0, 600, "short"),
    NumericColumn("CURRENT_INTEREST_RATE", 0.5, 20.0, "float", equals(0)),
    NumericColumn("CURRENT_NON_INTEREST_BEARING_UPB", 0, 3_000_000, "int"),
    NumericColumn("ELTV", 1, 200, "short", equals(999)),
    EraFlagColumn("DELINQUENCY_DUE_TO_DISASTER", {"Y": 1}),
    CategoryColumn("MOD_FLAG", MODIFICATIONS, NOT_MODIFIED),
    CategoryColumn("ZERO_BALANCE_CODE", ZERO_BALANCE_CODES, STILL_OPEN),
    CategoryColumn("STEP_MOD_FLAG", STEP_MODIFICATIONS, NO_STEP_MOD),
    CategoryColumn("PAYMENT_DEFERRAL_FLAG", DEFERRALS, NOT_DEFERRED),
    CategoryColumn("BORROWER_ASSISTANCE_STATUS_CODE", ASSISTANCE, NOT_ASSISTED),
    CostColumn("CUMULATIVE_MOD_COST", "CUMULATIVE_MOD_COST_IS_MODIFIED"),
    CostColumn("DELINQUENT_ACCRUED_INTEREST", "HAS_DELINQUENT_INTEREST"),
    CostColumn("CURRENT_MONTH_MOD_COST", "CURRENT_MONTH_IS_MODIFIED"),
    OptionalMonthColumn("ZERO_BALANCE_EFFECT_DATE"),
    DelinquencyStatus("CURRENT_DELINQUENCY_STATUS"),
    OptionalMonthColumn("DDLPI", standardize=True),
)

# Months the earlier rules look at, both included.
REPORTING_WINDOW = (date(2023, 1, 1), date(2024, 4, 1))


def drop_unused_performance(df: DataFrame) -> DataFrame:
    return df.drop(*UNUSED_PERFORMANCE_COLUMNS)


def clean_reporting_period(df: DataFrame) -> DataFrame:
    """Reporting month as a date; rows without one are dropped."""
    if MONTH not in df.columns:
        warnings.warn(f"{MONTH} not found, not cleaned", stacklevel=2)
        return df
    if isinstance(df.schema[MONTH].dataType, DateType):
        return df
    parsed = month_start(F.trim(F.col(MONTH).cast("string")))
    return df.where(parsed.isNotNull()).withColumn(MONTH, parsed)


def filter_reporting_window(
    df: DataFrame, first: date = REPORTING_WINDOW[0], last: date = REPORTING_WINDOW[1]
) -> DataFrame:
    """Add REPORTING_DATE and keep the months from ``first`` to ``last``."""
    parsed = month_start(F.col(MONTH))
    return df.where(parsed.between(F.lit(first), F.lit(last))).withColumn(
        "REPORTING_DATE", parsed
    )


def clean_performance(
    raw: DataFrame,
    patterns: Sequence[Pattern] = PERFORMANCE_PATTERNS,
    trim_keys: bool = False,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Raw monthly rows to typed monthly rows (still with any duplicates).

    ``fit_on`` is another raw table on which medians are fitted instead.
    """

    def readable(table: DataFrame) -> DataFrame:
        named = drop_unused_performance(canonical_performance_names(table))
        return clean_reporting_period(with_loan_key(named, trim_keys))

    return clean_columns(
        readable(raw), patterns, fit_on=None if fit_on is None else readable(fit_on)
    )
