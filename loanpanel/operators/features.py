"""The 64 features of a loan's observed months, in one aggregation.

"First" and "last" are by reporting month. The values of a loan's first and
last row are taken as one struct each instead of one aggregate per column.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanpanel.functions.codes import named
from loanpanel.operators.labels import payment_gap
from loanpanel.operators.performance import NOT_DEFERRED, NOT_MODIFIED, STILL_OPEN
from loanpanel.schemas import LOAN, MONTH

# Months late that stand for a repossession, and the loan-to-value
# ratio above which a property is worth less than the loan.
REPOSSESSED_STATUS = 18
UNDERWATER_RATIO = 100

FIRST_ROW = {
    "INITIAL_ACTUAL_UPB": "CURRENT_ACTUAL_UPB",
    "INITIAL_LOAN_AGE": "LOAN_AGE",
    "INITIAL_INTEREST_RATE": "CURRENT_INTEREST_RATE",
    "INITIAL_ELTV": "ELTV",
    "INITIAL_ELTV_IS_MISSING": "ELTV_IS_MISSING",
}
LAST_ROW = {
    "LAST_ACTUAL_UPB": "CURRENT_ACTUAL_UPB",
    "TERMINAL_DELINQ_STATUS": "STATUS",
    "FINAL_LOAN_AGE": "LOAN_AGE",
    "PRE_DEFAULT_ZBC": "ZERO_BALANCE_CODE",
    "LAST_INTEREST_RATE": "CURRENT_INTEREST_RATE",
    "LAST_NIB_UPB": "CURRENT_NON_INTEREST_BEARING_UPB",
    "LAST_ELTV_IS_MISSING": "ELTV_IS_MISSING",
    "PRE_DEFAULT_CURRENTLY_DISASTER_AFFECTED": "DELINQUENCY_DUE_TO_DISASTER",
    "LAST_ASSISTANCE_STATUS": "BORROWER_ASSISTANCE_STATUS_CODE",
    "LAST_MONTHLY_MOD_COST": "CURRENT_MONTH_MOD_COST",
}
LARGEST = {
    "LAST_MONTHLY_REPORTING_PERIOD": MONTH,
    "MAX_ACTUAL_UPB": "CURRENT_ACTUAL_UPB",
    "MAX_DELINQUENCY_STATUS": "STATUS",
    "EVER_RA": "CURRENT_DELINQUENCY_STATUS_IS_RA",
    "DELINQUENCY_STATUS_EVER_MISSING": "CURRENT_DELINQUENCY_STATUS_IS_MISSING",
    "MAX_LOAN_AGE": "LOAN_AGE",
    "LOAN_AGE_EVER_MISSING": "LOAN_AGE_IS_MISSING",
    "MAX_INTEREST_RATE": "CURRENT_INTEREST_RATE",
    "INTEREST_RATE_EVER_MISSING": "CURRENT_INTEREST_RATE_IS_MISSING",
    "MAX_NIB_UPB": "CURRENT_NON_INTEREST_BEARING_UPB",
    "MAX_PAYMENT_GAP_MONTHS": "PAYMENT_GAP",
    "MAX_CUMULATIVE_MOD_COST": "CUMULATIVE_MOD_COST",
    "EVER_HAD_MOD_COST": "CUMULATIVE_MOD_COST_IS_MODIFIED",
    "MAX_ELTV": "ELTV",
    "ELTV_EVER_MISSING": "ELTV_IS_MISSING",
    "PRE_DEFAULT_MAX_ACCRUED_INTEREST": "DELINQUENT_ACCRUED_INTEREST",
    "PRE_DEFAULT_EVER_HAD_LOSS_SIGNS": "HAS_DELINQUENT_INTEREST",
    "PRE_DEFAULT_EVER_DISASTER_AFFECTED": "DELINQUENCY_DUE_TO_DISASTER",
    "IS_PRE_2014_VINTAGE_REPORTING": "DISASTER_FLAG_MISSING",
    "MAX_MONTHLY_MOD_COST": "CURRENT_MONTH_MOD_COST",
    "EVER_MONTHLY_MODIFIED": "CURRENT_MONTH_IS_MODIFIED",
}
SMALLEST = {
    "FIRST_MONTHLY_REPORTING_PERIOD": MONTH,
    "MIN_LOAN_AGE": "LOAN_AGE",
    "MIN_INTEREST_RATE": "CURRENT_INTEREST_RATE",
    "MIN_ELTV": "ELTV",
}
DEVIATION = {
    "DELINQUENCY_STATUS_STDDEV": "STATUS",
    "INTEREST_RATE_STDDEV": "CURRENT_INTEREST_RATE",
}
LATEST_KNOWN = {
    "LAST_ZBE_DATE": "ZERO_BALANCE_EFFECT_DATE",
    "FINAL_DDLPI_DATE": "DDLPI",
    "FINAL_PAYMENT_GAP_MONTHS": "PAYMENT_GAP",
    "LAST_ELTV": "ELTV",
}


# 1 if any month meets the condition.
EVER = {
    "EVER_MODIFIED": f"MOD_FLAG != '{NOT_MODIFIED}'",
    "EVER_HAD_NIB_UPB": "CURRENT_NON_INTEREST_BEARING_UPB > 0",
    "EVER_STEP_MOD": "STEP_MOD_FLAG = 'STEP_MOD'",
    "EVER_FIXED_MOD": "STEP_MOD_FLAG = 'NON_STEP_MOD'",
    "EVER_PAYMENT_DEFERRAL": f"PAYMENT_DEFERRAL_FLAG != '{NOT_DEFERRED}'",
    "EVER_UNDERWATER": f"ELTV > {UNDERWATER_RATIO}",
    "EVER_FORBEARANCE": "BORROWER_ASSISTANCE_STATUS_CODE = 'FORBEARANCE'",
    "EVER_REPAYMENT": "BORROWER_ASSISTANCE_STATUS_CODE = 'REPAYMENT'",
    "EVER_TRIAL_PERIOD": "BORROWER_ASSISTANCE_STATUS_CODE = 'TRIAL_PERIOD'",
}
# Number of months that meet the condition.
MONTHS_WITH = {
    "NUMBER_OF_LATE_MONTHS": "STATUS > 0",
    "NUMBER_OF_MODIFICATIONS": "MOD_FLAG = 'CURRENT_PERIOD_MOD'",
    "DEFERRAL_EVENT_COUNT": "PAYMENT_DEFERRAL_FLAG = 'CURRENT_PERIOD'",
}
# 1 if the column has the value in the loan's last observed month.
LAST_ROW_IS = {
    "IS_ACTIVE_AT_SNAPSHOT": ("ZERO_BALANCE_CODE", STILL_OPEN),
    "IS_CURRENTLY_STEP_MOD": ("STEP_MOD_FLAG", "STEP_MOD"),
    "IS_RECENTLY_DEFERRED": ("PAYMENT_DEFERRAL_FLAG", "CURRENT_PERIOD"),
}


def with_feature_inputs(history: DataFrame) -> DataFrame:
    """Add the two derived inputs several features share."""
    repossessed = F.col("CURRENT_DELINQUENCY_STATUS_IS_RA") == 1
    status = F.col("CURRENT_DELINQUENCY_STATUS").cast("int")
    return history.withColumns(
        {
            "STATUS": F.when(repossessed, F.lit(REPOSSESSED_STATUS)).otherwise(status),
            "PAYMENT_GAP": payment_gap(),
        }
    )


def feature_aggregates(observed: Column | None = None) -> dict[str, Column]:
    """Per-loan aggregates behind the features, over rows where ``observed``."""

    def seen(value: Column, also: Column | None = None) -> Column:
        for condition in (observed, also):
            if condition is not None:
                value = F.when(condition, value)
        return value

    month, upb = F.col(MONTH), F.col("CURRENT_ACTUAL_UPB")
    first_fields = sorted(set(FIRST_ROW.values()))
    last_fields = sorted({*LAST_ROW.values(), *[field for field, _ in LAST_ROW_IS.values()]})
    aggregates = {
        "PERFORMANCE_MONTHS_OBSERVED": F.count(seen(month)),
        "first_row": F.min_by(F.struct(*first_fields), seen(month)),
        "last_row": F.max_by(F.struct(*last_fields), seen(month)),
        "FINAL_NON_ZERO_UPB": F.max_by(upb, seen(month, upb > 0)),
        "AVG_MONTHLY_MOD_COST": F.avg(seen(F.col("CURRENT_MONTH_MOD_COST"))),
    }
    for name, source in LARGEST.items():
        aggregates[name] = F.max(seen(F.col(source)))
    for name, source in SMALLEST.items():
        aggregates[name] = F.min(seen(F.col(source)))
    for name, source in DEVIATION.items():
        aggregates[name] = F.coalesce(F.stddev(seen(F.col(source))), F.lit(0.0))
    for name, source in LATEST_KNOWN.items():
        aggregates[name] = F.max_by(source, seen(month, F.col(source).isNotNull()))
    for name, condition in EVER.items():
        aggregates[name] = F.max(seen(F.expr(f"IF({condition}, 1, 0)")))
    for name, condition in MONTHS_WITH.items():
        aggregates[name] = F.sum(seen(F.expr(f"IF({condition}, 1, 0)")))
    return aggregates


# Features that are aggregates as they stand; the rest come from two rows.
DIRECT = (
    "PERFORMANCE_MONTHS_OBSERVED",
    "FINAL_NON_ZERO_UPB",
    "AVG_MONTHLY_MOD_COST",
    *LARGEST,
    *SMALLEST,
    *DEVIATION,
    *LATEST_KNOWN,
    *EVER,
    *MONTHS_WITH,
)


def feature_columns() -> dict[str, Column]:
    """The 64 features from ``feature_aggregates``, by name."""
    first_row, last_row = F.col("first_row"), F.col("last_row")
    return {
        **{name: F.col(name) for name in DIRECT},
        **{name: first_row[field] for name, field in FIRST_ROW.items()},
        **{name: last_row[field] for name, field in LAST_ROW.items()},
        **{
            name: F.when(last_row[field] == value, 1).otherwise(0)
            for name, (field, value) in LAST_ROW_IS.items()
        },
    }


def loan_features(observed_rows: DataFrame) -> DataFrame:
    """One row of features per loan from rows that may feed features."""
    totals = with_feature_inputs(observed_rows).groupBy(LOAN).agg(*named(feature_aggregates()))
    return totals.select(LOAN, *named(feature_columns()))
