"""The older rule set, as parameters of the same patterns."""

from loanpanel.operators.originations import (
    AMORTIZATION,
    MI_CANCEL,
    MI_CANCEL_INDICATORS,
    PROGRAMS,
    PROPERTY_TYPES,
    PURPOSES,
    STATES,
    VALUATIONS,
    YES,
    YES_NO,
    BorrowerCount,
    MetroColumn,
    PostalColumn,
)
from loanpanel.operators.patterns import (
    CategoryColumn,
    DateDependentRatio,
    DelinquencyStatus,
    FlagColumn,
    FreeTextCategory,
    MonthColumn,
    NumericColumn,
    OpenCategory,
    OpenNumber,
    below,
    equals,
)
from loanpanel.operators.performance import (
    DEFERRALS,
    MODIFICATIONS,
    NOT_DEFERRED,
    NOT_MODIFIED,
    STEP_MODIFICATIONS,
    STILL_OPEN,
)

# Labels by number; three differ from the current ones.
ZERO_BALANCE_NUMBERS = {
    "1": "PREPAID_OR_MATURED",
    "2": "THIRD_PARTY_SALE",
    "3": "SHORT_SALE_OR_CHARGE_OFF",
    "9": "REO_DISPOSITION",
    "15": "WHOLE_LOAN_SALES",
    "16": "REPERFORMING_LOAN_SECURITIZATIONS",
    "96": "DEFECT_PRIOR_TO_TERMINATION",
}


def _coded(column, mapping, unknown, **options):
    return CategoryColumn(
        column, mapping, unknown, missing_flag=True, keep_codes=True, **options
    )


CODED_CATEGORIES = (
    OpenNumber("NUMBER_OF_UNITS", 99, "UNITS_UNKNOWN"),
    OpenCategory("OCCUPANCY_STATUS", ("9",), "OCCUPANCY_UNKNOWN"),
    OpenCategory("CHANNEL", ("9",), "CHANNEL_UNKNOWN"),
    _coded("AMORTIZATION_TYPE", AMORTIZATION, "AMORTIZATION_TYPE_UNKNOWN"),
    _coded("PROPERTY_STATE", {s: s for s in STATES}, "STATE_OR_TERRITORY_UNKNOWN"),
    _coded("PROPERTY_TYPE", PROPERTY_TYPES, "PROPERTY_TYPE_UNKNOWN"),
    _coded("LOAN_PURPOSE", PURPOSES, "LOAN_PURPOSE_UNKNOWN"),
    _coded("PROGRAM_INDICATOR", PROGRAMS, "PROGRAM_INDICATOR_UNKNOWN"),
    _coded("PROP_VALUATION_METHOD", VALUATIONS, "PROP_VAL_METHOD_UNKNOWN"),
    _coded(
        "MI_CANCEL_INDICATOR",
        MI_CANCEL,
        "MI_CANCEL_INDICATOR_UNKNOWN",
        special_indicators=MI_CANCEL_INDICATORS,
    ),
)

EARLIER_ORIGINATION_PATTERNS = (
    NumericColumn("CREDIT_SCORE", 300, 850, "short", equals(9999)),
    FlagColumn("FIRST_TIME_HOMEBUYER_FLAG", YES_NO),
    MetroColumn("MSA_OR_MET_DIV", invalid="OTHER_INVALID_CODE"),
    NumericColumn("MI_PERCENT", 0, 55, "byte", equals(999)),
    NumericColumn("ORIGINAL_DTI_RATIO", 1, 65, "byte", equals(999)),
    NumericColumn("ORIGINAL_UPB", 1, 3_000_000, "int", equals(0)),
    NumericColumn("ORIGINAL_INTEREST_RATE", 0.5, 20.0, "float", equals(0)),
    DateDependentRatio("ORIGINAL_LTV", 6, 105, "short", equals(999)),
    DateDependentRatio("ORIGINAL_CLTV", 6, 200, "short", equals(999)),
    FlagColumn("PPM_FLAG", YES_NO, missing_flag=True),
    *CODED_CATEGORIES,
    PostalColumn("POSTAL_CODE", unknown="POSTAL_CODE_UNKNOWN"),
    NumericColumn("ORIGINAL_LOAN_TERM", 60, 480, "short", equals(0)),
    BorrowerCount("NUMBER_OF_BORROWERS", unknown="NUM_BORROWERS_UNKNOWN"),
    FlagColumn("SUPER_CONFORMING_FLAG", YES),
    FlagColumn("IO_INDICATOR", YES_NO),
    FlagColumn("RELIEF_REFI_INDICATOR", YES),
    MonthColumn("FIRST_PAYMENT_DATE", on_missing="mode"),
    MonthColumn("MATURITY_DATE", on_missing="mode"),
    FreeTextCategory("SELLER_NAME", "UNKNOWN_SELLER"),
    FreeTextCategory("SERVICER_NAME", "UNKNOWN_SERVICER"),
)

EARLIER_PERFORMANCE_PATTERNS = (
    NumericColumn("CURRENT_ACTUAL_UPB", 0, 3_000_000, "int"),
    DelinquencyStatus("CURRENT_DELINQUENCY_STATUS", impute="median"),
    NumericColumn("LOAN_AGE", 0, 600, "short", below(0)),
    MonthColumn("ZERO_BALANCE_EFFECT_DATE", on_missing="mode"),
    _coded("MOD_FLAG", MODIFICATIONS, NOT_MODIFIED),
    CategoryColumn(
        "ZERO_BALANCE_CODE",
        ZERO_BALANCE_NUMBERS,
        STILL_OPEN,
        missing_flag=True,
        numeric_codes=True,
    ),
    NumericColumn("CURRENT_INTEREST_RATE", 0.5, 20.0, "float", equals(0)),
    NumericColumn("CURRENT_NON_INTEREST_BEARING_UPB", 0, 3_000_000, "int"),
    _coded("STEP_MOD_FLAG", STEP_MODIFICATIONS, "NOT_MODIFIED_IN_PERIOD"),
    _coded("PAYMENT_DEFERRAL_FLAG", DEFERRALS, NOT_DEFERRED),
)
