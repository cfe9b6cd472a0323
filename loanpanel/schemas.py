"""Names of the two raw files' columns and the keys of the panel."""

from pyspark.sql.types import StringType, StructField, StructType

LOAN = "LOAN_SEQUENCE_NUMBER"
MONTH = "MONTHLY_REPORTING_PERIOD"
ORIGINATION_DATE = "ORIGINATION_DATE"

# Column order of the originations file.
ORIGINATION_COLUMNS = (
    "CREDIT_SCORE",
    "FIRST_PAYMENT_DATE",
    "FIRST_TIME_HOMEBUYER_FLAG",
    "MATURITY_DATE",
    "MSA_OR_MET_DIV",
    "MI_PERCENT",
    "NUMBER_OF_UNITS",
    "OCCUPANCY_STATUS",
    "ORIGINAL_CLTV",
    "ORIGINAL_DTI_RATIO",
    "ORIGINAL_UPB",
    "ORIGINAL_LTV",
    "ORIGINAL_INTEREST_RATE",
    "CHANNEL",
    "PPM_FLAG",
    "AMORTIZATION_TYPE",
    "PROPERTY_STATE",
    "PROPERTY_TYPE",
    "POSTAL_CODE",
    "LOAN_SEQUENCE_NUMBER",
    "LOAN_PURPOSE",
    "ORIGINAL_LOAN_TERM",
    "NUMBER_OF_BORROWERS",
    "SELLER_NAME",
    "SERVICER_NAME",
    "SUPER_CONFORMING_FLAG",
    "PRE_RELIEF_LOAN_NUMBER",
    "PROGRAM_INDICATOR",
    "RELIEF_REFI_INDICATOR",
    "PROP_VALUATION_METHOD",
    "IO_INDICATOR",
    "MI_CANCEL_INDICATOR",
)

# Column order of the monthly performance file.
PERFORMANCE_COLUMNS = (
    "LOAN_SEQUENCE_NUMBER",
    "MONTHLY_REPORTING_PERIOD",
    "CURRENT_ACTUAL_UPB",
    "CURRENT_DELINQUENCY_STATUS",
    "LOAN_AGE",
    "MONTHS_REMAINING_TO_LEGAL_MATURITY",
    "DEFECT_SETTLEMENT_DATE",
    "MOD_FLAG",
    "ZERO_BALANCE_CODE",
    "ZERO_BALANCE_EFFECT_DATE",
    "CURRENT_INTEREST_RATE",
    "CURRENT_NON_INTEREST_BEARING_UPB",
    "DDLPI",
    "MI_RECOVERIES",
    "NET_SALE_PROCEEDS",
    "NON_MI_RECOVERIES",
    "TOTAL_EXPENSES",
    "LEGAL_COSTS",
    "MAINTENANCE_AND_PRESERVE_COSTS",
    "TAXES_AND_INSURANCE",
    "MISC_EXPENSES",
    "ACTUAL_LOSS_CALC",
    "CUMULATIVE_MOD_COST",
    "INTEREST_RATE_STEP_INDICATOR",
    "PAYMENT_DEFERRAL_FLAG",
    "ELTV",
    "ZERO_BALANCE_REMOVAL_UPB",
    "DELINQUENT_ACCRUED_INTEREST",
    "DELINQUENCY_DUE_TO_DISASTER",
    "BORROWER_ASSISTANCE_STATUS_CODE",
    "CURRENT_MONTH_MOD_COST",
    "INTEREST_BEARING_UPB",
)

# Columns the cleaned tables do not carry.
UNUSED_ORIGINATION_COLUMNS = ("PRE_RELIEF_LOAN_NUMBER",)
UNUSED_PERFORMANCE_COLUMNS = (
    "MONTHS_REMAINING_TO_LEGAL_MATURITY",
    "DEFECT_SETTLEMENT_DATE",
    "MI_RECOVERIES",
    "NET_SALE_PROCEEDS",
    "NON_MI_RECOVERIES",
    "TOTAL_EXPENSES",
    "LEGAL_COSTS",
    "MAINTENANCE_AND_PRESERVE_COSTS",
    "TAXES_AND_INSURANCE",
    "MISC_EXPENSES",
    "ACTUAL_LOSS_CALC",
    "ZERO_BALANCE_REMOVAL_UPB",
    "INTEREST_BEARING_UPB",
)

# Names under which the same performance columns also circulate.
PERFORMANCE_ALIASES = {
    "INTEREST_RATE_STEP_INDICATOR": "STEP_MOD_FLAG",
    "MONTHS_REMAINING": "MONTHS_REMAINING_TO_LEGAL_MATURITY",
    "MODIFICATION_FLAG": "MOD_FLAG",
    "CURRENT_NON_INTEREST_UPB": "CURRENT_NON_INTEREST_BEARING_UPB",
    "MAINTENANCE_PRESERVE_COSTS": "MAINTENANCE_AND_PRESERVE_COSTS",
    "PAYMENT_DEFERRAL": "PAYMENT_DEFERRAL_FLAG",
    "BORR_ASSIST_STATUS_CODE": "BORROWER_ASSISTANCE_STATUS_CODE",
}


def text_schema(columns) -> StructType:
    """Every raw field is a nullable string; cleaning imposes the types."""
    return StructType([StructField(name, StringType(), True) for name in columns])


ORIGINATION_SCHEMA = text_schema(ORIGINATION_COLUMNS)
PERFORMANCE_SCHEMA = text_schema(PERFORMANCE_COLUMNS)
