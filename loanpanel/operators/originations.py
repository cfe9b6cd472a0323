"""Cleaning of the originations table."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType

from loanpanel.functions.codes import indicator, map_codes
from loanpanel.functions.parsing import (
    metro_code,
    numeric_string,
    origination_quarter,
    postal_code,
    standard_text,
)
from loanpanel.operators.keys import one_row_per_key, with_loan_key
from loanpanel.operators.patterns import (
    RULE_CHANGE,
    CategoryColumn,
    Cleaned,
    DateDependentRatio,
    FlagColumn,
    FreeTextCategory,
    MonthColumn,
    NumericColumn,
    Pattern,
    at_most,
    clean_columns,
    equals,
)
from loanpanel.schemas import LOAN, ORIGINATION_DATE, UNUSED_ORIGINATION_COLUMNS

# Fixed value: origination date when no key in the data gives one.
FALLBACK_DATE = date(2000, 1, 1)


@dataclass(frozen=True)
class MetroColumn(Pattern):
    """Metropolitan area code as digits.

    With ``invalid`` set, text that is no number gets that label instead of
    counting as missing.
    """

    unknown: str = "NON_MSA_OR_UNKNOWN"
    invalid: str | None = None

    def clean(self, fitted: None) -> Cleaned:
        text = standard_text(F.col(self.column))
        code = metro_code(text, self.unknown)
        if self.invalid is not None:
            no_code = text.isNull() | (text == "NAN")
            code = F.when(~no_code, F.coalesce(code, F.lit(self.invalid)))
        return Cleaned(
            F.coalesce(code, F.lit(self.unknown)),
            {self.missing_name: indicator(code.isNull())},
        )


@dataclass(frozen=True)
class PostalColumn(Pattern):
    """Postal code prefix as five digits."""

    unknown: str = "UNKNOWN_POSTAL_CODE"

    def clean(self, fitted: None) -> Cleaned:
        code = postal_code(F.col(self.column), self.unknown)
        return Cleaned(
            F.coalesce(code, F.lit(self.unknown)),
            {self.missing_name: indicator(code.isNull())},
        )


@dataclass(frozen=True)
class BorrowerCount(Pattern):
    """Number of borrowers, whose codes changed with the disclosure rules."""

    unknown: str = "UNKNOWN_NUM_BORROWERS"
    date_column: str = ORIGINATION_DATE

    def needs(self) -> Mapping[str, type[DataType]]:
        return {self.date_column: DateType}

    def clean(self, fitted: None) -> Cleaned:
        raw = F.col(self.column)
        code = F.coalesce(numeric_string(raw), standard_text(raw))
        day = F.col(self.date_column)
        label = F.when(day <= F.lit(RULE_CHANGE), map_codes(code, BORROWERS_BEFORE)).when(
            day > F.lit(RULE_CHANGE), map_codes(code, BORROWERS_AFTER)
        )
        return Cleaned(
            F.coalesce(label, F.lit(self.unknown)),
            {self.missing_name: indicator(label.isNull())},
        )


# Codes, labels, sentinels and bounds of the originations columns.
YES_NO = {"Y": 1, "N": 0}
YES = {"Y": 1}
UNITS = {"1": "1", "2": "2", "3": "3", "4": "4"}
OCCUPANCY = {"P": "PRIMARY_RESIDENCE", "I": "INVESTMENT_PROPERTY", "S": "SECONDARY_HOME"}
CHANNELS = {"R": "RETAIL", "B": "BROKER", "C": "CORRESPONDENT", "T": "TPO_NOT_SPECIFIED"}
AMORTIZATION = {"FRM": "FIXED_RATE", "ARM": "ADJUSTABLE_RATE"}
# fmt: off
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "HI", "ID", "IL", "IN", "IA",
    "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM",
    "NY", "NC", "ND", "OH", "OK", "OR", "PA", "PR", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA",
    "VI", "WA", "WV", "WI", "WY", "AS", "FM", "GU", "MH", "MP", "PW",
)
# fmt: on
PROPERTY_TYPES = {
    "CO": "CONDO",
    "PU": "PUD",
    "MH": "MANUFACTURED_HOUSING",
    "SF": "SINGLE_FAMILY",
    "CP": "CO-OP",
}
PURPOSES = {
    "P": "PURCHASE",
    "C": "REFINANCE_CASH_OUT",
    "N": "REFINANCE_NO_CASH_OUT",
    "R": "REFINANCE_NOT_SPECIFIED",
}
PROGRAMS = {"H": "HOME_POSSIBLE", "F": "HFA_ADVANTAGE", "R": "REFI_POSSIBLE"}
VALUATIONS = {"1": "ACE_LOANS", "2": "FULL_APPRAISAL", "3": "OTHER_APPRAISALS", "4": "ACE_PDR"}
MI_CANCEL = {"Y": "CANCELLED", "N": "NOT_CANCELLED", "7": "NOT_APPLICABLE", "9": "NOT_DISCLOSED"}
MI_CANCEL_INDICATORS = {"NOT_APPLICABLE": "7", "NOT_DISCLOSED": "9"}
BORROWERS_BEFORE = {"1": "1_BORROWER", "2": ">1_BORROWERS_OLD_RULE"}
BORROWERS_AFTER = {str(number): str(number) for number in range(1, 11)}

ORIGINATION_PATTERNS = (
    NumericColumn("CREDIT_SCORE", 300, 850, "short", equals(9999)),
    NumericColumn("MI_PERCENT", 0, 55, "byte", equals(999)),
    NumericColumn("ORIGINAL_DTI_RATIO", 0, 65, "byte", equals(999)),
    NumericColumn("ORIGINAL_UPB", 0, 3_000_000, "int", equals(0)),
    NumericColumn("ORIGINAL_INTEREST_RATE", 0.5, 20.0, "float", equals(0)),
    FlagColumn("FIRST_TIME_HOMEBUYER_FLAG", YES_NO),
    FlagColumn("PPM_FLAG", YES_NO),
    FlagColumn("SUPER_CONFORMING_FLAG", YES),
    FlagColumn("IO_INDICATOR", YES_NO),
    FlagColumn("RELIEF_REFI_INDICATOR", YES),
    CategoryColumn("NUMBER_OF_UNITS", UNITS, "NUM_UNITS_UNKNOWN"),
    CategoryColumn("OCCUPANCY_STATUS", OCCUPANCY, "OCCUPANCY_STATUS_UNKNOWN"),
    CategoryColumn("CHANNEL", CHANNELS, "CHANNEL_UNKNOWN"),
    CategoryColumn("AMORTIZATION_TYPE", AMORTIZATION, "AMORTIZATION_TYPE_UNKNOWN"),
    CategoryColumn("PROPERTY_STATE", {s: s for s in STATES}, "PROPERTY_STATE_UNKNOWN"),
    CategoryColumn("PROPERTY_TYPE", PROPERTY_TYPES, "PROPERTY_TYPE_UNKNOWN"),
    CategoryColumn("LOAN_PURPOSE", PURPOSES, "LOAN_PURPOSE_UNKNOWN"),
    CategoryColumn("PROGRAM_INDICATOR", PROGRAMS, "PROGRAM_INDICATOR_UNKNOWN"),
    CategoryColumn("PROP_VALUATION_METHOD", VALUATIONS, "PROP_VALUATION_METHOD_UNKNOWN"),
    CategoryColumn(
        "MI_CANCEL_INDICATOR", MI_CANCEL, "MI_CANCEL_INDICATOR_UNKNOWN", MI_CANCEL_INDICATORS
    ),
    DateDependentRatio("ORIGINAL_LTV", 6, 105, "short", equals(999)),
    DateDependentRatio("ORIGINAL_CLTV", 6, 200, "short", equals(999)),
    MonthColumn("FIRST_PAYMENT_DATE"),
    MonthColumn("MATURITY_DATE"),
    FreeTextCategory("SELLER_NAME", "SELLER_NAME_UNKNOWN"),
    FreeTextCategory("SERVICER_NAME", "SERVICER_NAME_UNKNOWN"),
    MetroColumn("MSA_OR_MET_DIV"),
    PostalColumn("POSTAL_CODE"),
    NumericColumn("ORIGINAL_LOAN_TERM", 60, 480, "int", at_most(0)),
    BorrowerCount("NUMBER_OF_BORROWERS"),
)


def drop_unused_originations(df: DataFrame) -> DataFrame:
    return df.drop(*UNUSED_ORIGINATION_COLUMNS)


def validate_loans(
    df: DataFrame, trim: bool = False, prefer: Sequence[str] = ()
) -> DataFrame:
    """Drop rows without a key and all but the smallest row of each key.

    Smallest by the columns in ``prefer`` first (a file or line number makes it the
    first row that came), then by all columns, nulls before values.
    """
    return one_row_per_key(with_loan_key(df, trim), [LOAN], prefer)


def derive_origination_date(df: DataFrame) -> DataFrame:
    """Add the origination quarter coded in the key; mode date if unreadable.

    Two year digits and four quarters: the mode counts at most 400 values. Counting
    another column beside it makes the subquery need whole rows, so that it shares the
    deduplicated table with everything else instead of reading the keys once more.
    """
    quarter = origination_quarter(F.col(LOAN))
    others = [F.count(name).alias("others") for name in df.columns if name != LOAN][:1]
    found = df.agg(F.mode(quarter, True).alias("mode"), *others)
    mode = found.select(F.struct("*")).scalar().getField("mode")
    return df.withColumn(ORIGINATION_DATE, F.coalesce(quarter, mode, F.lit(FALLBACK_DATE)))


def clean_originations(
    raw: DataFrame,
    patterns: Sequence[Pattern] = ORIGINATION_PATTERNS,
    trim_keys: bool = False,
    prefer: Sequence[str] = (),
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Raw originations to one typed row per loan.

    ``prefer`` orders the rows of one key; ``fit_on`` is another raw table on which
    medians and modes are fitted instead.
    """

    def validated(table: DataFrame) -> DataFrame:
        return validate_loans(drop_unused_originations(table), trim_keys, prefer)

    loans = validated(raw)
    fitted = loans if fit_on is None else validated(fit_on)
    return clean_columns(derive_origination_date(loans), patterns, fit_on=fitted)
