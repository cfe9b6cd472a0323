"""Column expressions that turn raw text into values; bad text becomes null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Four digits of a year from 0001 on, then two of a month.
YEAR_AND_MONTH = r"\A(?!0000)[0-9]{4}(0[1-9]|1[0-2])\z"


def standard_text(value: Column) -> Column:
    return F.upper(F.trim(value.cast("string")))


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value.cast("string")) != "", value)


def tolerant_float(value: Column) -> Column:
    """Float, or null for malformed text and for the text 'NaN'."""
    return F.nanvl(value.try_cast("float"), F.lit(None).cast("float"))


def whole_number_text(value: Column) -> Column:
    """'12345.0' -> '12345'; null when the text is not a finite number."""
    number = value.cast("string").try_cast("double")
    return F.when(~F.isnan(number), number.try_cast("bigint")).cast("string")


def numeric_string(value: Column, missing_value: int = 99) -> Column:
    """Whole-number text of a numeric string, null for the sentinel."""
    number = value.cast("string").try_cast("double")
    return F.when(number != missing_value, whole_number_text(value))


def exact_code_text(value: Column) -> Column:
    """'1', '01' and '1.0' -> '1'; null when the number has a fraction."""
    number = value.cast("string").try_cast("double")
    return F.when(number == F.floor(number), whole_number_text(value))


def month_start(value: Column) -> Column:
    """yyyyMM text -> first day of that month.

    Same as ``try_to_date(value, 'yyyyMM')`` without the date formatter, whose
    cost showed: every performance row has three such columns.
    """
    text = value.cast("string")
    year, month = text.substr(1, 4).try_cast("int"), text.substr(5, 2).try_cast("int")
    return F.when(text.rlike(YEAR_AND_MONTH), F.make_date(year, month, F.lit(1)))


def metro_code(value: Column, unknown: str) -> Column:
    text = standard_text(value)
    return F.when(text == unknown, text).otherwise(whole_number_text(text))


def postal_code(value: Column, unknown: str) -> Column:
    """Five digits for multiples of 100 in 100..99900; the label passes."""
    text = standard_text(value)
    number = whole_number_text(text).cast("bigint")
    valid = number.between(100, 99900) & (number % 100 == 0)
    return F.when(text == unknown, text).when(
        valid, F.lpad(number.cast("string"), 5, "0")
    )


def origination_quarter(loan: Column) -> Column:
    """First day of the quarter coded in the loan key (product, YY, Q, 1-4)."""
    key = loan.cast("string")
    parts = key.substr(2, 2).rlike("^[0-9]{2}$") & key.substr(5, 1).rlike("^[1-4]$")
    yy = key.substr(2, 2).try_cast("int")
    year = F.when(yy == 99, 1999).otherwise(2000 + yy)
    month = key.substr(5, 1).try_cast("int") * 3 - 2
    return F.when(parts & (F.length(key) >= 5), F.make_date(year, month, F.lit(1)))


def month_index(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)
