"""The reusable column-cleaning patterns.

A pattern describes how one raw text column becomes a typed column plus its
indicators. ``clean_columns`` applies any number of patterns as one projection:
statistics that imputation needs (medians, modes) are fitted for all columns
together and attached as a scalar subquery, so nothing runs before the caller's
action.
"""

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType

from loanpanel.functions.codes import clip, indicator, lookup, map_codes
from loanpanel.functions.parsing import (
    blank_to_null,
    exact_code_text,
    month_start,
    standard_text,
    tolerant_float,
)
from loanpanel.operators.medians import exact_medians
from loanpanel.schemas import MONTH, ORIGINATION_DATE

# Fixed value: disclosure rules changed after this day.
RULE_CHANGE = date(2018, 3, 31)


def equals(sentinel: float) -> Callable[[Column], Column]:
    return lambda value: value == sentinel


def at_most(limit: float) -> Callable[[Column], Column]:
    return lambda value: value <= limit


def below(limit: float) -> Callable[[Column], Column]:
    return lambda value: value < limit


@dataclass(frozen=True)
class Cleaned:
    """What a pattern makes of its column."""

    value: Column
    extra: Mapping[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Pattern:
    column: str

    @property
    def missing_name(self) -> str:
        return f"{self.column}_IS_MISSING"

    def needs(self) -> Mapping[str, type[DataType]]:
        """Other columns, and their types, without which the column is left as it is."""
        return {}

    def is_clean(self, dtype: DataType) -> bool:
        """Already in its final type, so that cleaning again changes nothing."""
        return False

    def median_source(self) -> Column | None:
        return None

    def mode_source(self) -> Column | None:
        return None

    def keep_row(self) -> Column | None:
        """Rows that survive; None keeps all."""
        return None

    def clean(self, fitted: Column | None) -> Cleaned:
        raise NotImplementedError


@dataclass(frozen=True)
class NumericColumn(Pattern):
    """Number -> sentinel to null -> missing flag -> median -> clip -> cast."""

    low: float
    high: float
    dtype: str
    is_missing: Callable[[Column], Column] | None = None

    def observed(self) -> Column:
        number = tolerant_float(F.col(self.column))
        if self.is_missing is None:
            return number
        return F.when(~self.is_missing(number), number)

    def median_source(self) -> Column:
        return self.observed()

    def bounded(self, value: Column) -> Column:
        return clip(value, self.low, self.high)

    def clean(self, fitted: Column) -> Cleaned:
        observed = self.observed()
        filled = F.coalesce(observed, fitted.cast("float"))
        return Cleaned(
            self.bounded(filled).cast(self.dtype),
            {self.missing_name: indicator(observed.isNull())},
        )


@dataclass(frozen=True)
class DateDependentRatio(NumericColumn):
    """Numeric pattern whose upper era (after the rule change) has own bounds."""

    later_low: float = 1
    later_high: float = 998
    date_column: str = ORIGINATION_DATE

    def needs(self) -> Mapping[str, type[DataType]]:
        return {self.date_column: DateType}

    def bounded(self, value: Column) -> Column:
        day = F.col(self.date_column)
        return (
            F.when(day <= F.lit(RULE_CHANGE), clip(value, self.low, self.high))
            .when(day > F.lit(RULE_CHANGE), clip(value, self.later_low, self.later_high))
            .otherwise(value)
        )


@dataclass(frozen=True)
class FlagColumn(Pattern):
    """Text codes (or their 0/1 images) -> 0/1, anything else 0."""

    mapping: Mapping[str, int]
    missing_flag: bool = False

    def clean(self, fitted: None) -> Cleaned:
        images = {str(value): value for value in self.mapping.values()}
        found = lookup(standard_text(F.col(self.column)), images | dict(self.mapping))
        extra = {self.missing_name: indicator(found.isNull())} if self.missing_flag else {}
        return Cleaned(F.coalesce(found, F.lit(0)).cast("byte"), extra)


@dataclass(frozen=True)
class EraFlagColumn(FlagColumn):
    """Flag that was not reported before a given month; says so in a column."""

    first_reported: date = date(2014, 1, 1)
    era_flag: str = "DISASTER_FLAG_MISSING"
    month_column: str = MONTH

    def clean(self, fitted: None) -> Cleaned:
        cleaned = super().clean(fitted)
        too_early = F.col(self.month_column) < F.lit(self.first_reported)
        return Cleaned(cleaned.value, {**cleaned.extra, self.era_flag: indicator(too_early)})


@dataclass(frozen=True)
class CategoryColumn(Pattern):
    """Code or label -> label, anything else -> ``unknown``.

    ``keep_codes`` leaves the codes as they are, ``numeric_codes`` matches them
    by number ('1' = '01' = '1.0'), ``missing_flag`` adds ``_IS_MISSING``.
    """

    mapping: Mapping[str, str]
    unknown: str
    special_indicators: Mapping[str, str] = field(default_factory=dict)
    missing_flag: bool = False
    keep_codes: bool = False
    numeric_codes: bool = False

    def clean(self, fitted: None) -> Cleaned:
        text = standard_text(F.col(self.column))
        mapping = {code: code for code in self.mapping} if self.keep_codes else self.mapping
        if self.numeric_codes:
            by_number = {str(int(code)): label for code, label in mapping.items()}
            found = map_codes(F.coalesce(exact_code_text(text), text), by_number)
        else:
            found = map_codes(text, mapping)
        extra = {
            f"{self.column}_{suffix}": indicator(text == code)
            for suffix, code in self.special_indicators.items()
        }
        if self.missing_flag:
            extra[self.missing_name] = indicator(found.isNull())
        return Cleaned(F.coalesce(found, F.lit(self.unknown)), extra)


@dataclass(frozen=True)
class OpenCategory(Pattern):
    """Any text is a category of its own (trimmed, upper case); only null and the exact
    sentinel texts become ``unknown``."""

    sentinels: Sequence[str]
    unknown: str

    def clean(self, fitted: None) -> Cleaned:
        raw = F.col(self.column).cast("string")
        missing = raw.isNull() | raw.isin(*self.sentinels)
        return Cleaned(
            F.when(missing, F.lit(self.unknown)).otherwise(standard_text(raw)),
            {self.missing_name: indicator(missing)},
        )


@dataclass(frozen=True)
class OpenNumber(Pattern):
    """Any number is a category of its own, written without a fraction of zero; only the
    sentinel and what is no number become ``unknown``."""

    sentinel: float
    unknown: str

    def clean(self, fitted: None) -> Cleaned:
        number = F.col(self.column).cast("string").try_cast("double")
        number = F.when(~F.isnan(number) & (number != self.sentinel), number)
        label = F.when(number == F.floor(number), number.try_cast("bigint").cast("string"))
        return Cleaned(
            F.coalesce(label, number.cast("string"), F.lit(self.unknown)),
            {self.missing_name: indicator(number.isNull())},
        )


@dataclass(frozen=True)
class MonthColumn(Pattern):
    """yyyyMM -> date; rows without one are dropped, or get the mode date."""

    on_missing: str = "drop"
    dtype: DataType | None = None

    def parsed(self) -> Column:
        raw = F.col(self.column)
        return raw if isinstance(self.dtype, DateType) else month_start(raw)

    def mode_source(self) -> Column | None:
        return self.parsed() if self.on_missing == "mode" else None

    def keep_row(self) -> Column | None:
        return self.parsed().isNotNull() if self.on_missing == "drop" else None

    def clean(self, fitted: Column | None) -> Cleaned:
        value = self.parsed()
        extra = {self.missing_name: indicator(value.isNull())}
        return Cleaned(value if fitted is None else F.coalesce(value, fitted), extra)


@dataclass(frozen=True)
class OptionalMonthColumn(Pattern):
    """yyyyMM -> date where a blank is a normal state, flagged and kept null."""

    standardize: bool = False

    def is_clean(self, dtype: DataType) -> bool:
        return isinstance(dtype, DateType)

    def clean(self, fitted: None) -> Cleaned:
        raw = F.col(self.column)
        text = blank_to_null(standard_text(raw) if self.standardize else raw)
        return Cleaned(month_start(text), {self.missing_name: indicator(text.isNull())})


@dataclass(frozen=True)
class FreeTextCategory(Pattern):
    """Standard text; 'NAN', blank and (by default) null become ``unknown``."""

    unknown: str
    null_is_missing: bool = True

    def clean(self, fitted: None) -> Cleaned:
        text = standard_text(F.col(self.column))
        missing = text.isin("NAN", "")
        if self.null_is_missing:
            missing = missing | text.isNull()
        return Cleaned(
            F.when(missing, F.lit(self.unknown)).otherwise(text),
            {self.missing_name: indicator(missing)},
        )


@dataclass(frozen=True)
class CostColumn(Pattern):
    """Positive amounts stay, all else is 0; the indicator marks the positive."""

    present_name: str

    def clean(self, fitted: None) -> Cleaned:
        amount = tolerant_float(F.col(self.column))
        positive = amount > 0
        return Cleaned(
            F.when(positive, amount).otherwise(F.lit(0.0).cast("float")),
            {self.present_name: indicator(positive)},
        )


@dataclass(frozen=True)
class DelinquencyStatus(Pattern):
    """Months late, clipped to 0..18; 'RA' and non-numbers are flagged.

    Unknown months become 0, or the median with ``impute='median'``.
    """

    impute: str = "zero"
    highest: int = 18

    def is_clean(self, dtype: DataType) -> bool:
        return isinstance(dtype, ByteType)

    def months(self) -> Column:
        return standard_text(F.col(self.column)).try_cast("int")

    def median_source(self) -> Column | None:
        return self.months().cast("float") if self.impute == "median" else None

    def clean(self, fitted: Column | None) -> Cleaned:
        repossessed = standard_text(F.col(self.column)) == "RA"
        months = self.months()
        fill = F.lit(0) if fitted is None else fitted.cast("int")
        value = F.least(F.greatest(F.coalesce(months, fill), F.lit(0)), F.lit(self.highest))
        unknown = months.isNull() & ~F.coalesce(repossessed, F.lit(False))
        return Cleaned(
            value.cast("byte"),
            {
                f"{self.column}_IS_RA": indicator(repossessed),
                self.missing_name: indicator(unknown),
            },
        )


def fit(df: DataFrame, patterns: Sequence[Pattern]) -> dict[str, DataFrame]:
    """One-row frames of the medians and modes the patterns impute with.

    A pattern that drops rows does so for the fit of the patterns after it.
    """
    medians, modes, kept = {}, {}, None
    for pattern in patterns:
        for target, source in (
            (medians, pattern.median_source()),
            (modes, pattern.mode_source()),
        ):
            if source is not None:
                target[pattern.column] = source if kept is None else F.when(kept, source)
        keep = pattern.keep_row()
        if keep is not None:
            kept = keep if kept is None else kept & keep

    fitted = {}
    if medians:
        fitted["medians"] = exact_medians(df, medians)
    if modes:
        # A calendar has a bounded number of months, so the counts stay small.
        fitted["modes"] = df.agg(*[F.mode(m, True).alias(name) for name, m in modes.items()])
    return fitted


def clean_columns(
    df: DataFrame, patterns: Sequence[Pattern], fit_on: DataFrame | None = None
) -> DataFrame:
    """Apply the patterns; values replace their column, indicators are added.

    Absent columns, and columns whose pattern needs another column that is absent
    or of another type, are skipped with a warning; indicators that already exist
    are left alone. ``fit_on`` fits medians and modes on another frame.
    """
    active = []
    for pattern in patterns:
        if pattern.column not in df.columns:
            warnings.warn(f"{pattern.column} not found, not cleaned", stacklevel=2)
            continue
        unmet = [
            name
            for name, kind in pattern.needs().items()
            if name not in df.columns or not isinstance(df.schema[name].dataType, kind)
        ]
        if unmet:
            warnings.warn(f"{pattern.column} not cleaned without {unmet}", stacklevel=2)
            continue
        dtype = df.schema[pattern.column].dataType
        if pattern.is_clean(dtype):
            continue
        if isinstance(pattern, MonthColumn) and isinstance(dtype, DateType):
            pattern = replace(pattern, dtype=dtype)
        active.append(pattern)

    columns, fitted = df.columns, {}
    for kind, row in fit(df if fit_on is None else fit_on, active).items():
        # One subquery per kind, as one struct, whatever the number of columns.
        df = df.withColumn(f"fitted_{kind}", row.select(F.struct("*")).scalar())
        fitted |= {name: F.col(f"fitted_{kind}.{name}") for name in row.columns}

    values, extra = {}, {}
    for pattern in active:
        cleaned = pattern.clean(fitted.get(pattern.column))
        values[pattern.column] = cleaned.value
        extra |= {n: c for n, c in cleaned.extra.items() if n not in columns}
        keep = pattern.keep_row()
        if keep is not None:
            df = df.where(keep)
    return df.select(
        *[values[name].alias(name) if name in values else F.col(name) for name in columns],
        *[column.alias(name) for name, column in extra.items()],
    )
