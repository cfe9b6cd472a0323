"""Default, exit and age of a loan, and the labels over its whole history."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanpanel.functions.codes import indicator, lookup, named
from loanpanel.functions.parsing import month_index
from loanpanel.operators.panel import by_month, whole_loan
from loanpanel.operators.sharing import Shared
from loanpanel.schemas import LOAN, MONTH

# Exits that are a default, and the category of every exit.
DEFAULT_EXITS = (
    "THIRD_PARTY_SALE",
    "SHORT_SALE_OR_CHARGE_OFF",
    "REO_DISPOSITION",
    "WHOLE_LOAN_SALE",
)
EXIT_CATEGORIES = {
    "THIRD_PARTY_SALE": "Default",
    "SHORT_SALE_OR_CHARGE_OFF": "Default",
    "REO_DISPOSITION": "Default",
    "WHOLE_LOAN_SALE": "Default",
    "PREPAID_OR_MATURED": "Prepaid",
    "REPERFORMING_LOAN_SECURITIZATION": "Repurchased",
    "DEFECT_PRIOR_TO_OTHER_EVENT": "Repurchased",
}
OTHER_EXIT = "Active"

# Months late that make a default, and the look-ahead.
DEFAULT_MONTHS = 3
LOOKAHEAD_MONTHS = 6


def payment_gap() -> Column:
    """Months since the due date of the last paid installment."""
    return F.months_between(F.col(MONTH), F.col("DDLPI"))


def in_default(gap: Column, default_exits: Sequence[str] = DEFAULT_EXITS) -> Column:
    return indicator(
        (F.col("CURRENT_DELINQUENCY_STATUS") >= DEFAULT_MONTHS)
        | (F.col("CURRENT_DELINQUENCY_STATUS_IS_RA") == 1)
        | F.col("ZERO_BALANCE_CODE").isin(*default_exits)
        | (gap >= DEFAULT_MONTHS)
    )


def with_default_flag(
    history: DataFrame, default_exits: Sequence[str] = DEFAULT_EXITS
) -> DataFrame:
    return history.withColumn("IS_IN_DEFAULT", in_default(payment_gap(), default_exits))


def exit_category(zero_balance_code: Column) -> Column:
    return F.coalesce(lookup(zero_balance_code, EXIT_CATEGORIES), F.lit(OTHER_EXIT))


def whole_months(later: Column, earlier: Column) -> Column:
    return F.round(F.months_between(later, earlier)).cast("int")


def with_chrono_age(history: DataFrame) -> DataFrame:
    """Months since the loan's first reported month, whatever LOAN_AGE says."""
    start = F.min(MONTH).over(whole_loan())
    return history.withColumn("START_DATE", start).withColumn(
        "CHRONO_AGE", whole_months(F.col(MONTH), F.col("START_DATE"))
    )


def default_in_next_rows(rows: int = LOOKAHEAD_MONTHS) -> Column:
    """Default in this row or one of the next ``rows`` rows of the loan."""
    return F.max("IS_IN_DEFAULT").over(by_month().rowsBetween(Window.currentRow, rows))


def default_in_next_months(months: int = LOOKAHEAD_MONTHS) -> Column:
    """Default in one of the next ``months`` calendar months, this one excluded."""
    ahead = (
        Window.partitionBy(LOAN).orderBy(month_index(F.col(MONTH))).rangeBetween(1, months)
    )
    return F.coalesce(F.max("IS_IN_DEFAULT").over(ahead), F.lit(0).cast("byte"))


def first_default(history: DataFrame) -> DataFrame:
    """First month in default of each loan that ever defaults."""
    return (
        history.where(F.col("IS_IN_DEFAULT") == 1)
        .groupBy(LOAN)
        .agg(F.min(MONTH).alias("FIRST_DEFAULT"))
    )


def with_first_default(history: DataFrame) -> DataFrame:
    month = F.when(F.col("IS_IN_DEFAULT") == 1, F.col(MONTH))
    return history.withColumn("FIRST_DEFAULT", F.min(month).over(whole_loan()))


def feature_cutoff(history: DataFrame) -> Column:
    """Last month features may use: six months before the last one reported.

    To be known before the features, the history is read once more; see
    ``sharing.Shared`` for how to evaluate it once.
    """
    return F.add_months(history.agg(F.max(MONTH)).scalar(), -LOOKAHEAD_MONTHS)


def before_default(cutoff: Column) -> Column:
    """Months that may feed features: up to the cutoff and before any default."""
    not_yet = F.col("FIRST_DEFAULT").isNull() | (F.col(MONTH) < F.col("FIRST_DEFAULT"))
    return (F.col(MONTH) <= cutoff) & not_yet


def pre_default_rows(history: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Rows of ``history`` (with IS_IN_DEFAULT) that features may use, with FIRST_DEFAULT.

    The history is evaluated once, whether the cutoff is given or its own.
    """
    rows = with_first_default(history)
    if cutoff is not None:
        return rows.where(before_default(cutoff))
    shared = Shared(rows, LOAN)
    return shared.rows_where(before_default(feature_cutoff(shared.rows())))


def label_aggregates() -> dict[str, Column]:
    """Per-loan aggregates behind the labels, over the full kept history."""
    defaulted = F.col("IS_IN_DEFAULT") == 1
    last_row = F.struct("IS_IN_DEFAULT", "ZERO_BALANCE_CODE", "DELINQUENCY_DUE_TO_DISASTER")
    return {
        "ever_default": F.max("IS_IN_DEFAULT"),
        "default_months": F.sum("IS_IN_DEFAULT"),
        "first_default": F.min(F.when(defaulted, F.col(MONTH))),
        "start": F.min(MONTH),
        "last_row": F.max_by(last_row, F.col(MONTH)),
        "most_interest": F.max("DELINQUENT_ACCRUED_INTEREST"),
        "any_interest": F.max("HAS_DELINQUENT_INTEREST"),
    }


def label_columns(prefix: str = "") -> dict[str, Column]:
    """The ten labels from ``label_aggregates`` whose names got this prefix.

    LABEL_DEFAULT_6MO is the maximum over all rows of a maximum over the rows
    from each one on, which is the maximum over all rows.
    """
    first, start = F.col(f"{prefix}first_default"), F.col(f"{prefix}start")
    last = F.col(f"{prefix}last_row")
    return {
        "LABEL_DEFAULT_6MO": F.col(f"{prefix}ever_default"),
        "LABEL_EVER_DEFAULTED": F.col(f"{prefix}ever_default"),
        "TOTAL_MONTHS_IN_DEFAULT": F.col(f"{prefix}default_months"),
        "AGE_AT_FIRST_DEFAULT": whole_months(first, start),
        "IS_TERMINAL_DEFAULT": last["IS_IN_DEFAULT"],
        "ACTUAL_TERMINAL_ZBC": last["ZERO_BALANCE_CODE"],
        "ACTUAL_EXIT_CATEGORY": exit_category(last["ZERO_BALANCE_CODE"]),
        "TOTAL_ACTUAL_LOSS_AMOUNT": F.col(f"{prefix}most_interest"),
        "WAS_CREDIT_LOSS_EVENT": F.col(f"{prefix}any_interest"),
        "FINAL_EXIT_WAS_DISASTER_RELATED": last["DELINQUENCY_DUE_TO_DISASTER"],
    }


def default_labels(history: DataFrame) -> DataFrame:
    """One row of labels per loan from its history (with IS_IN_DEFAULT)."""
    totals = history.groupBy(LOAN).agg(*named(label_aggregates()))
    return totals.select(LOAN, *named(label_columns()))
