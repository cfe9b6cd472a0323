"""Rules that make each loan's monthly history plausible.

After ``one_row_per_month`` a loan has at most one row per calendar month, so a
window over a loan holds a bounded number of rows whatever the raw data held.
All windows use one order, hence one shuffle and one sort by loan.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from loanpanel.operators.keys import one_row_per_key
from loanpanel.operators.performance import (
    NO_STEP_MOD,
    NOT_ASSISTED,
    NOT_DEFERRED,
    NOT_MODIFIED,
    STILL_OPEN,
)
from loanpanel.schemas import LOAN, MONTH

# Increases of the balances that need no explanation.
UPB_TOLERANCE = 1000
DEFERRED_TOLERANCE = 100


def by_month() -> WindowSpec:
    return Window.partitionBy(LOAN).orderBy(MONTH)


def whole_loan() -> WindowSpec:
    return by_month().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def earlier_months() -> WindowSpec:
    return by_month().rowsBetween(Window.unboundedPreceding, -1)


def one_row_per_month(df: DataFrame, prefer: Sequence[str] = ()) -> DataFrame:
    """Deduplicate (loan, month); the smallest row stays, by ``prefer`` first."""
    return one_row_per_key(df, [LOAN, MONTH], prefer)


def closed_before() -> Column:
    """Has the loan had a zero-balance code in an earlier month?"""
    closed = F.max(F.col("ZERO_BALANCE_CODE") != STILL_OPEN).over(earlier_months())
    return F.coalesce(closed, F.lit(False))


def until_termination(df: DataFrame) -> DataFrame:
    """Keep each loan's months up to and including its first zero-balance code."""
    return (
        df.withColumn("closed_before", closed_before())
        .where(~F.col("closed_before"))
        .drop("closed_before")
    )


def termination_month(df: DataFrame) -> DataFrame:
    """Add each loan's first month with a zero-balance code, null if open."""
    closing = F.when(F.col("ZERO_BALANCE_CODE") != STILL_OPEN, F.col(MONTH))
    return df.withColumn("TERMINATION_MONTH", F.min(closing).over(whole_loan()))


def previous_month() -> dict[str, Column]:
    """The previous row's status, balance, deferred balance and month."""
    return {
        "PREV_STATUS": F.lag("CURRENT_DELINQUENCY_STATUS").over(by_month()),
        "PREV_UPB": F.lag("CURRENT_ACTUAL_UPB").over(by_month()),
        "PREV_NIB": F.lag("CURRENT_NON_INTEREST_BEARING_UPB").over(by_month()),
        "PREV_MONTH": F.lag(MONTH).over(by_month()),
    }


def with_previous_month(df: DataFrame) -> DataFrame:
    return df.withColumns(previous_month())


def status_jump() -> Column:
    """Delinquency grew by more than one month since the previous row."""
    change = F.col("CURRENT_DELINQUENCY_STATUS").cast("int") - F.col("PREV_STATUS").cast("int")
    return F.coalesce(change > 1, F.lit(False))


def balance_jump() -> Column:
    """The balance grew with nothing in the row to explain it."""
    grew = F.col("CURRENT_ACTUAL_UPB") > F.col("PREV_UPB") + UPB_TOLERANCE
    explained = (
        (F.col("MOD_FLAG") != NOT_MODIFIED)
        | (F.col("PAYMENT_DEFERRAL_FLAG") != NOT_DEFERRED)
        | (F.col("STEP_MOD_FLAG") != NO_STEP_MOD)
        | (F.col("BORROWER_ASSISTANCE_STATUS_CODE") != NOT_ASSISTED)
        | (F.col("DELINQUENCY_DUE_TO_DISASTER") == 1)
        | (
            F.col("CURRENT_NON_INTEREST_BEARING_UPB")
            > F.coalesce(F.col("PREV_NIB"), F.lit(0)) + DEFERRED_TOLERANCE
        )
    )
    return F.coalesce(grew & ~explained, F.lit(False))


def balance_missing() -> Column:
    """No balance was reported although the loan was open."""
    missing = F.col("CURRENT_ACTUAL_UPB_IS_MISSING") == 1
    return F.coalesce(missing & (F.col("ZERO_BALANCE_CODE") == STILL_OPEN), F.lit(False))


def implausible(require_consecutive_months: bool = False) -> Column:
    """Any of the three rules; optionally jumps only count month to month."""
    jump = status_jump() | balance_jump()
    if require_consecutive_months:
        consecutive = F.col("PREV_MONTH") == F.add_months(F.col(MONTH), -1)
        jump = jump & F.coalesce(consecutive, F.lit(False))
    return jump | balance_missing()


def _loans_where(history: DataFrame, rule: Column) -> DataFrame:
    return history.where(rule).select(LOAN).distinct()


def loans_with_status_jump(history: DataFrame) -> DataFrame:
    return _loans_where(with_previous_month(history), status_jump())


def loans_with_balance_jump(history: DataFrame) -> DataFrame:
    return _loans_where(with_previous_month(history), balance_jump())


def loans_with_missing_balance(history: DataFrame) -> DataFrame:
    return _loans_where(history, balance_missing())


def implausible_loans(history: DataFrame) -> DataFrame:
    """Union of the three lists of loans, each loan once."""
    return (
        loans_with_status_jump(history)
        .union(loans_with_balance_jump(history))
        .union(loans_with_missing_balance(history))
        .distinct()
    )


def without_loans(history: DataFrame, loans: DataFrame) -> DataFrame:
    return history.join(loans, LOAN, "left_anti")


def drop_bad_loans(
    cleaned: DataFrame,
    require_consecutive_months: bool = False,
    prefer: Sequence[str] = (),
    first_months: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Deduplicate, truncate at termination and drop implausible loans.

    Truncation keeps the first months of a loan, so the previous row is the same
    before and after it and both are computed over the same window.
    ``first_months`` adds, per name, the loan's first kept month that meets the
    condition; it shares the window that finds the implausible loans.
    """
    columns, first_months = cleaned.columns, dict(first_months or {})
    marked = (
        one_row_per_month(cleaned, prefer)
        .withColumns({**previous_month(), "closed": closed_before()})
        .withColumns(
            {
                "bad_loan": F.max(
                    ~F.col("closed") & implausible(require_consecutive_months)
                ).over(whole_loan()),
                **{
                    name: F.min(F.when(~F.col("closed") & condition, F.col(MONTH))).over(
                        whole_loan()
                    )
                    for name, condition in first_months.items()
                },
            }
        )
    )
    kept = marked.where(~F.col("closed") & ~F.col("bad_loan"))
    return kept.select(*columns, *first_months)
