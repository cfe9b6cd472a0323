"""From the two raw tables to the model-ready table."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanpanel.functions.codes import indicator, named
from loanpanel.operators.features import (
    feature_aggregates,
    feature_columns,
    with_feature_inputs,
)
from loanpanel.operators.labels import (
    DEFAULT_EXITS,
    LOOKAHEAD_MONTHS,
    before_default,
    feature_cutoff,
    label_aggregates,
    in_default,
    label_columns,
    payment_gap,
    with_default_flag,
)
from loanpanel.operators.originations import ORIGINATION_PATTERNS, clean_originations
from loanpanel.operators.panel import drop_bad_loans
from loanpanel.operators.patterns import Pattern
from loanpanel.operators.performance import PERFORMANCE_PATTERNS, clean_performance
from loanpanel.operators.sharing import Shared
from loanpanel.schemas import LOAN
from loanpanel.sources.delimited import read_originations, read_performance
from loanpanel.sources.stored import ByLoan, join_by_loan

# Cleaned columns no feature or label reads; they are not shuffled.
UNREAD = (
    "CURRENT_NON_INTEREST_BEARING_UPB_IS_MISSING",
    "ZERO_BALANCE_EFFECT_DATE_IS_MISSING",
    "DDLPI_IS_MISSING",
)


def features_and_labels(
    history: DataFrame, cutoff: Column, next_6mo_label: bool = False
) -> DataFrame:
    """Features and labels per loan, from plausible rows with IS_IN_DEFAULT and
    FIRST_DEFAULT.

    Features see only months before default and cutoff, labels see all; both
    come from one aggregation. Loans without any feature month are left out.
    """
    rows = with_feature_inputs(history).withColumn("observed", before_default(cutoff))
    totals = rows.groupBy(LOAN).agg(
        *[column.alias(f"l_{name}") for name, column in label_aggregates().items()],
        *[
            column.alias(name)
            for name, column in feature_aggregates(F.col("observed")).items()
        ],
    )
    labels = label_columns("l_")
    if next_6mo_label:
        labels["LABEL_DEFAULT_NEXT_6MO"] = indicator(
            F.col("l_first_default")
            <= F.add_months(F.col("LAST_MONTHLY_REPORTING_PERIOD"), LOOKAHEAD_MONTHS)
        )
    return totals.where(F.col("PERFORMANCE_MONTHS_OBSERVED") > 0).select(
        LOAN, *named(feature_columns()), *named(labels)
    )


def aggregate_performance(
    cleaned: DataFrame,
    cutoff: Column | None = None,
    next_6mo_label: bool = False,
    require_consecutive_months: bool = False,
    prefer: Sequence[str] = (),
    settle: Callable[[DataFrame], DataFrame] | None = None,
    default_exits: Sequence[str] = DEFAULT_EXITS,
) -> DataFrame:
    """Cleaned monthly rows to one row of 64 features and 10 labels per loan.

    ``default_exits`` are the exits that count as default, for the default flag, the
    first default and all that follows from them.

    ``cutoff`` is the last month features may use; by default six months before
    the last month of any plausible loan. ``next_6mo_label`` adds whether the
    loan defaults in the six months after its last feature month.

    The plausible rows are read twice, for the cutoff and for the features, and evaluated
    once: they are shuffled by loan once more in between. ``settle`` (for example of
    ``sources.scratch.scratch``) writes them down instead, where they are wanted for more
    than this. With a cutoff that is given, neither is needed.
    """
    history = with_default_flag(
        drop_bad_loans(
            cleaned.drop(*UNREAD),
            require_consecutive_months,
            prefer,
            first_months={"FIRST_DEFAULT": in_default(payment_gap(), default_exits) == 1},
        ),
        default_exits,
    )
    if settle is not None:
        history = settle(history)
    elif cutoff is None:
        history = Shared(history, LOAN).rows()
    if cutoff is None:
        cutoff = feature_cutoff(history)
    return features_and_labels(history, cutoff, next_6mo_label)


def training_set(
    performance_raw: DataFrame,
    originations_raw: DataFrame,
    performance_patterns: Sequence[Pattern] = PERFORMANCE_PATTERNS,
    origination_patterns: Sequence[Pattern] = ORIGINATION_PATTERNS,
    trim_keys: bool = False,
    prefer_originations: Sequence[str] = (),
    fit_on: tuple[DataFrame | None, DataFrame | None] = (None, None),
    **options,
) -> DataFrame:
    """Raw frames to the training table.

    ``trim_keys`` trims the loan keys of both tables; ``prefer_originations`` orders the
    rows of one key there; ``fit_on`` names other raw tables (performance, originations)
    to fit medians and modes on. Further options as in aggregate_performance.
    """
    cleaned = clean_performance(performance_raw, performance_patterns, trim_keys, fit_on[0])
    loans = clean_originations(
        originations_raw, origination_patterns, trim_keys, prefer_originations, fit_on[1]
    )
    return aggregate_performance(cleaned, **options).join(loans, LOAN, "inner")


def build_training_set(
    spark: SparkSession, performance_path, originations_path, **options
) -> DataFrame:
    """Raw files to the training table; options as in training_set. Lazy: the caller's
    action does the work."""
    return training_set(
        read_performance(spark, performance_path),
        read_originations(spark, originations_path),
        **options,
    )


def store_training_tables(
    features: DataFrame, loans: DataFrame, features_table: ByLoan, loans_table: ByLoan, mode: str = "error"
) -> None:
    """Store what ``aggregate_performance`` and ``clean_originations`` give, by loan.

    Runs the jobs. Features change with every month and are overwritten; loans can be
    appended to (``loans_table.store(new, "append")``).
    """
    features_table.store(features, mode)
    loans_table.store(loans, mode)


def stored_training_set(spark: SparkSession, features_table: ByLoan, loans_table: ByLoan) -> DataFrame:
    """The training table from tables that are stored by loan, without a shuffle."""
    return join_by_loan(features_table.read(spark), loans_table.read(spark))
