"""Every registered query: how Spark runs it and the SQL it must agree with."""

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import duckdb_sql as sql
from checks.duckdb_sql import LOAN, MONTH, flag, query
from checks.inputs import ORIGINATIONS_RAW, PERFORMANCE_RAW, originations_raw, performance_raw
from loanpanel.functions.codes import clip, map_codes
from loanpanel.functions.parsing import numeric_string, standard_text, tolerant_float
from loanpanel.operators.features import loan_features
from loanpanel.operators.keys import duplicate_keys, with_loan_key
from loanpanel.operators.labels import (
    DEFAULT_EXITS,
    default_in_next_months,
    default_in_next_rows,
    default_labels,
    exit_category,
    feature_cutoff,
    first_default,
    payment_gap,
    pre_default_rows,
    with_chrono_age,
    with_default_flag,
    with_first_default,
)
from loanpanel.operators.originations import (
    OCCUPANCY,
    ORIGINATION_PATTERNS,
    clean_originations,
    derive_origination_date,
    drop_unused_originations,
    validate_loans,
)
from loanpanel.operators.panel import (
    drop_bad_loans,
    implausible_loans,
    loans_with_balance_jump,
    loans_with_missing_balance,
    loans_with_status_jump,
    one_row_per_month,
    termination_month,
    until_termination,
    with_previous_month,
    without_loans,
)
from loanpanel.operators.patterns import (
    CategoryColumn,
    CostColumn,
    DateDependentRatio,
    FlagColumn,
    FreeTextCategory,
    MonthColumn,
    NumericColumn,
    clean_columns,
)
from loanpanel.operators.performance import (
    PERFORMANCE_PATTERNS,
    clean_performance,
    clean_reporting_period,
    drop_unused_performance,
    filter_reporting_window,
)
from loanpanel.operators.quality import Reports, indicator_profile, value_profile
from loanpanel.plans.earlier_rules import (
    EARLIER_ORIGINATION_PATTERNS,
    EARLIER_PERFORMANCE_PATTERNS,
)
from loanpanel.plans.training_set import (
    aggregate_performance,
    build_training_set,
    features_and_labels,
    store_training_tables,
    stored_training_set,
    training_set,
)
from loanpanel.session import tuned
from loanpanel.sources.delimited import (
    canonical_performance_names,
    read_originations,
    read_originations_checked,
    read_performance,
    read_performance_checked,
    row_count_report,
)
from loanpanel.sources.scratch import scratch_dir
from loanpanel.sources.stored import ByLoan


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


QUERIES: dict[str, Query] = {}


def register(name: str, statement: str):
    def keep(run):
        QUERIES[name] = Query(lambda spark, sf_dir: run(tuned(spark), sf_dir), statement)
        return run

    return keep


# --- frames the queries start from ------------------------------------------


def loans(spark, sf_dir):
    return validate_loans(originations_raw(spark, sf_dir))


def dated_loans(spark, sf_dir):
    return derive_origination_date(loans(spark, sf_dir))


def months(spark, sf_dir):
    raw = canonical_performance_names(performance_raw(spark, sf_dir))
    return clean_reporting_period(with_loan_key(raw))


def cleaned(spark, sf_dir):
    return clean_performance(performance_raw(spark, sf_dir, read_twice=True))


def history(spark, sf_dir):
    return until_termination(one_row_per_month(cleaned(spark, sf_dir)))


def flagged(spark, sf_dir):
    return with_default_flag(drop_bad_loans(cleaned(spark, sf_dir)))


@cache
def as_text_file(spark: SparkSession, raw: Callable, sf_dir: str) -> str:
    """Raw rows written the way the files come: no header, '|', empty for null.

    Once per session and scale: the queries that read files share them.
    """
    path = f"{scratch_dir(spark)}/raw-{uuid.uuid4().hex}"
    raw(spark, sf_dir).write.csv(
        path,
        sep="|",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


# Means and deviations are compared to six digits.
ROUNDED = ("DELINQUENCY_STATUS_STDDEV", "INTEREST_RATE_STDDEV", "AVG_MONTHLY_MOD_COST")


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in ROUNDED})


# --- sources ----------------------------------------------------------------


def _blank_as_null(columns, table):
    return f"SELECT {', '.join(f'''NULLIF({c}, '') AS {c}''' for c in columns)} FROM {table}"


@register("src_originations", query(sql.ORIG_RAW, _blank_as_null(ORIGINATIONS_RAW, "orig_raw")))
def _(spark, sf_dir):
    return read_originations(spark, as_text_file(spark, originations_raw, sf_dir))


@register("src_performance", query(sql.PERF_RAW, _blank_as_null(PERFORMANCE_RAW, "perf_raw")))
def _(spark, sf_dir):
    return read_performance(spark, as_text_file(spark, performance_raw, sf_dir))


@register(
    "src_row_count_report",
    query(
        f"{sql.PERF_RAW},{sql.ORIG_RAW}",
        """SELECT 'originations' AS source, COUNT(*) AS rows, 32 AS columns FROM orig_raw
UNION ALL SELECT 'performance', COUNT(*), 32 FROM perf_raw""",
    ),
)
def _(spark, sf_dir):
    return row_count_report(originations_raw(spark, sf_dir), "originations").union(
        row_count_report(performance_raw(spark, sf_dir), "performance")
    )


# Lines whose digest begins with 0 have only their first fields, with 1 one field more.
WHOLE, SHORT = 32, 10


def _line_sql(columns, table):
    fields = ", ".join(f"COALESCE({c}, '')" for c in columns)
    return f"""broken_input AS (
  SELECT *, CASE LEFT(MD5(line), 1) WHEN '0' THEN ARRAY_TO_STRING(fields[:{SHORT}], '|') WHEN '1' THEN line || '|more'
    ELSE line END AS written
  FROM (SELECT *, ARRAY_TO_STRING(fields, '|') AS line FROM (SELECT *, [{fields}] AS fields FROM {table}))
)"""


@cache
def as_broken_text_file(spark: SparkSession, raw: Callable, sf_dir: str) -> str:
    """Raw rows as text lines, some of them broken."""
    path = f"{scratch_dir(spark)}/broken-{uuid.uuid4().hex}"
    rows = raw(spark, sf_dir)
    fields = F.array(*[F.coalesce(F.col(c), F.lit("")) for c in rows.columns])
    line = F.array_join(fields, "|")
    first = F.left(F.md5(line.cast("binary")), F.lit(1))
    written = (
        F.when(first == "0", F.array_join(F.slice(fields, 1, SHORT), "|"))
        .when(first == "1", F.concat(line, F.lit("|more")))
        .otherwise(line)
    )
    rows.select(written.alias("value")).write.text(path)
    return path


PERF_LINES = f"{sql.PERF_RAW},{_line_sql(PERFORMANCE_RAW, 'perf_raw')}"
ORIG_LINES = f"{sql.ORIG_RAW},{_line_sql(ORIGINATIONS_RAW, 'orig_raw')}"


@register(
    "src_performance_whole_lines",
    query(PERF_LINES, _blank_as_null(PERFORMANCE_RAW, "broken_input WHERE LEFT(MD5(line), 1) NOT IN ('0', '1')")),
)
def _(spark, sf_dir):
    return read_performance_checked(spark, as_broken_text_file(spark, performance_raw, sf_dir)).rows


@register(
    "src_performance_broken_lines",
    query(
        PERF_LINES,
        f"""SELECT written AS line, CAST(IF(LEFT(MD5(line), 1) = '0', {SHORT}, {WHOLE + 1}) AS INTEGER) AS fields,
  IF(LEFT(MD5(line), 1) = '0', 'too few fields', 'too many fields') AS problem
FROM broken_input WHERE LEFT(MD5(line), 1) IN ('0', '1')""",
    ),
)
def _(spark, sf_dir):
    return read_performance_checked(spark, as_broken_text_file(spark, performance_raw, sf_dir)).broken.drop("file")


@register(
    "src_load_report",
    query(
        f"{PERF_LINES},{ORIG_LINES.removeprefix('WITH ').replace('broken_input', 'broken_loans')}",
        "\nUNION ALL ".join(
            f"""SELECT '{name}' AS source, COUNT(CASE WHEN LEFT(MD5(line), 1) NOT IN ('0', '1') THEN 1 END) AS kept,
  COUNT(CASE WHEN LEFT(MD5(line), 1) = '0' THEN 1 END) AS too_few_fields,
  COUNT(CASE WHEN LEFT(MD5(line), 1) = '1' THEN 1 END) AS too_many_fields, CAST(0 AS BIGINT) AS unreadable FROM {table}"""
            for name, table in (("originations", "broken_loans"), ("performance", "broken_input"))
        ),
    ),
)
def _(spark, sf_dir):
    loans = read_originations_checked(spark, as_broken_text_file(spark, originations_raw, sf_dir))
    months = read_performance_checked(spark, as_broken_text_file(spark, performance_raw, sf_dir))
    return loans.report("originations").union(months.report("performance"))


# --- projection, cast, text -------------------------------------------------


@register(
    "drop_unused_originations",
    query(sql.ORIG_RAW, "SELECT * EXCLUDE (PRE_RELIEF_LOAN_NUMBER) FROM orig_raw"),
)
def _(spark, sf_dir):
    return drop_unused_originations(originations_raw(spark, sf_dir))


@register(
    "drop_unused_performance",
    query(
        sql.PERF_RAW,
        """SELECT * EXCLUDE (MONTHS_REMAINING_TO_LEGAL_MATURITY, DEFECT_SETTLEMENT_DATE,
  MI_RECOVERIES, NET_SALE_PROCEEDS, NON_MI_RECOVERIES, TOTAL_EXPENSES, LEGAL_COSTS,
  MAINTENANCE_AND_PRESERVE_COSTS, TAXES_AND_INSURANCE, MISC_EXPENSES, ACTUAL_LOSS_CALC,
  ZERO_BALANCE_REMOVAL_UPB, INTEREST_BEARING_UPB) FROM perf_raw""",
    ),
)
def _(spark, sf_dir):
    return drop_unused_performance(performance_raw(spark, sf_dir))


@register(
    "derive_origination_date",
    query(sql.ORIG_LOANS, f"SELECT {LOAN}, ORIGINATION_DATE FROM orig_dated"),
)
def _(spark, sf_dir):
    return dated_loans(spark, sf_dir).select(LOAN, "ORIGINATION_DATE")


NUMBERS = ("CURRENT_ACTUAL_UPB", "LOAN_AGE", "CURRENT_INTEREST_RATE", "ELTV")


@register(
    "cast_numeric_coerce",
    query(
        sql.PERF_RAW,
        f"SELECT {LOAN}, {MONTH}, "
        + ", ".join(f"{sql.observed(c)} AS {c}" for c in NUMBERS)
        + " FROM perf_raw",
    ),
)
def _(spark, sf_dir):
    return performance_raw(spark, sf_dir).select(
        LOAN, MONTH, *[tolerant_float(F.col(c)).alias(c) for c in NUMBERS]
    )


@register(
    "cast_target_width",
    query(
        sql.ORIG_RAW,
        f"""SELECT {LOAN},
  {sql.bounded(sql.observed('ORIGINAL_INTEREST_RATE'), 0, 20, 'TINYINT')} AS rate_byte,
  {sql.bounded(sql.observed('CREDIT_SCORE'), 300, 850, 'SMALLINT')} AS score_short,
  {sql.bounded(sql.observed('ORIGINAL_UPB'), 0, 3000000, 'INTEGER')} AS upb_int
FROM orig_raw""",
    ),
)
def _(spark, sf_dir):
    def narrowed(column, low, high, dtype):
        return clip(tolerant_float(F.col(column)), low, high).cast(dtype)

    return originations_raw(spark, sf_dir).select(
        LOAN,
        narrowed("ORIGINAL_INTEREST_RATE", 0, 20, "byte").alias("rate_byte"),
        narrowed("CREDIT_SCORE", 300, 850, "short").alias("score_short"),
        narrowed("ORIGINAL_UPB", 0, 3_000_000, "int").alias("upb_int"),
    )


TEXTS = ("OCCUPANCY_STATUS", "CHANNEL", "PROPERTY_STATE", "SELLER_NAME", "SERVICER_NAME")


@register(
    "standardize_text",
    query(
        sql.ORIG_RAW,
        f"SELECT {LOAN}, {', '.join(f'{sql.text(c)} AS {c}' for c in TEXTS)} FROM orig_raw",
    ),
)
def _(spark, sf_dir):
    return originations_raw(spark, sf_dir).select(
        LOAN, *[standard_text(F.col(c)).alias(c) for c in TEXTS]
    )


_occupancy = sql.mapped(sql.text("OCCUPANCY_STATUS"), sql.ORIG_CATEGORIES["OCCUPANCY_STATUS"][0])


@register(
    "map_codes",
    query(
        sql.ORIG_RAW,
        f"""SELECT {LOAN}, {_occupancy} AS label,
  COALESCE({_occupancy}, 'OTHER') AS label_or_default FROM orig_raw""",
    ),
)
def _(spark, sf_dir):
    code = standard_text(F.col("OCCUPANCY_STATUS"))
    return originations_raw(spark, sf_dir).select(
        LOAN,
        map_codes(code, OCCUPANCY).alias("label"),
        map_codes(code, OCCUPANCY, "OTHER").alias("label_or_default"),
    )


@register(
    "numeric_string",
    query(sql.ORIG_RAW, f"SELECT {LOAN}, {sql.BORROWER_TEXT} AS borrowers FROM orig_raw"),
)
def _(spark, sf_dir):
    return originations_raw(spark, sf_dir).select(
        LOAN, numeric_string(F.col("NUMBER_OF_BORROWERS")).alias("borrowers")
    )


# --- cleaning patterns, as groups and per column ----------------------------


def _extras(patterns):
    """Names of the indicator columns the patterns add."""
    names = []
    for pattern in patterns:
        if isinstance(pattern, CostColumn):
            names.append(pattern.present_name)
        elif isinstance(pattern, CategoryColumn):
            names += [f"{pattern.column}_{suffix}" for suffix in pattern.special_indicators]
        elif type(pattern) is not FlagColumn and not isinstance(pattern, FlagColumn):
            names.append(pattern.missing_name)
        if pattern.column == "CURRENT_DELINQUENCY_STATUS":
            names.append("CURRENT_DELINQUENCY_STATUS_IS_RA")
        if pattern.column == "DELINQUENCY_DUE_TO_DISASTER":
            names.append("DISASTER_FLAG_MISSING")
    return names


def _register_originations(name, patterns, wanted=None):
    shown = wanted or patterns
    columns = [LOAN, *[p.column for p in shown], *_extras(shown)]
    kept = [f"{p.column} IS NOT NULL" for p in patterns if isinstance(p, MonthColumn)]
    where = f" WHERE {' AND '.join(kept)}" if kept else ""
    register(name, query(sql.ORIG_CLEAN, f"SELECT {', '.join(columns)} FROM orig_all{where}"))(
        lambda spark, sf_dir: clean_columns(
            dated_loans(spark, sf_dir), patterns, fit_on=loans(spark, sf_dir)
        ).select(*columns)
    )


def _register_performance(name, patterns):
    columns = [LOAN, MONTH, *[p.column for p in patterns], *_extras(patterns)]
    register(name, query(sql.PERF_CLEAN, f"SELECT {', '.join(columns)} FROM perf_clean"))(
        lambda spark, sf_dir: clean_columns(months(spark, sf_dir), patterns).select(*columns)
    )


def _of(patterns, kind):
    return [pattern for pattern in patterns if type(pattern) is kind]


DATES = _of(ORIGINATION_PATTERNS, MonthColumn)
_register_originations(
    "clean_numeric",
    [p for p in _of(ORIGINATION_PATTERNS, NumericColumn) if p.column != "ORIGINAL_LOAN_TERM"],
)
_register_originations("clean_binary_flag", _of(ORIGINATION_PATTERNS, FlagColumn))
_register_originations("clean_categorical", _of(ORIGINATION_PATTERNS, CategoryColumn))
_register_originations("clean_date_dependent_ratio", _of(ORIGINATION_PATTERNS, DateDependentRatio))
_register_originations("clean_datetime", DATES)
_register_originations("clean_free_text_category", _of(ORIGINATION_PATTERNS, FreeTextCategory))
_register_performance("clean_financial_cost", _of(PERFORMANCE_PATTERNS, CostColumn))

SHORT_NAMES = {
    "MSA_OR_MET_DIV": "clean_msa",
    "POSTAL_CODE": "clean_postal",
    "NUMBER_OF_BORROWERS": "clean_num_borrowers",
    "ZERO_BALANCE_EFFECT_DATE": "clean_zero_balance_date",
    "CURRENT_DELINQUENCY_STATUS": "clean_delinquency_status",
}
for _pattern in ORIGINATION_PATTERNS:
    if _pattern.column == "ORIGINAL_LOAN_TERM":
        # The term's median is fitted after rows without the two dates are gone.
        _register_originations("clean_loan_term", [*DATES, _pattern], [_pattern])
    else:
        _name = SHORT_NAMES.get(_pattern.column, f"clean_{_pattern.column.lower()}")
        _register_originations(_name, [_pattern])
for _pattern in PERFORMANCE_PATTERNS:
    _name = SHORT_NAMES.get(_pattern.column, f"clean_{_pattern.column.lower()}")
    _register_performance(_name, [_pattern])


@register("clean_originations", query(sql.ORIG_CLEAN, "SELECT * FROM orig_clean"))
def _(spark, sf_dir):
    return clean_originations(originations_raw(spark, sf_dir))


@register("clean_reporting_period", query(sql.PERF_VALID, f"SELECT {LOAN}, {MONTH} FROM perf_valid"))
def _(spark, sf_dir):
    return months(spark, sf_dir).select(LOAN, MONTH)


@register("clean_performance", query(sql.PERF_CLEAN, "SELECT * FROM perf_clean"))
def _(spark, sf_dir):
    return cleaned(spark, sf_dir)


# --- keys and panel rules ---------------------------------------------------


@register(
    "pk_not_null",
    query(sql.ORIG_RAW, f"SELECT {LOAN}, CREDIT_SCORE FROM orig_raw WHERE {LOAN} IS NOT NULL"),
)
def _(spark, sf_dir):
    return with_loan_key(originations_raw(spark, sf_dir)).select(LOAN, "CREDIT_SCORE")


@register("pk_unique", query(sql.ORIG_LOANS, "SELECT * FROM orig_loans"))
def _(spark, sf_dir):
    return loans(spark, sf_dir)


@register(
    "pk_duplicates",
    query(
        sql.ORIG_RAW,
        f"""SELECT {LOAN}, COUNT(*) AS count FROM orig_raw WHERE {LOAN} IS NOT NULL
GROUP BY {LOAN} HAVING COUNT(*) > 1""",
    ),
)
def _(spark, sf_dir):
    return duplicate_keys(with_loan_key(originations_raw(spark, sf_dir)))


@register("panel_dedup", query(sql.DEDUP, "SELECT * FROM panel"))
def _(spark, sf_dir):
    return one_row_per_month(cleaned(spark, sf_dir))


@register("truncate_after_termination", query(sql.TERMINATED, "SELECT * FROM history"))
def _(spark, sf_dir):
    return history(spark, sf_dir)


@register(
    "join_termination",
    query(
        sql.TERMINATED,
        f"""SELECT {LOAN}, {MONTH}, ZERO_BALANCE_CODE, TERMINATION_MONTH
FROM panel LEFT JOIN terminations USING ({LOAN})""",
    ),
)
def _(spark, sf_dir):
    panel = one_row_per_month(cleaned(spark, sf_dir))
    return termination_month(panel).select(
        LOAN, MONTH, "ZERO_BALANCE_CODE", "TERMINATION_MONTH"
    )


def _register_previous(name, column, previous):
    register(name, query(sql.LAGS, f"SELECT {LOAN}, {MONTH}, {column}, {previous} FROM lagged"))(
        lambda spark, sf_dir: with_previous_month(history(spark, sf_dir)).select(
            LOAN, MONTH, column, previous
        )
    )


_register_previous("prev_status", "CURRENT_DELINQUENCY_STATUS", "PREV_STATUS")
_register_previous("prev_upb", "CURRENT_ACTUAL_UPB", "PREV_UPB")
_register_previous("prev_nib", "CURRENT_NON_INTEREST_BEARING_UPB", "PREV_NIB")


@register("bad_delinquency_jump", query(sql.LAGS, "SELECT * FROM bad_status"))
def _(spark, sf_dir):
    return loans_with_status_jump(history(spark, sf_dir))


@register("bad_upb_jump", query(sql.LAGS, "SELECT * FROM bad_upb"))
def _(spark, sf_dir):
    return loans_with_balance_jump(history(spark, sf_dir))


@register("bad_missing_upb", query(sql.LAGS, "SELECT * FROM bad_missing"))
def _(spark, sf_dir):
    return loans_with_missing_balance(history(spark, sf_dir))


@register("exclusion_union", query(sql.LAGS, "SELECT * FROM bad_loans"))
def _(spark, sf_dir):
    return implausible_loans(history(spark, sf_dir))


@register("exclude_bad_loans", query(sql.LAGS, f"SELECT {LOAN}, {MONTH} FROM kept"))
def _(spark, sf_dir):
    return drop_bad_loans(cleaned(spark, sf_dir)).select(LOAN, MONTH)


@register("join_exclusions", query(sql.LAGS, f"SELECT {LOAN}, {MONTH}, ELTV FROM kept"))
def _(spark, sf_dir):
    rows = history(spark, sf_dir)
    return without_loans(rows, implausible_loans(rows)).select(LOAN, MONTH, "ELTV")


@register("drop_bad_loans", query(sql.LAGS, "SELECT * FROM kept"))
def _(spark, sf_dir):
    return drop_bad_loans(cleaned(spark, sf_dir))


# --- default, labels, features ----------------------------------------------


@register(
    "default_flag",
    query(sql.DEFAULTED, f"SELECT {LOAN}, {MONTH}, GAP AS PAYMENT_GAP, IS_IN_DEFAULT FROM flagged"),
)
def _(spark, sf_dir):
    return flagged(spark, sf_dir).select(
        LOAN, MONTH, payment_gap().alias("PAYMENT_GAP"), "IS_IN_DEFAULT"
    )


@register(
    "exit_category",
    query(
        sql.DEFAULTED,
        f"SELECT {LOAN}, {MONTH}, ZERO_BALANCE_CODE, EXIT_CATEGORY FROM flagged",
    ),
)
def _(spark, sf_dir):
    code = F.col("ZERO_BALANCE_CODE")
    return drop_bad_loans(cleaned(spark, sf_dir)).select(
        LOAN, MONTH, code, exit_category(code).alias("EXIT_CATEGORY")
    )


@register("chrono_age", query(sql.DEFAULTED, f"SELECT {LOAN}, {MONTH}, CHRONO_AGE FROM flagged"))
def _(spark, sf_dir):
    rows = drop_bad_loans(cleaned(spark, sf_dir))
    return with_chrono_age(rows).select(LOAN, MONTH, "CHRONO_AGE")


@register(
    "join_start_date", query(sql.DEFAULTED, f"SELECT {LOAN}, {MONTH}, START_DATE FROM flagged")
)
def _(spark, sf_dir):
    rows = drop_bad_loans(cleaned(spark, sf_dir))
    return with_chrono_age(rows).select(LOAN, MONTH, "START_DATE")


@register(
    "default_lookahead_rows",
    query(
        sql.DEFAULTED,
        f"""SELECT {LOAN}, {MONTH}, MAX(IS_IN_DEFAULT) OVER (PARTITION BY {LOAN} ORDER BY {MONTH}
  ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS DEFAULT_LOOKAHEAD_6MO FROM flagged""",
    ),
)
def _(spark, sf_dir):
    return flagged(spark, sf_dir).select(
        LOAN, MONTH, default_in_next_rows().alias("DEFAULT_LOOKAHEAD_6MO")
    )


@register(
    "default_lookahead_months",
    query(
        sql.DEFAULTED,
        f"""SELECT a.{LOAN}, a.{MONTH}, CAST(COALESCE(MAX(b.IS_IN_DEFAULT), 0) AS TINYINT) AS DEFAULT_NEXT_6MO
FROM flagged a LEFT JOIN flagged b ON a.{LOAN} = b.{LOAN}
  AND b.{MONTH} > a.{MONTH} AND b.{MONTH} <= a.{MONTH} + INTERVAL 6 MONTH
GROUP BY a.{LOAN}, a.{MONTH}""",
    ),
)
def _(spark, sf_dir):
    return flagged(spark, sf_dir).select(
        LOAN, MONTH, default_in_next_months().alias("DEFAULT_NEXT_6MO")
    )


@register("first_default", query(sql.DEFAULTED, "SELECT * FROM first_defaults"))
def _(spark, sf_dir):
    return first_default(flagged(spark, sf_dir))


@register(
    "join_first_default",
    query(
        sql.DEFAULTED,
        f"""SELECT {LOAN}, {MONTH}, IS_IN_DEFAULT, FIRST_DEFAULT
FROM flagged LEFT JOIN first_defaults USING ({LOAN})""",
    ),
)
def _(spark, sf_dir):
    return with_first_default(flagged(spark, sf_dir)).select(
        LOAN, MONTH, "IS_IN_DEFAULT", "FIRST_DEFAULT"
    )


@register("pre_default_mask", query(sql.DEFAULTED, f"SELECT {LOAN}, {MONTH} FROM observed_rows"))
def _(spark, sf_dir):
    return pre_default_rows(flagged(spark, sf_dir)).select(LOAN, MONTH)


@register("default_labels", query(sql.DEFAULTED, "SELECT * FROM labels"))
def _(spark, sf_dir):
    return default_labels(flagged(spark, sf_dir))


@register("loan_features", query(sql.AGGREGATED, "SELECT * FROM features"))
def _(spark, sf_dir):
    return rounded(loan_features(pre_default_rows(flagged(spark, sf_dir))))


@register("join_features_labels", query(sql.AGGREGATED, "SELECT * FROM aggregated"))
def _(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    features = loan_features(pre_default_rows(rows))
    return rounded(features.join(default_labels(rows), LOAN, "inner"))


@register("aggregate_and_join", query(sql.AGGREGATED, "SELECT * FROM aggregated"))
def _(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    return rounded(features_and_labels(with_first_default(rows), feature_cutoff(rows)))


@register("aggregate_performance", query(sql.AGGREGATED, "SELECT * FROM aggregated"))
def _(spark, sf_dir):
    return rounded(aggregate_performance(cleaned(spark, sf_dir)))


@register(
    "label_default_next_6mo",
    query(
        sql.AGGREGATED,
        f"""SELECT {LOAN}, LAST_MONTHLY_REPORTING_PERIOD,
  {flag(f'FIRST_DEFAULT <= LAST_MONTHLY_REPORTING_PERIOD + INTERVAL 6 MONTH')} AS LABEL_DEFAULT_NEXT_6MO
FROM aggregated LEFT JOIN first_defaults USING ({LOAN})""",
    ),
)
def _(spark, sf_dir):
    return aggregate_performance(cleaned(spark, sf_dir), next_6mo_label=True).select(
        LOAN, "LAST_MONTHLY_REPORTING_PERIOD", "LABEL_DEFAULT_NEXT_6MO"
    )


_exits = f"OR ZERO_BALANCE_CODE IN {sql.BAD_EXITS} OR"


@register(
    "aggregate_performance_reperforming",
    query(
        sql.AGGREGATED.replace(
            _exits, _exits.replace(")", ", 'REPERFORMING_LOAN_SECURITIZATION')")
        ),
        "SELECT * FROM aggregated",
    ),
)
def _(spark, sf_dir):
    exits = (*DEFAULT_EXITS, "REPERFORMING_LOAN_SECURITIZATION")
    return rounded(aggregate_performance(cleaned(spark, sf_dir), default_exits=exits))


TRAINING = query(sql.TRAINING, f"SELECT * FROM aggregated JOIN orig_clean USING ({LOAN})")


@register("join_performance_originations", TRAINING)
def _(spark, sf_dir):
    performance = performance_raw(spark, sf_dir, read_twice=True)
    return rounded(training_set(performance, originations_raw(spark, sf_dir)))


@register("build_training_set", TRAINING)
def _(spark, sf_dir):
    return rounded(
        build_training_set(
            spark,
            as_text_file(spark, performance_raw, sf_dir),
            as_text_file(spark, originations_raw, sf_dir),
        )
    )


@register("join_stored_tables", TRAINING)
def _(spark, sf_dir):
    """Both tables stored by loan, then joined without a shuffle."""
    own = uuid.uuid4().hex
    tables = [
        ByLoan(f"{name}_{own}", f"{scratch_dir(spark)}/{name}-{own}", 8) for name in ("features", "loans")
    ]
    features = aggregate_performance(cleaned(spark, sf_dir))
    store_training_tables(features, clean_originations(originations_raw(spark, sf_dir)), *tables)
    return rounded(stored_training_set(spark, *tables))


# --- quality reports --------------------------------------------------------

_profiles = [
    f"""SELECT '{c}' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
  COUNT({c}) - COUNT({sql.observed(c)}) AS invalid,
  COUNT({sql.observed(c)}) - COUNT({sql.observed(c, m)}) AS sentinels,
  CAST(SUM(CASE WHEN {sql.observed(c, m)} < {low} THEN 1 ELSE 0 END) AS BIGINT) AS below_range,
  CAST(SUM(CASE WHEN {sql.observed(c, m)} > {high} THEN 1 ELSE 0 END) AS BIGINT) AS above_range,
  MIN({sql.observed(c, m)}) AS smallest, MAX({sql.observed(c, m)}) AS largest FROM orig_raw"""
    for c, (_, low, high, m) in sql.ORIG_NUMBERS.items()
]


@register("value_profile", query(sql.ORIG_RAW, "\nUNION ALL ".join(_profiles)))
def _(spark, sf_dir):
    numeric = [p for p in ORIGINATION_PATTERNS if p.column in sql.ORIG_NUMBERS]
    return value_profile(originations_raw(spark, sf_dir), numeric)


INDICATORS = [f"{c}_IS_MISSING" for c in sql.PERF_NUMBERS] + ["DISASTER_FLAG_MISSING"]


@register(
    "indicator_profile",
    query(
        sql.PERF_CLEAN,
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", COUNT(CASE WHEN {c} = 0 THEN 1 END) AS zeros,
  COUNT(CASE WHEN {c} = 1 THEN 1 END) AS ones FROM perf_clean"""
            for c in INDICATORS
        ),
    ),
)
def _(spark, sf_dir):
    return indicator_profile(cleaned(spark, sf_dir), INDICATORS)


def _cleaned_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/cleaned-{uuid.uuid4().hex}/{name}"


def _reported_originations(spark: SparkSession, sf_dir: str, reports: Reports) -> None:
    """Cleans and writes the originations, and reports on the raw rows on the way."""
    raw = originations_raw(spark, sf_dir)
    numeric = [p for p in ORIGINATION_PATTERNS if p.column in sql.ORIG_NUMBERS]
    watched = reports.values(reports.rows(raw, "originations"), "originations", numeric)
    clean_originations(watched, fit_on=raw).write.parquet(_cleaned_folder(spark, "originations"))


def _reported_performance(spark: SparkSession, sf_dir: str, reports: Reports) -> None:
    """Cleans and writes the monthly rows, and reports on raw and cleaned ones on the way."""
    raw = performance_raw(spark, sf_dir)
    # the medians are fitted on the raw rows themselves; these are read once
    months = clean_performance(reports.rows(raw, "performance"), fit_on=raw)
    watched = reports.indicators(months, "performance", INDICATORS)
    watched.write.parquet(_cleaned_folder(spark, "performance"))


# Each of the three runs the writes that its own report comes with, of one table or of both. They
# share no run, so that what one costs does not depend on which others came before it.


@register("src_row_count_report_observed", QUERIES["src_row_count_report"].sql)
def _(spark, sf_dir):
    reports = Reports()
    _reported_originations(spark, sf_dir, reports)
    _reported_performance(spark, sf_dir, reports)
    return reports.row_count_report(spark)


@register("value_profile_observed", QUERIES["value_profile"].sql)
def _(spark, sf_dir):
    reports = Reports()
    _reported_originations(spark, sf_dir, reports)
    return reports.value_profile(spark, "originations")


@register("indicator_profile_observed", QUERIES["indicator_profile"].sql)
def _(spark, sf_dir):
    reports = Reports()
    _reported_performance(spark, sf_dir, reports)
    return reports.indicator_profile(spark, "performance")


# --- the older rules --------------------------------------------------------


def _earlier(column, patterns=EARLIER_ORIGINATION_PATTERNS):
    return next(pattern for pattern in patterns if pattern.column == column)


@register(
    "filter_reporting_window",
    query(
        sql.PERF_RAW,
        f"""SELECT {LOAN}, {MONTH}, {sql.month(MONTH)} AS REPORTING_DATE FROM perf_raw
WHERE {sql.month(MONTH)} BETWEEN DATE '2023-01-01' AND DATE '2024-04-01'""",
    ),
)
def _(spark, sf_dir):
    return filter_reporting_window(
        performance_raw(spark, sf_dir), date(2023, 1, 1), date(2024, 4, 1)
    ).select(LOAN, MONTH, "REPORTING_DATE")


def _mode(column, table):
    return (
        f"(SELECT d FROM (SELECT {sql.month(column)} AS d FROM {table}) WHERE d IS NOT NULL "
        "GROUP BY d ORDER BY COUNT(*) DESC, d LIMIT 1)"
    )


@register(
    "impute_mode_date",
    query(
        sql.ORIG_LOANS,
        f"SELECT {LOAN}, "
        + ", ".join(
            f"COALESCE({sql.month(c)}, {_mode(c, 'orig_loans')}) AS {c}, "
            f"{flag(f'{sql.month(c)} IS NULL')} AS {c}_IS_MISSING"
            for c in ("FIRST_PAYMENT_DATE", "MATURITY_DATE")
        )
        + " FROM orig_loans",
    ),
)
def _(spark, sf_dir):
    patterns = [_earlier("FIRST_PAYMENT_DATE"), _earlier("MATURITY_DATE")]
    return clean_columns(loans(spark, sf_dir), patterns).select(
        LOAN,
        "FIRST_PAYMENT_DATE",
        "FIRST_PAYMENT_DATE_IS_MISSING",
        "MATURITY_DATE",
        "MATURITY_DATE_IS_MISSING",
    )


@register(
    "impute_mode_zero_balance_date",
    query(
        sql.PERF_VALID,
        f"""SELECT {LOAN}, {MONTH},
  COALESCE({sql.month('ZERO_BALANCE_EFFECT_DATE')}, {_mode('ZERO_BALANCE_EFFECT_DATE', 'perf_valid')}) AS ZERO_BALANCE_EFFECT_DATE,
  {flag(f"{sql.month('ZERO_BALANCE_EFFECT_DATE')} IS NULL")} AS ZERO_BALANCE_EFFECT_DATE_IS_MISSING
FROM perf_valid""",
    ),
)
def _(spark, sf_dir):
    pattern = _earlier("ZERO_BALANCE_EFFECT_DATE", EARLIER_PERFORMANCE_PATTERNS)
    return clean_columns(months(spark, sf_dir), [pattern]).select(
        LOAN, MONTH, "ZERO_BALANCE_EFFECT_DATE", "ZERO_BALANCE_EFFECT_DATE_IS_MISSING"
    )


CATEGORIES = list(sql.ORIG_CATEGORIES)


@register(
    "category_missing_flag",
    query(
        sql.ORIG_LOANS,
        f"SELECT {LOAN}, "
        + ", ".join(
            f"{sql.category(c, pairs, unknown)}, "
            f"{flag(f'{sql.mapped(sql.text(c), pairs)} IS NULL')} AS {c}_IS_MISSING"
            for c, (pairs, unknown) in sql.ORIG_CATEGORIES.items()
        )
        + f""", {flag(f"{sql.text('PPM_FLAG')} IN ('Y', '1')")} AS PPM_FLAG,
  {flag(f"{sql.text('PPM_FLAG')} IS NULL OR {sql.text('PPM_FLAG')} NOT IN ('Y', 'N', '1', '0')")} AS PPM_FLAG_IS_MISSING
FROM orig_loans""",
    ),
)
def _(spark, sf_dir):
    patterns = [
        replace(p, missing_flag=True) for p in ORIGINATION_PATTERNS if p.column in CATEGORIES
    ]
    names = [*CATEGORIES, "PPM_FLAG"]
    return clean_columns(loans(spark, sf_dir), [*patterns, _earlier("PPM_FLAG")]).select(
        LOAN, *names, *[f"{name}_IS_MISSING" for name in names]
    )


def _coded(column, codes, unknown):
    """Codes stay, all else is unknown."""
    known = f"{sql.text(column)} IN ({', '.join(f"'{c}'" for c in codes)})"
    return (
        f"CASE WHEN {known} THEN {sql.text(column)} ELSE '{unknown}' END AS {column}",
        f"{flag(f'NOT COALESCE({known}, FALSE)')} AS {column}_IS_MISSING",
    )


def _open(column, unknown):
    """Only '9' and null are unknown, any other text stays."""
    return (
        f"CASE WHEN {column} IS NULL OR {column} = '9' THEN '{unknown}' ELSE {sql.text(column)} END AS {column}",
        f"{flag(f"{column} IS NULL OR {column} = '9'")} AS {column}_IS_MISSING",
    )


_units = "TRY_CAST(NUMBER_OF_UNITS AS DOUBLE)"
# The older categories, all labels of unknown values written out.
EARLIER_CATEGORIES = {
    "NUMBER_OF_UNITS": (
        f"CASE WHEN {_units} IS NULL OR {_units} = 99 THEN 'UNITS_UNKNOWN' "
        f"ELSE CAST(CAST({_units} AS BIGINT) AS VARCHAR) END AS NUMBER_OF_UNITS",
        f"{flag(f'{_units} IS NULL OR {_units} = 99')} AS NUMBER_OF_UNITS_IS_MISSING",
    ),
    "OCCUPANCY_STATUS": _open("OCCUPANCY_STATUS", "OCCUPANCY_UNKNOWN"),
    "CHANNEL": _open("CHANNEL", "CHANNEL_UNKNOWN"),
    "AMORTIZATION_TYPE": _coded("AMORTIZATION_TYPE", ("FRM", "ARM"), "AMORTIZATION_TYPE_UNKNOWN"),
    "PROPERTY_STATE": _coded("PROPERTY_STATE", sql.STATES, "STATE_OR_TERRITORY_UNKNOWN"),
    "PROPERTY_TYPE": _coded("PROPERTY_TYPE", ("CO", "PU", "MH", "SF", "CP"), "PROPERTY_TYPE_UNKNOWN"),
    "LOAN_PURPOSE": _coded("LOAN_PURPOSE", ("P", "N", "C", "R"), "LOAN_PURPOSE_UNKNOWN"),
    "PROGRAM_INDICATOR": _coded("PROGRAM_INDICATOR", ("H", "F", "R"), "PROGRAM_INDICATOR_UNKNOWN"),
    "PROP_VALUATION_METHOD": _coded(
        "PROP_VALUATION_METHOD", ("1", "2", "3", "4"), "PROP_VAL_METHOD_UNKNOWN"
    ),
    "MI_CANCEL_INDICATOR": _coded(
        "MI_CANCEL_INDICATOR", ("Y", "N", "7", "9"), "MI_CANCEL_INDICATOR_UNKNOWN"
    ),
}


@register(
    "keep_codes",
    query(
        sql.ORIG_LOANS,
        f"SELECT {LOAN}, {', '.join(value for value, _ in EARLIER_CATEGORIES.values())} FROM orig_loans",
    ),
)
def _(spark, sf_dir):
    patterns = [_earlier(c) for c in CATEGORIES]
    return clean_columns(loans(spark, sf_dir), patterns).select(LOAN, *CATEGORIES)


# column: (codes, label of anything else)
EARLIER_CODES = {
    "MOD_FLAG": ("('Y', 'P')", "NOT_MODIFIED"),
    "STEP_MOD_FLAG": ("('Y', 'N')", "NOT_MODIFIED_IN_PERIOD"),
    "PAYMENT_DEFERRAL_FLAG": ("('Y', 'P')", "NOT_PAYMENT_DEFERRAL"),
}


@register(
    "keep_codes_performance",
    query(
        sql.PERF_VALID,
        f"SELECT {LOAN}, {MONTH}, "
        + ", ".join(
            f"CASE WHEN {sql.text(c)} IN {codes} THEN {sql.text(c)} ELSE '{unknown}' END AS {c}, "
            f"{flag(f'{sql.text(c)} IS NULL OR {sql.text(c)} NOT IN {codes}')} AS {c}_IS_MISSING"
            for c, (codes, unknown) in EARLIER_CODES.items()
        )
        + " FROM perf_valid",
    ),
)
def _(spark, sf_dir):
    patterns = [_earlier(c, EARLIER_PERFORMANCE_PATTERNS) for c in EARLIER_CODES]
    return clean_columns(months(spark, sf_dir), patterns).select(
        LOAN, MONTH, *EARLIER_CODES, *[f"{c}_IS_MISSING" for c in EARLIER_CODES]
    )


_msa = sql.text("MSA_OR_MET_DIV")


@register(
    "msa_invalid_bucket",
    query(
        sql.ORIG_LOANS,
        f"""SELECT {LOAN}, CASE WHEN {_msa} IS NULL OR {_msa} = 'NAN' THEN 'NON_MSA_OR_UNKNOWN'
  ELSE COALESCE({sql.WHOLE_MSA}, 'OTHER_INVALID_CODE') END AS MSA_OR_MET_DIV,
  {flag(f"{_msa} IS NULL OR {_msa} = 'NAN'")} AS MSA_OR_MET_DIV_IS_MISSING FROM orig_loans""",
    ),
)
def _(spark, sf_dir):
    return clean_columns(loans(spark, sf_dir), [_earlier("MSA_OR_MET_DIV")]).select(
        LOAN, "MSA_OR_MET_DIV", "MSA_OR_MET_DIV_IS_MISSING"
    )


def _imputed(ctes, table, column, value, low, high, dtype, keys):
    """A numeric column imputed with the median of ``value`` over ``table``."""
    return query(
        ctes,
        f"""SELECT {keys}, {sql.bounded('COALESCE(v, m)', low, high, dtype)} AS {column},
  {flag('v IS NULL')} AS {column}_IS_MISSING
FROM (SELECT *, {value} AS v FROM {table}),
  (SELECT CAST(MEDIAN(CAST(v AS DOUBLE)) AS FLOAT) AS m FROM (SELECT {value} AS v FROM {table}))""",
    )


@register(
    "negative_is_missing",
    _imputed(
        sql.PERF_VALID,
        "perf_valid",
        "LOAN_AGE",
        sql.observed("LOAN_AGE", "< 0"),
        0,
        600,
        "SMALLINT",
        f"{LOAN}, {MONTH}",
    ),
)
def _(spark, sf_dir):
    pattern = _earlier("LOAN_AGE", EARLIER_PERFORMANCE_PATTERNS)
    return clean_columns(months(spark, sf_dir), [pattern]).select(
        LOAN, MONTH, "LOAN_AGE", "LOAN_AGE_IS_MISSING"
    )


@register(
    "impute_delinquency_median",
    query(
        sql.PERF_VALID,
        f"""SELECT {LOAN}, {MONTH},
  {sql.bounded('COALESCE(v, TRUNC(m))', 0, 18, 'TINYINT')} AS CURRENT_DELINQUENCY_STATUS,
  {flag(f"{sql.STATUS_TEXT} = 'RA'")} AS CURRENT_DELINQUENCY_STATUS_IS_RA,
  {flag(f"v IS NULL AND ({sql.STATUS_TEXT} IS NULL OR {sql.STATUS_TEXT} <> 'RA')")} AS CURRENT_DELINQUENCY_STATUS_IS_MISSING
FROM (SELECT *, {sql.STATUS_NUMBER} AS v FROM perf_valid),
  (SELECT MEDIAN(CAST({sql.STATUS_NUMBER} AS DOUBLE)) AS m FROM perf_valid)""",
    ),
)
def _(spark, sf_dir):
    pattern = _earlier("CURRENT_DELINQUENCY_STATUS", EARLIER_PERFORMANCE_PATTERNS)
    name = pattern.column
    return clean_columns(months(spark, sf_dir), [pattern]).select(
        LOAN, MONTH, name, f"{name}_IS_RA", f"{name}_IS_MISSING"
    )


_zbc = "TRY_CAST(TRIM(ZERO_BALANCE_CODE) AS DOUBLE)"
_zbc_label = f"""CASE {_zbc} WHEN 1 THEN 'PREPAID_OR_MATURED' WHEN 2 THEN 'THIRD_PARTY_SALE'
  WHEN 3 THEN 'SHORT_SALE_OR_CHARGE_OFF' WHEN 9 THEN 'REO_DISPOSITION' WHEN 15 THEN 'WHOLE_LOAN_SALES'
  WHEN 16 THEN 'REPERFORMING_LOAN_SECURITIZATIONS' WHEN 96 THEN 'DEFECT_PRIOR_TO_TERMINATION' END"""


@register(
    "zbc_numeric_codes",
    query(
        sql.PERF_VALID,
        f"""SELECT {LOAN}, {MONTH}, COALESCE({_zbc_label}, 'NO_ZERO_BALANCE_CODE') AS ZERO_BALANCE_CODE,
  {flag(f'({_zbc_label}) IS NULL')} AS ZERO_BALANCE_CODE_IS_MISSING FROM perf_valid""",
    ),
)
def _(spark, sf_dir):
    pattern = _earlier("ZERO_BALANCE_CODE", EARLIER_PERFORMANCE_PATTERNS)
    return clean_columns(months(spark, sf_dir), [pattern]).select(
        LOAN, MONTH, "ZERO_BALANCE_CODE", "ZERO_BALANCE_CODE_IS_MISSING"
    )


@register(
    "clip_lower_one",
    query(
        sql.ORIG_LOANS,
        f"""SELECT {LOAN}, {sql.bounded('COALESCE(d, dm)', 1, 65, 'TINYINT')} AS ORIGINAL_DTI_RATIO,
  {sql.bounded('COALESCE(u, um)', 1, 3000000, 'INTEGER')} AS ORIGINAL_UPB
FROM (SELECT *, {sql.observed('ORIGINAL_DTI_RATIO', '= 999')} AS d, {sql.observed('ORIGINAL_UPB', '= 0')} AS u FROM orig_loans),
  (SELECT CAST(MEDIAN(CAST(d AS DOUBLE)) AS FLOAT) AS dm, CAST(MEDIAN(CAST(u AS DOUBLE)) AS FLOAT) AS um
   FROM (SELECT {sql.observed('ORIGINAL_DTI_RATIO', '= 999')} AS d, {sql.observed('ORIGINAL_UPB', '= 0')} AS u FROM orig_loans))""",
    ),
)
def _(spark, sf_dir):
    patterns = [_earlier("ORIGINAL_DTI_RATIO"), _earlier("ORIGINAL_UPB")]
    return clean_columns(loans(spark, sf_dir), patterns).select(
        LOAN, "ORIGINAL_DTI_RATIO", "ORIGINAL_UPB"
    )


@register(
    "key_trim",
    query(
        sql.ORIG_RAW,
        f"""SELECT {LOAN}, MIN(CREDIT_SCORE) AS CREDIT_SCORE
FROM (SELECT * REPLACE (TRIM({LOAN}) AS {LOAN}) FROM orig_raw) WHERE {LOAN} IS NOT NULL GROUP BY {LOAN}""",
    ),
)
def _(spark, sf_dir):
    padded = originations_raw(spark, sf_dir).withColumn(
        LOAN, F.when(F.col("CHANNEL") == "B", F.concat(F.lit(" "), LOAN)).otherwise(F.col(LOAN))
    )
    return validate_loans(padded, trim=True).select(LOAN, "CREDIT_SCORE")


@register(
    "free_text_null_missing",
    query(
        sql.ORIG_LOANS,
        f"SELECT {LOAN}, "
        + ", ".join(
            f"CASE WHEN {sql.text(c)} IS NULL OR {sql.text(c)} IN ('NAN', '') THEN '{unknown}' "
            f"ELSE {sql.text(c)} END AS {c}"
            for c, unknown in (
                ("SELLER_NAME", "UNKNOWN_SELLER"),
                ("SERVICER_NAME", "UNKNOWN_SERVICER"),
            )
        )
        + " FROM orig_loans",
    ),
)
def _(spark, sf_dir):
    patterns = [_earlier("SELLER_NAME"), _earlier("SERVICER_NAME")]
    return clean_columns(loans(spark, sf_dir), patterns).select(
        LOAN, "SELLER_NAME", "SERVICER_NAME"
    )


@register(
    "term_zero_missing",
    _imputed(
        sql.ORIG_LOANS,
        "orig_loans",
        "ORIGINAL_LOAN_TERM",
        sql.observed("ORIGINAL_LOAN_TERM", "= 0"),
        60,
        480,
        "SMALLINT",
        LOAN,
    ),
)
def _(spark, sf_dir):
    return clean_columns(loans(spark, sf_dir), [_earlier("ORIGINAL_LOAN_TERM")]).select(
        LOAN, "ORIGINAL_LOAN_TERM", "ORIGINAL_LOAN_TERM_IS_MISSING"
    )


@register(
    "postal_zero_missing",
    query(
        sql.ORIG_LOANS,
        f"""SELECT {LOAN}, COALESCE({sql.POSTAL}, 'POSTAL_CODE_UNKNOWN') AS POSTAL_CODE,
  {flag(f'({sql.POSTAL}) IS NULL')} AS POSTAL_CODE_IS_MISSING FROM orig_loans""",
    ),
)
def _(spark, sf_dir):
    return clean_columns(loans(spark, sf_dir), [_earlier("POSTAL_CODE")]).select(
        LOAN, "POSTAL_CODE", "POSTAL_CODE_IS_MISSING"
    )


def _filled(number, low, high, dtype):
    return sql.bounded(f"COALESCE({number}_n, {number}_m)", low, high, dtype)


def _earlier_numbers(numbers):
    """The observed numbers of a table, and their medians, as select lists."""
    observed = ", ".join(f"{sql.observed(c, m)} AS {c}_n" for c, (_, _, _, m) in numbers.items())
    medians = ", ".join(
        f"CAST(MEDIAN(CAST({c}_n AS DOUBLE)) AS FLOAT) AS {c}_m" for c in numbers
    )
    return observed, medians


# Type, bounds and sentinel of the older numbers.
EARLIER_NUMBERS = {
    "CREDIT_SCORE": ("SMALLINT", 300, 850, "= 9999"),
    "MI_PERCENT": ("TINYINT", 0, 55, "= 999"),
    "ORIGINAL_DTI_RATIO": ("TINYINT", 1, 65, "= 999"),
    "ORIGINAL_UPB": ("INTEGER", 1, 3000000, "= 0"),
    "ORIGINAL_INTEREST_RATE": ("FLOAT", 0.5, 20.0, "= 0"),
    "ORIGINAL_LOAN_TERM": ("SMALLINT", 60, 480, "= 0"),
}
EARLIER_RATIOS = {"ORIGINAL_LTV": (6, 105), "ORIGINAL_CLTV": (6, 200)}
_observed, _medians = _earlier_numbers(
    EARLIER_NUMBERS | {c: (None, None, None, "= 999") for c in EARLIER_RATIOS}
)
_before = "ORIGINATION_DATE <= DATE '2018-03-31'"
_earlier_values = [
    *(f"{_filled(c, low, high, t)} AS {c}" for c, (t, low, high, _) in EARLIER_NUMBERS.items()),
    *(f"{flag(f'{c}_n IS NULL')} AS {c}_IS_MISSING" for c in (*EARLIER_NUMBERS, *EARLIER_RATIOS)),
    *(
        f"CASE WHEN {_before} THEN {_filled(c, low, high, 'SMALLINT')} "
        f"ELSE {_filled(c, 1, 998, 'SMALLINT')} END AS {c}"
        for c, (low, high) in EARLIER_RATIOS.items()
    ),
    *(
        f"{flag(f"{sql.text(c)} IN ('Y', '1')")} AS {c}"
        for c in ("FIRST_TIME_HOMEBUYER_FLAG", "PPM_FLAG", "SUPER_CONFORMING_FLAG", "IO_INDICATOR", "RELIEF_REFI_INDICATOR")
    ),
    f"""{flag(f"COALESCE({sql.text('PPM_FLAG')}, '') NOT IN ('Y', 'N', '1', '0')")} AS PPM_FLAG_IS_MISSING""",
    *(part for pair in EARLIER_CATEGORIES.values() for part in pair),
    f"{flag(f"{sql.text('MI_CANCEL_INDICATOR')} = '7'")} AS MI_CANCEL_INDICATOR_NOT_APPLICABLE",
    f"{flag(f"{sql.text('MI_CANCEL_INDICATOR')} = '9'")} AS MI_CANCEL_INDICATOR_NOT_DISCLOSED",
    f"""CASE WHEN {_msa} IS NULL OR {_msa} = 'NAN' THEN 'NON_MSA_OR_UNKNOWN'
  ELSE COALESCE({sql.WHOLE_MSA}, 'OTHER_INVALID_CODE') END AS MSA_OR_MET_DIV""",
    f"{flag(f"{_msa} IS NULL OR {_msa} = 'NAN'")} AS MSA_OR_MET_DIV_IS_MISSING",
    f"COALESCE({sql.POSTAL}, 'POSTAL_CODE_UNKNOWN') AS POSTAL_CODE",
    f"{flag(f'({sql.POSTAL}) IS NULL')} AS POSTAL_CODE_IS_MISSING",
    f"COALESCE({sql.BORROWERS}, 'NUM_BORROWERS_UNKNOWN') AS NUMBER_OF_BORROWERS",
    f"{flag(f'({sql.BORROWERS}) IS NULL')} AS NUMBER_OF_BORROWERS_IS_MISSING",
    *(
        f"COALESCE({sql.month(c)}, {_mode(c, 'orig_loans')}) AS {c}, "
        f"{flag(f'{sql.month(c)} IS NULL')} AS {c}_IS_MISSING"
        for c in ("FIRST_PAYMENT_DATE", "MATURITY_DATE")
    ),
    *(
        f"CASE WHEN COALESCE({sql.text(c)}, '') IN ('NAN', '') THEN '{unknown}' ELSE {sql.text(c)} END AS {c}, "
        f"{flag(f"COALESCE({sql.text(c)}, '') IN ('NAN', '')")} AS {c}_IS_MISSING"
        for c, unknown in (("SELLER_NAME", "UNKNOWN_SELLER"), ("SERVICER_NAME", "UNKNOWN_SERVICER"))
    ),
]


@register(
    "clean_originations_earlier",
    query(
        f"""{sql.ORIG_LOANS},
earlier AS (SELECT *, {sql.BORROWER_TEXT} AS borrowers, {_observed} FROM orig_dated),
fitted AS (SELECT {_medians} FROM earlier)""",
        f"SELECT {LOAN}, ORIGINATION_DATE, {', '.join(_earlier_values)} FROM earlier, fitted",
    ),
)
def _(spark, sf_dir):
    return clean_originations(originations_raw(spark, sf_dir), EARLIER_ORIGINATION_PATTERNS)


EARLIER_PERFORMANCE_NUMBERS = {
    "CURRENT_ACTUAL_UPB": ("INTEGER", 0, 3000000, None),
    "LOAN_AGE": ("SMALLINT", 0, 600, "< 0"),
    "CURRENT_INTEREST_RATE": ("FLOAT", 0.5, 20.0, "= 0"),
    "CURRENT_NON_INTEREST_BEARING_UPB": ("INTEGER", 0, 3000000, None),
}
_observed, _medians = _earlier_numbers(EARLIER_PERFORMANCE_NUMBERS)
_zbe = sql.month("ZERO_BALANCE_EFFECT_DATE")
_earlier_months = [
    *(
        f"{_filled(c, low, high, t)} AS {c}, {flag(f'{c}_n IS NULL')} AS {c}_IS_MISSING"
        for c, (t, low, high, _) in EARLIER_PERFORMANCE_NUMBERS.items()
    ),
    f"{sql.bounded('COALESCE(status, TRUNC(status_m))', 0, 18, 'TINYINT')} AS CURRENT_DELINQUENCY_STATUS",
    f"{flag(f"{sql.STATUS_TEXT} = 'RA'")} AS CURRENT_DELINQUENCY_STATUS_IS_RA",
    f"{flag(f"status IS NULL AND COALESCE({sql.STATUS_TEXT}, '') <> 'RA'")} AS CURRENT_DELINQUENCY_STATUS_IS_MISSING",
    f"COALESCE({_zbe}, {_mode('ZERO_BALANCE_EFFECT_DATE', 'perf_valid')}) AS ZERO_BALANCE_EFFECT_DATE",
    f"{flag(f'{_zbe} IS NULL')} AS ZERO_BALANCE_EFFECT_DATE_IS_MISSING",
    f"COALESCE({_zbc_label}, 'NO_ZERO_BALANCE_CODE') AS ZERO_BALANCE_CODE",
    f"{flag(f'({_zbc_label}) IS NULL')} AS ZERO_BALANCE_CODE_IS_MISSING",
    *(part for c, codes, unknown in (
        ("MOD_FLAG", ("Y", "P"), "NOT_MODIFIED"),
        ("STEP_MOD_FLAG", ("Y", "N"), "NOT_MODIFIED_IN_PERIOD"),
        ("PAYMENT_DEFERRAL_FLAG", ("Y", "P"), "NOT_PAYMENT_DEFERRAL"),
    ) for part in _coded(c, codes, unknown)),
]


@register(
    "clean_performance_earlier",
    query(
        f"""{sql.PERF_VALID},
earlier AS (SELECT *, {sql.STATUS_NUMBER} AS status, {_observed} FROM perf_valid),
fitted AS (SELECT {_medians}, MEDIAN(CAST(status AS DOUBLE)) AS status_m FROM earlier)""",
        f"SELECT {LOAN}, {MONTH}, {', '.join(_earlier_months)} FROM earlier, fitted",
    ),
)
def _(spark, sf_dir):
    raw = performance_raw(spark, sf_dir, read_twice=True)
    df = clean_performance(raw, EARLIER_PERFORMANCE_PATTERNS)
    uncleaned = ("ELTV", "DDLPI", "CUMULATIVE_MOD_COST", "CURRENT_MONTH_MOD_COST", "DELINQUENT_ACCRUED_INTEREST")
    others = ("DELINQUENCY_DUE_TO_DISASTER", "BORROWER_ASSISTANCE_STATUS_CODE")
    return df.drop(*uncleaned, *others)
