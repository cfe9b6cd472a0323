"""DuckDB SQL that states independently what each registered query must return.

Every statement is one chain of CTEs over the given tables, from the derived raw
tables to the result. The parameters are written out again here on purpose.
"""

from checks.inputs import (
    FIRST_MONTH,
    ORIGINATIONS_RAW,
    ORIGINATIONS_TWICE,
    PERFORMANCE_RAW,
    PERFORMANCE_TWICE,
)

LOAN = "LOAN_SEQUENCE_NUMBER"
MONTH = "MONTHLY_REPORTING_PERIOD"
SPLIT = "DATE '2018-03-31'"

# --- raw tables -------------------------------------------------------------


def _select(expressions):
    return ",\n  ".join(f"CAST({e} AS VARCHAR) AS {name}" for name, e in expressions.items())


PERF_RAW = f"""
placed AS (
  SELECT o_custkey AS ck, o_orderkey AS ok,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders),
placed_twice AS (
  SELECT *, {FIRST_MONTH} AS m0, 1 AS copy FROM placed
  UNION ALL SELECT *, {FIRST_MONTH} AS m0, 2 AS copy FROM placed WHERE {PERFORMANCE_TWICE}),
perf_raw AS (SELECT {_select(PERFORMANCE_RAW)}
  FROM placed_twice)"""

ORIG_RAW = f"""
people AS (
  SELECT c_custkey AS ck, c_mktsegment, 1 AS copy FROM customer
  UNION ALL SELECT c_custkey, c_mktsegment, 2 AS copy FROM customer
  WHERE {ORIGINATIONS_TWICE.replace('ck', 'c_custkey')}),
orig_raw AS (SELECT {_select(ORIGINATIONS_RAW)}
  FROM people)"""

# --- cleaning patterns ------------------------------------------------------


def text(column):
    return f"UPPER(TRIM({column}))"


def flag(condition):
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS TINYINT)"


def observed(column, missing=None):
    number = f"TRY_CAST({column} AS FLOAT)"
    number = f"CASE WHEN isnan({number}) THEN NULL ELSE {number} END"
    return number if missing is None else f"CASE WHEN {number} {missing} THEN NULL ELSE {number} END"


def month(column):
    return f"CAST(TRY_STRPTIME({column}, '%Y%m') AS DATE)"


def bounded(value, low, high, dtype):
    clipped = f"CASE WHEN {value} < {low} THEN {low} WHEN {value} > {high} THEN {high} ELSE {value} END"
    return f"CAST({clipped} AS FLOAT)" if dtype == "FLOAT" else f"CAST(TRUNC({clipped}) AS {dtype})"


def mapped(value, pairs):
    labels = {label: label for label in pairs.values()} | pairs
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {value} {whens} END"


def median(column, where="TRUE"):
    return f"CAST(MEDIAN(CASE WHEN {where} THEN CAST({column} AS DOUBLE) END) AS FLOAT) AS {column}"


def category(column, pairs, unknown, suffix=""):
    value = mapped(text(column), pairs)
    return f"COALESCE({value}, '{unknown}') AS {column}{suffix}"


# --- originations -----------------------------------------------------------

# column: (type, low, high, missing when)
ORIG_NUMBERS = {
    "CREDIT_SCORE": ("SMALLINT", 300, 850, "= 9999"),
    "MI_PERCENT": ("TINYINT", 0, 55, "= 999"),
    "ORIGINAL_DTI_RATIO": ("TINYINT", 0, 65, "= 999"),
    "ORIGINAL_UPB": ("INTEGER", 0, 3000000, "= 0"),
    "ORIGINAL_INTEREST_RATE": ("FLOAT", 0.5, 20.0, "= 0"),
}
ORIG_RATIOS = {"ORIGINAL_LTV": (6, 105), "ORIGINAL_CLTV": (6, 200)}
ORIG_FLAGS = {
    "FIRST_TIME_HOMEBUYER_FLAG": "('Y', '1')",
    "PPM_FLAG": "('Y', '1')",
    "SUPER_CONFORMING_FLAG": "('Y', '1')",
    "IO_INDICATOR": "('Y', '1')",
    "RELIEF_REFI_INDICATOR": "('Y', '1')",
}
# The states and territories.
# fmt: off
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "HI", "ID", "IL", "IN", "IA",
    "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM",
    "NY", "NC", "ND", "OH", "OK", "OR", "PA", "PR", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA",
    "VI", "WA", "WV", "WI", "WY", "AS", "FM", "GU", "MH", "MP", "PW",
)
# fmt: on
ORIG_CATEGORIES = {
    "NUMBER_OF_UNITS": ({"1": "1", "2": "2", "3": "3", "4": "4"}, "NUM_UNITS_UNKNOWN"),
    "OCCUPANCY_STATUS": (
        {"P": "PRIMARY_RESIDENCE", "I": "INVESTMENT_PROPERTY", "S": "SECONDARY_HOME"},
        "OCCUPANCY_STATUS_UNKNOWN",
    ),
    "CHANNEL": (
        {"R": "RETAIL", "B": "BROKER", "C": "CORRESPONDENT", "T": "TPO_NOT_SPECIFIED"},
        "CHANNEL_UNKNOWN",
    ),
    "AMORTIZATION_TYPE": (
        {"FRM": "FIXED_RATE", "ARM": "ADJUSTABLE_RATE"},
        "AMORTIZATION_TYPE_UNKNOWN",
    ),
    "PROPERTY_STATE": ({s: s for s in STATES}, "PROPERTY_STATE_UNKNOWN"),
    "PROPERTY_TYPE": (
        {
            "CO": "CONDO",
            "PU": "PUD",
            "MH": "MANUFACTURED_HOUSING",
            "SF": "SINGLE_FAMILY",
            "CP": "CO-OP",
        },
        "PROPERTY_TYPE_UNKNOWN",
    ),
    "LOAN_PURPOSE": (
        {
            "P": "PURCHASE",
            "C": "REFINANCE_CASH_OUT",
            "N": "REFINANCE_NO_CASH_OUT",
            "R": "REFINANCE_NOT_SPECIFIED",
        },
        "LOAN_PURPOSE_UNKNOWN",
    ),
    "PROGRAM_INDICATOR": (
        {"H": "HOME_POSSIBLE", "F": "HFA_ADVANTAGE", "R": "REFI_POSSIBLE"},
        "PROGRAM_INDICATOR_UNKNOWN",
    ),
    "PROP_VALUATION_METHOD": (
        {"1": "ACE_LOANS", "2": "FULL_APPRAISAL", "3": "OTHER_APPRAISALS", "4": "ACE_PDR"},
        "PROP_VALUATION_METHOD_UNKNOWN",
    ),
    "MI_CANCEL_INDICATOR": (
        {"Y": "CANCELLED", "N": "NOT_CANCELLED", "7": "NOT_APPLICABLE", "9": "NOT_DISCLOSED"},
        "MI_CANCEL_INDICATOR_UNKNOWN",
    ),
}
FREE_TEXT = ("SELLER_NAME", "SERVICER_NAME")

WHOLE_MSA = f"CAST(TRY_CAST(TRUNC(TRY_CAST({text('MSA_OR_MET_DIV')} AS DOUBLE)) AS BIGINT) AS VARCHAR)"
POSTAL_NUMBER = "CAST(TRUNC(TRY_CAST(TRIM(POSTAL_CODE) AS DOUBLE)) AS BIGINT)"
POSTAL = (
    f"CASE WHEN {POSTAL_NUMBER} % 100 = 0 AND {POSTAL_NUMBER} BETWEEN 100 AND 99900 "
    f"THEN LPAD(CAST({POSTAL_NUMBER} AS VARCHAR), 5, '0') END"
)
BORROWER_NUMBER = "TRY_CAST(TRIM(NUMBER_OF_BORROWERS) AS DOUBLE)"
BORROWER_TEXT = (
    f"CASE WHEN {BORROWER_NUMBER} <> 99 AND NOT isnan({BORROWER_NUMBER}) "
    f"THEN CAST(CAST(TRUNC({BORROWER_NUMBER}) AS BIGINT) AS VARCHAR) END"
)
BORROWERS = (
    f"CASE WHEN ORIGINATION_DATE <= {SPLIT} THEN "
    + mapped("borrowers", {"1": "1_BORROWER", "2": ">1_BORROWERS_OLD_RULE"})
    + " ELSE "
    + mapped("borrowers", {str(i): str(i) for i in range(1, 11)})
    + " END"
)

QUARTER = (
    f"CASE WHEN LENGTH({LOAN}) >= 5 AND regexp_full_match(SUBSTRING({LOAN}, 2, 2), '[0-9]{{2}}') "
    f"AND regexp_full_match(SUBSTRING({LOAN}, 5, 1), '[1-4]') THEN MAKE_DATE("
    f"CASE WHEN SUBSTRING({LOAN}, 2, 2) = '99' THEN 1999 ELSE 2000 + CAST(SUBSTRING({LOAN}, 2, 2) AS BIGINT) END, "
    f"(CAST(SUBSTRING({LOAN}, 5, 1) AS BIGINT) - 1) * 3 + 1, 1) END"
)

ORIG_LOANS = f"""{ORIG_RAW},
orig_loans AS (
  SELECT * EXCLUDE (pick) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {LOAN} ORDER BY
      {', '.join(f'{c} NULLS FIRST' for c in ORIGINATIONS_RAW if c != LOAN)}) AS pick
    FROM orig_raw WHERE {LOAN} IS NOT NULL)
  WHERE pick = 1),
orig_dated AS (
  SELECT * EXCLUDE (quarter),
    COALESCE(quarter, (SELECT quarter FROM (SELECT {QUARTER} AS quarter FROM orig_loans)
      WHERE quarter IS NOT NULL GROUP BY quarter ORDER BY COUNT(*) DESC, quarter LIMIT 1),
      DATE '2000-01-01') AS ORIGINATION_DATE
  FROM (SELECT *, {QUARTER} AS quarter FROM orig_loans))"""

_orig_observed = [
    f"{observed(c, missing)} AS {c}_n" for c, (_, _, _, missing) in ORIG_NUMBERS.items()
] + [f"{observed(c, '= 999')} AS {c}_n" for c in ORIG_RATIOS]

_orig_values = (
    [
        f"{bounded(f'COALESCE({c}_n, {c}_m)', low, high, t)} AS {c}"
        for c, (t, low, high, _) in ORIG_NUMBERS.items()
    ]
    + [
        f"CASE WHEN ORIGINATION_DATE <= {SPLIT} "
        f"THEN {bounded(f'COALESCE({c}_n, {c}_m)', low, high, 'SMALLINT')} "
        f"ELSE {bounded(f'COALESCE({c}_n, {c}_m)', 1, 998, 'SMALLINT')} END AS {c}"
        for c, (low, high) in ORIG_RATIOS.items()
    ]
    + [f"{flag(f'{text(c)} IN {yes}')} AS {c}" for c, yes in ORIG_FLAGS.items()]
    + [category(c, pairs, unknown) for c, (pairs, unknown) in ORIG_CATEGORIES.items()]
    + [f"{month(c)} AS {c}" for c in ("FIRST_PAYMENT_DATE", "MATURITY_DATE")]
    + [
        f"CASE WHEN {text(c)} IS NULL OR {text(c)} IN ('NAN', '') THEN '{c}_UNKNOWN' ELSE {text(c)} END AS {c}"
        for c in FREE_TEXT
    ]
    + [f"COALESCE({WHOLE_MSA}, 'NON_MSA_OR_UNKNOWN') AS MSA_OR_MET_DIV"]
    + [f"COALESCE({POSTAL}, 'UNKNOWN_POSTAL_CODE') AS POSTAL_CODE"]
    + [f"{bounded('COALESCE(term_n, term_m)', 60, 480, 'INTEGER')} AS ORIGINAL_LOAN_TERM"]
    + [f"COALESCE({BORROWERS}, 'UNKNOWN_NUM_BORROWERS') AS NUMBER_OF_BORROWERS"]
)
_orig_extras = (
    [f"{flag(f'{c}_n IS NULL')} AS {c}_IS_MISSING" for c in (*ORIG_NUMBERS, *ORIG_RATIOS)]
    + [f"{flag(f'{month(c)} IS NULL')} AS {c}_IS_MISSING" for c in ("FIRST_PAYMENT_DATE", "MATURITY_DATE")]
    + [
        f"{flag(f'''{text(c)} IS NULL OR {text(c)} IN ('NAN', '')''')} AS {c}_IS_MISSING"
        for c in FREE_TEXT
    ]
    + [f"{flag(f'{WHOLE_MSA} IS NULL')} AS MSA_OR_MET_DIV_IS_MISSING"]
    + [f"{flag(f'{POSTAL} IS NULL')} AS POSTAL_CODE_IS_MISSING"]
    + [f"{flag('term_n IS NULL')} AS ORIGINAL_LOAN_TERM_IS_MISSING"]
    + [f"{flag(f'{BORROWERS} IS NULL')} AS NUMBER_OF_BORROWERS_IS_MISSING"]
    + [
        f"{flag(f'''{text('MI_CANCEL_INDICATOR')} = '7' ''')} AS MI_CANCEL_INDICATOR_NOT_APPLICABLE",
        f"{flag(f'''{text('MI_CANCEL_INDICATOR')} = '9' ''')} AS MI_CANCEL_INDICATOR_NOT_DISCLOSED",
    ]
)

# orig_all: every loan cleaned; orig_clean: loans whose two dates are readable.
ORIG_CLEAN = f"""{ORIG_LOANS},
orig_observed AS (
  SELECT *, {', '.join(_orig_observed)},
    {observed('ORIGINAL_LOAN_TERM', '<= 0')} AS term_n,
    {BORROWER_TEXT} AS borrowers,
    {month('FIRST_PAYMENT_DATE')} IS NOT NULL AND {month('MATURITY_DATE')} IS NOT NULL AS dated
  FROM orig_dated),
orig_medians AS (
  SELECT {', '.join(f'CAST(MEDIAN(CAST({c}_n AS DOUBLE)) AS FLOAT) AS {c}_m' for c in (*ORIG_NUMBERS, *ORIG_RATIOS))},
    CAST(MEDIAN(CASE WHEN dated THEN CAST(term_n AS DOUBLE) END) AS FLOAT) AS term_m
  FROM orig_observed),
orig_all AS (
  SELECT {LOAN}, ORIGINATION_DATE, dated, {', '.join(_orig_values + _orig_extras)}
  FROM orig_observed, orig_medians),
orig_clean AS (SELECT * EXCLUDE (dated) FROM orig_all WHERE dated)"""

# --- performance ------------------------------------------------------------

PERF_NUMBERS = {
    "CURRENT_ACTUAL_UPB": ("INTEGER", 0, 3000000, None),
    "LOAN_AGE": ("SMALLINT", 0, 600, None),
    "CURRENT_INTEREST_RATE": ("FLOAT", 0.5, 20.0, "= 0"),
    "CURRENT_NON_INTEREST_BEARING_UPB": ("INTEGER", 0, 3000000, None),
    "ELTV": ("SMALLINT", 1, 200, "= 999"),
}
ZERO_BALANCE = {
    "01": "PREPAID_OR_MATURED",
    "02": "THIRD_PARTY_SALE",
    "03": "SHORT_SALE_OR_CHARGE_OFF",
    "09": "REO_DISPOSITION",
    "15": "WHOLE_LOAN_SALE",
    "16": "REPERFORMING_LOAN_SECURITIZATION",
    "96": "DEFECT_PRIOR_TO_OTHER_EVENT",
}
PERF_CATEGORIES = {
    "MOD_FLAG": ({"Y": "CURRENT_PERIOD_MOD", "P": "PRIOR_PERIOD_MOD"}, "NOT_MODIFIED"),
    "ZERO_BALANCE_CODE": (ZERO_BALANCE, "NO_ZERO_BALANCE_CODE"),
    "STEP_MOD_FLAG": ({"Y": "STEP_MOD", "N": "NON_STEP_MOD"}, "LOAN_NOT_MODIFIED"),
    "PAYMENT_DEFERRAL_FLAG": ({"Y": "CURRENT_PERIOD", "P": "PRIOR_PERIOD"}, "NOT_PAYMENT_DEFERRAL"),
    "BORROWER_ASSISTANCE_STATUS_CODE": (
        {"F": "FORBEARANCE", "R": "REPAYMENT", "T": "TRIAL_PERIOD"},
        "NO_BORR_ASSIST_CODE",
    ),
}
COSTS = {
    "CUMULATIVE_MOD_COST": "CUMULATIVE_MOD_COST_IS_MODIFIED",
    "DELINQUENT_ACCRUED_INTEREST": "HAS_DELINQUENT_INTEREST",
    "CURRENT_MONTH_MOD_COST": "CURRENT_MONTH_IS_MODIFIED",
}
STATUS_TEXT = text("CURRENT_DELINQUENCY_STATUS")
STATUS_NUMBER = (
    f"CASE WHEN regexp_full_match({STATUS_TEXT}, '[+-]?[0-9]+') THEN TRY_CAST({STATUS_TEXT} AS INTEGER) END"
)
ZBE_TEXT = "CASE WHEN TRIM(ZERO_BALANCE_EFFECT_DATE) <> '' THEN ZERO_BALANCE_EFFECT_DATE END"
DDLPI_TEXT = f"CASE WHEN {text('DDLPI')} <> '' THEN {text('DDLPI')} END"

PERF_VALID = f"""{PERF_RAW},
perf_valid AS (
  SELECT * REPLACE ({month(f'TRIM({MONTH})')} AS {MONTH})
    RENAME (INTEREST_RATE_STEP_INDICATOR AS STEP_MOD_FLAG)
  FROM perf_raw WHERE {LOAN} IS NOT NULL AND {month(f'TRIM({MONTH})')} IS NOT NULL)"""

_perf_values = (
    [
        f"{bounded(f'COALESCE({c}_n, {c}_m)', low, high, t)} AS {c}"
        for c, (t, low, high, _) in PERF_NUMBERS.items()
    ]
    + [f"{flag(f'''{text('DELINQUENCY_DUE_TO_DISASTER')} IN ('Y', '1')''')} AS DELINQUENCY_DUE_TO_DISASTER"]
    + [category(c, pairs, unknown) for c, (pairs, unknown) in PERF_CATEGORIES.items()]
    + [
        f"CAST(CASE WHEN {observed(c)} > 0 THEN {observed(c)} ELSE 0 END AS FLOAT) AS {c}"
        for c in COSTS
    ]
    + [
        f"{month(ZBE_TEXT)} AS ZERO_BALANCE_EFFECT_DATE",
        f"{month(DDLPI_TEXT)} AS DDLPI",
        f"CAST(LEAST(GREATEST(COALESCE({STATUS_NUMBER}, 0), 0), 18) AS TINYINT) AS CURRENT_DELINQUENCY_STATUS",
    ]
)
_perf_extras = (
    [f"{flag(f'{c}_n IS NULL')} AS {c}_IS_MISSING" for c in PERF_NUMBERS]
    + [f"{flag(f'''{MONTH} < DATE '2014-01-01' ''')} AS DISASTER_FLAG_MISSING"]
    + [f"{flag(f'{observed(c)} > 0')} AS {name}" for c, name in COSTS.items()]
    + [
        f"{flag(f'({ZBE_TEXT}) IS NULL')} AS ZERO_BALANCE_EFFECT_DATE_IS_MISSING",
        f"{flag(f'({DDLPI_TEXT}) IS NULL')} AS DDLPI_IS_MISSING",
        f"{flag(f'''{STATUS_TEXT} = 'RA' ''')} AS CURRENT_DELINQUENCY_STATUS_IS_RA",
        flag(
            f"({STATUS_NUMBER}) IS NULL AND ({STATUS_TEXT} IS NULL OR {STATUS_TEXT} <> 'RA')"
        )
        + " AS CURRENT_DELINQUENCY_STATUS_IS_MISSING",
    ]
)

PERF_CLEAN = f"""{PERF_VALID},
perf_observed AS (
  SELECT *, {', '.join(f'{observed(c, m)} AS {c}_n' for c, (_, _, _, m) in PERF_NUMBERS.items())}
  FROM perf_valid),
perf_medians AS (
  SELECT {', '.join(f'CAST(MEDIAN(CAST({c}_n AS DOUBLE)) AS FLOAT) AS {c}_m' for c in PERF_NUMBERS)}
  FROM perf_observed),
perf_clean AS MATERIALIZED (
  SELECT {LOAN}, {MONTH}, {', '.join(_perf_values + _perf_extras)}
  FROM perf_observed, perf_medians)"""

PERF_COLUMNS = (
    [c.split(" AS ")[-1] for c in _perf_values] + [c.split(" AS ")[-1] for c in _perf_extras]
)

# --- panel rules ------------------------------------------------------------

DEDUP = f"""{PERF_CLEAN},
panel AS MATERIALIZED (
  SELECT * EXCLUDE (pick) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {LOAN}, {MONTH} ORDER BY
      {', '.join(f'{c} NULLS FIRST' for c in PERF_COLUMNS)}) AS pick FROM perf_clean)
  WHERE pick = 1)"""

TERMINATED = f"""{DEDUP},
terminations AS (
  SELECT {LOAN}, MIN({MONTH}) AS TERMINATION_MONTH FROM panel
  WHERE ZERO_BALANCE_CODE <> 'NO_ZERO_BALANCE_CODE' GROUP BY {LOAN}),
history AS MATERIALIZED (
  SELECT panel.* FROM panel LEFT JOIN terminations USING ({LOAN})
  WHERE TERMINATION_MONTH IS NULL OR {MONTH} <= TERMINATION_MONTH)"""

LAGS = f"""{TERMINATED},
lagged AS (
  SELECT *, LAG(CURRENT_DELINQUENCY_STATUS) OVER w AS PREV_STATUS,
    LAG(CURRENT_ACTUAL_UPB) OVER w AS PREV_UPB,
    LAG(CURRENT_NON_INTEREST_BEARING_UPB) OVER w AS PREV_NIB
  FROM history WINDOW w AS (PARTITION BY {LOAN} ORDER BY {MONTH})),
bad_status AS (
  SELECT DISTINCT {LOAN} FROM lagged
  WHERE CAST(CURRENT_DELINQUENCY_STATUS AS INTEGER) - CAST(PREV_STATUS AS INTEGER) > 1),
bad_upb AS (
  SELECT DISTINCT {LOAN} FROM lagged
  WHERE CURRENT_ACTUAL_UPB > PREV_UPB + 1000 AND MOD_FLAG = 'NOT_MODIFIED'
    AND PAYMENT_DEFERRAL_FLAG = 'NOT_PAYMENT_DEFERRAL' AND STEP_MOD_FLAG = 'LOAN_NOT_MODIFIED'
    AND BORROWER_ASSISTANCE_STATUS_CODE = 'NO_BORR_ASSIST_CODE'
    AND DELINQUENCY_DUE_TO_DISASTER <> 1
    AND CURRENT_NON_INTEREST_BEARING_UPB <= COALESCE(PREV_NIB, 0) + 100),
bad_missing AS (
  SELECT DISTINCT {LOAN} FROM history
  WHERE CURRENT_ACTUAL_UPB_IS_MISSING = 1 AND ZERO_BALANCE_CODE = 'NO_ZERO_BALANCE_CODE'),
bad_loans AS (
  SELECT {LOAN} FROM bad_status UNION SELECT {LOAN} FROM bad_upb UNION SELECT {LOAN} FROM bad_missing),
kept AS MATERIALIZED (SELECT * FROM history WHERE {LOAN} NOT IN (SELECT {LOAN} FROM bad_loans))"""

# --- default, labels and features -------------------------------------------

BAD_EXITS = "('THIRD_PARTY_SALE', 'SHORT_SALE_OR_CHARGE_OFF', 'REO_DISPOSITION', 'WHOLE_LOAN_SALE')"
GAP = f"CAST(DATEDIFF('month', DDLPI, {MONTH}) AS DOUBLE)"
EXIT = f"""CASE WHEN ZERO_BALANCE_CODE IN {BAD_EXITS} THEN 'Default'
    WHEN ZERO_BALANCE_CODE = 'PREPAID_OR_MATURED' THEN 'Prepaid'
    WHEN ZERO_BALANCE_CODE IN ('REPERFORMING_LOAN_SECURITIZATION', 'DEFECT_PRIOR_TO_OTHER_EVENT')
      THEN 'Repurchased' ELSE 'Active' END"""

DEFAULTED = f"""{LAGS},
starts AS (SELECT {LOAN}, MIN({MONTH}) AS START_DATE FROM kept GROUP BY {LOAN}),
flagged AS MATERIALIZED (
  SELECT kept.*, {GAP} AS GAP,
    {flag(f"CURRENT_DELINQUENCY_STATUS >= 3 OR CURRENT_DELINQUENCY_STATUS_IS_RA = 1 OR ZERO_BALANCE_CODE IN {BAD_EXITS} OR {GAP} >= 3")} AS IS_IN_DEFAULT,
    START_DATE, CAST(DATEDIFF('month', START_DATE, {MONTH}) AS INTEGER) AS CHRONO_AGE,
    {EXIT} AS EXIT_CATEGORY
  FROM kept JOIN starts USING ({LOAN})),
first_defaults AS (
  SELECT {LOAN}, MIN({MONTH}) AS FIRST_DEFAULT FROM flagged WHERE IS_IN_DEFAULT = 1 GROUP BY {LOAN}),
observed_rows AS MATERIALIZED (
  SELECT flagged.*, FIRST_DEFAULT FROM flagged LEFT JOIN first_defaults USING ({LOAN})
  WHERE {MONTH} <= (SELECT MAX({MONTH}) FROM kept) - INTERVAL 6 MONTH
    AND (FIRST_DEFAULT IS NULL OR {MONTH} < FIRST_DEFAULT)),
labels AS (
  SELECT {LOAN},
    MAX(LOOKAHEAD) AS LABEL_DEFAULT_6MO,
    MAX(IS_IN_DEFAULT) AS LABEL_EVER_DEFAULTED,
    CAST(SUM(IS_IN_DEFAULT) AS BIGINT) AS TOTAL_MONTHS_IN_DEFAULT,
    MIN(CASE WHEN IS_IN_DEFAULT = 1 THEN CHRONO_AGE END) AS AGE_AT_FIRST_DEFAULT,
    LAST(IS_IN_DEFAULT ORDER BY {MONTH}) AS IS_TERMINAL_DEFAULT,
    LAST(ZERO_BALANCE_CODE ORDER BY {MONTH}) AS ACTUAL_TERMINAL_ZBC,
    LAST(EXIT_CATEGORY ORDER BY {MONTH}) AS ACTUAL_EXIT_CATEGORY,
    MAX(DELINQUENT_ACCRUED_INTEREST) AS TOTAL_ACTUAL_LOSS_AMOUNT,
    MAX(HAS_DELINQUENT_INTEREST) AS WAS_CREDIT_LOSS_EVENT,
    LAST(DELINQUENCY_DUE_TO_DISASTER ORDER BY {MONTH}) AS FINAL_EXIT_WAS_DISASTER_RELATED
  FROM (SELECT *, MAX(IS_IN_DEFAULT) OVER (PARTITION BY {LOAN} ORDER BY {MONTH}
      ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS LOOKAHEAD FROM flagged)
  GROUP BY {LOAN})"""

DQ = "CASE WHEN CURRENT_DELINQUENCY_STATUS_IS_RA = 1 THEN 18 ELSE CAST(CURRENT_DELINQUENCY_STATUS AS INTEGER) END"


def first(column):
    return f"FIRST({column} ORDER BY {MONTH})"


def last(column):
    return f"LAST({column} ORDER BY {MONTH})"


def last_known(column):
    return f"ARG_MAX({column}, {MONTH})"


def any_month(condition):
    return f"CAST(MAX(CASE WHEN {condition} THEN 1 ELSE 0 END) AS INTEGER)"


def months_with(condition):
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def last_is(condition):
    return f"CAST({last(f'CASE WHEN {condition} THEN 1 ELSE 0 END')} AS INTEGER)"


def deviation(value):
    return f"ROUND(COALESCE(STDDEV_SAMP(CAST({value} AS DOUBLE)), 0), 6)"


FEATURES = {
    "LAST_MONTHLY_REPORTING_PERIOD": f"MAX({MONTH})",
    "FIRST_MONTHLY_REPORTING_PERIOD": f"MIN({MONTH})",
    "PERFORMANCE_MONTHS_OBSERVED": f"COUNT({MONTH})",
    "INITIAL_ACTUAL_UPB": first("CURRENT_ACTUAL_UPB"),
    "FINAL_NON_ZERO_UPB": last_known("CASE WHEN CURRENT_ACTUAL_UPB > 0 THEN CURRENT_ACTUAL_UPB END"),
    "MAX_ACTUAL_UPB": "MAX(CURRENT_ACTUAL_UPB)",
    "LAST_ACTUAL_UPB": last("CURRENT_ACTUAL_UPB"),
    "MAX_DELINQUENCY_STATUS": f"MAX({DQ})",
    "NUMBER_OF_LATE_MONTHS": months_with(f"{DQ} > 0"),
    "TERMINAL_DELINQ_STATUS": last(DQ),
    "DELINQUENCY_STATUS_STDDEV": deviation(DQ),
    "EVER_RA": "MAX(CURRENT_DELINQUENCY_STATUS_IS_RA)",
    "DELINQUENCY_STATUS_EVER_MISSING": "MAX(CURRENT_DELINQUENCY_STATUS_IS_MISSING)",
    "INITIAL_LOAN_AGE": first("LOAN_AGE"),
    "FINAL_LOAN_AGE": last("LOAN_AGE"),
    "MAX_LOAN_AGE": "MAX(LOAN_AGE)",
    "MIN_LOAN_AGE": "MIN(LOAN_AGE)",
    "LOAN_AGE_EVER_MISSING": "MAX(LOAN_AGE_IS_MISSING)",
    "EVER_MODIFIED": any_month("MOD_FLAG <> 'NOT_MODIFIED'"),
    "NUMBER_OF_MODIFICATIONS": months_with("MOD_FLAG = 'CURRENT_PERIOD_MOD'"),
    "PRE_DEFAULT_ZBC": last("ZERO_BALANCE_CODE"),
    "IS_ACTIVE_AT_SNAPSHOT": last_is("ZERO_BALANCE_CODE = 'NO_ZERO_BALANCE_CODE'"),
    "LAST_ZBE_DATE": last_known("ZERO_BALANCE_EFFECT_DATE"),
    "INITIAL_INTEREST_RATE": first("CURRENT_INTEREST_RATE"),
    "LAST_INTEREST_RATE": last("CURRENT_INTEREST_RATE"),
    "MAX_INTEREST_RATE": "MAX(CURRENT_INTEREST_RATE)",
    "MIN_INTEREST_RATE": "MIN(CURRENT_INTEREST_RATE)",
    "INTEREST_RATE_STDDEV": deviation("CURRENT_INTEREST_RATE"),
    "INTEREST_RATE_EVER_MISSING": "MAX(CURRENT_INTEREST_RATE_IS_MISSING)",
    "EVER_HAD_NIB_UPB": any_month("CURRENT_NON_INTEREST_BEARING_UPB > 0"),
    "MAX_NIB_UPB": "MAX(CURRENT_NON_INTEREST_BEARING_UPB)",
    "LAST_NIB_UPB": last("CURRENT_NON_INTEREST_BEARING_UPB"),
    "FINAL_DDLPI_DATE": last_known("DDLPI"),
    "FINAL_PAYMENT_GAP_MONTHS": last_known("GAP"),
    "MAX_PAYMENT_GAP_MONTHS": "MAX(GAP)",
    "MAX_CUMULATIVE_MOD_COST": "MAX(CUMULATIVE_MOD_COST)",
    "EVER_HAD_MOD_COST": "MAX(CUMULATIVE_MOD_COST_IS_MODIFIED)",
    "EVER_STEP_MOD": any_month("STEP_MOD_FLAG = 'STEP_MOD'"),
    "EVER_FIXED_MOD": any_month("STEP_MOD_FLAG = 'NON_STEP_MOD'"),
    "IS_CURRENTLY_STEP_MOD": last_is("STEP_MOD_FLAG = 'STEP_MOD'"),
    "EVER_PAYMENT_DEFERRAL": any_month("PAYMENT_DEFERRAL_FLAG <> 'NOT_PAYMENT_DEFERRAL'"),
    "IS_RECENTLY_DEFERRED": last_is("PAYMENT_DEFERRAL_FLAG = 'CURRENT_PERIOD'"),
    "DEFERRAL_EVENT_COUNT": months_with("PAYMENT_DEFERRAL_FLAG = 'CURRENT_PERIOD'"),
    "LAST_ELTV": last_known("ELTV"),
    "MAX_ELTV": "MAX(ELTV)",
    "MIN_ELTV": "MIN(ELTV)",
    "EVER_UNDERWATER": any_month("ELTV > 100"),
    "INITIAL_ELTV": first("ELTV"),
    "LAST_ELTV_IS_MISSING": last("ELTV_IS_MISSING"),
    "INITIAL_ELTV_IS_MISSING": first("ELTV_IS_MISSING"),
    "ELTV_EVER_MISSING": "MAX(ELTV_IS_MISSING)",
    "PRE_DEFAULT_MAX_ACCRUED_INTEREST": "MAX(DELINQUENT_ACCRUED_INTEREST)",
    "PRE_DEFAULT_EVER_HAD_LOSS_SIGNS": "MAX(HAS_DELINQUENT_INTEREST)",
    "PRE_DEFAULT_EVER_DISASTER_AFFECTED": "MAX(DELINQUENCY_DUE_TO_DISASTER)",
    "PRE_DEFAULT_CURRENTLY_DISASTER_AFFECTED": last("DELINQUENCY_DUE_TO_DISASTER"),
    "IS_PRE_2014_VINTAGE_REPORTING": "MAX(DISASTER_FLAG_MISSING)",
    "EVER_FORBEARANCE": any_month("BORROWER_ASSISTANCE_STATUS_CODE = 'FORBEARANCE'"),
    "EVER_REPAYMENT": any_month("BORROWER_ASSISTANCE_STATUS_CODE = 'REPAYMENT'"),
    "EVER_TRIAL_PERIOD": any_month("BORROWER_ASSISTANCE_STATUS_CODE = 'TRIAL_PERIOD'"),
    "LAST_ASSISTANCE_STATUS": last("BORROWER_ASSISTANCE_STATUS_CODE"),
    "AVG_MONTHLY_MOD_COST": "ROUND(AVG(CAST(CURRENT_MONTH_MOD_COST AS DOUBLE)), 6)",
    "MAX_MONTHLY_MOD_COST": "MAX(CURRENT_MONTH_MOD_COST)",
    "LAST_MONTHLY_MOD_COST": last("CURRENT_MONTH_MOD_COST"),
    "EVER_MONTHLY_MODIFIED": "MAX(CURRENT_MONTH_IS_MODIFIED)",
}

AGGREGATED = f"""{DEFAULTED},
features AS (
  SELECT {LOAN}, {', '.join(f'{e} AS {n}' for n, e in FEATURES.items())}
  FROM observed_rows GROUP BY {LOAN}),
aggregated AS (SELECT * FROM features JOIN labels USING ({LOAN}))"""

TRAINING = f"{AGGREGATED},{ORIG_CLEAN}"


def query(ctes, select):
    return f"WITH {ctes.lstrip()}\n{select}"
