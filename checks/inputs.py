"""Raw loan tables derived from the given ``orders`` and ``customer`` tables.

A customer is a loan, its n-th order is its n-th month. The expressions mean the
same in Spark and DuckDB, so the oracle builds its input from the same text.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Month of a row minus its position, as year * 12 + month - 1: some loans start before
# 2014, some pause for eight months, and some (whose balance is then missing, so that
# they are implausible) report later than all others.
FIRST_MONTH = (
    "CASE WHEN ck % 50 = 9 THEN 24162 ELSE 24275 END + CASE WHEN ck % 97 = 8 AND rn > 6 THEN 40 "
    "WHEN ck % 27 = 2 AND rn > 4 THEN 8 ELSE 0 END"
)

# Rows that occur twice, the second time with other values, so that it matters which stays.
PERFORMANCE_TWICE = "ok % 50 = 0"
ORIGINATIONS_TWICE = "ck % 251 = 7"

# How each raw performance column follows from ck, ok, rn and m0.
PERFORMANCE_RAW = {
    "LOAN_SEQUENCE_NUMBER": (
        "CASE WHEN ok % 733 = 0 THEN NULL WHEN ck % 83 = 3 THEN CONCAT('XX', LPAD(CAST(ck AS "
        "STRING), 7, '0')) ELSE CONCAT('F', CASE WHEN ck % 15 = 14 THEN '99' ELSE CAST(10 + ck % "
        "14 AS STRING) END, 'Q', CAST(ck % 4 + 1 AS STRING), LPAD(CAST(ck AS STRING), 7, '0')) END"
    ),
    "MONTHLY_REPORTING_PERIOD": (
        "CASE WHEN ok % 131 = 0 THEN 'bad' ELSE CAST(CAST(FLOOR((m0 + rn) / 12) AS INT) * 100 "
        "+ (m0 + rn) % 12 + 1 AS STRING) END"
    ),
    "CURRENT_ACTUAL_UPB": (
        "CASE WHEN ok % 97 = 0 OR ck % 97 = 8 AND rn > 6 THEN NULL WHEN ck % 29 = 5 AND rn >= 6 "
        "THEN '0' ELSE CAST(200000 - 1000 * rn + CASE WHEN ck % 11 IN "
        "(0, 1) AND rn >= 5 THEN 9000 ELSE 0 END AS STRING) END"
    ),
    "CURRENT_DELINQUENCY_STATUS": (
        "CASE WHEN ck % 17 = 6 THEN CAST(CASE WHEN rn > 5 THEN rn - 5 ELSE 0 END AS STRING) "
        "WHEN ck % 17 = 7 AND rn = 6 THEN 'RA' WHEN ck % 17 = 9 THEN '3' WHEN ck % 17 = 8 AND "
        "rn >= 4 THEN '3' WHEN ok % 61 = 0 THEN 'XX' ELSE ' 0' END"
    ),
    "LOAN_AGE": (
        "CASE WHEN ok % 89 = 0 THEN '-3' WHEN ok % 83 = 0 THEN 'abc' WHEN ok % 79 = 1 THEN 'NaN' "
        "WHEN ok % 79 = 2 THEN '1e1' WHEN ok % 79 = 3 THEN ' 0012 ' ELSE CAST(rn + ck % 40 "
        "AS STRING) END"
    ),
    "MONTHS_REMAINING_TO_LEGAL_MATURITY": "NULL",
    "DEFECT_SETTLEMENT_DATE": "NULL",
    "MOD_FLAG": (
        "CASE WHEN ck % 11 = 1 AND rn = 5 THEN 'y ' WHEN ck % 11 = 1 AND rn > 5 THEN 'P' ELSE "
        "NULL END"
    ),
    "ZERO_BALANCE_CODE": (
        "CASE WHEN ck % 13 = 0 AND rn = 7 THEN '01' WHEN ck % 13 = 1 AND rn = 8 THEN '03' "
        "WHEN ck % 13 = 2 AND rn = 8 THEN '16' WHEN ck % 13 = 3 AND rn = 8 THEN '96' "
        "WHEN ck % 13 = 4 AND rn = 8 THEN '02' WHEN ck % 13 = 5 AND rn = 8 THEN '09' "
        "WHEN ck % 13 = 6 AND rn = 8 THEN '15' ELSE NULL END"
    ),
    "ZERO_BALANCE_EFFECT_DATE": (
        "CASE WHEN ck % 13 = 0 AND rn = 7 OR ck % 13 IN (1, 2, 3) AND rn = 8 THEN "
        "CAST(CAST(FLOOR((m0 + rn) / 12) AS INT) * 100 + (m0 + rn) % 12 + 1 AS STRING) WHEN "
        "ok % 71 = 0 THEN ' ' ELSE NULL END"
    ),
    "CURRENT_INTEREST_RATE": (
        "CASE WHEN ok % 79 = 0 THEN '0' WHEN ok % 73 = 0 THEN '25.5' ELSE CAST(3 + (ck % 9) * "
        "0.25 AS STRING) END"
    ),
    "CURRENT_NON_INTEREST_BEARING_UPB": "CASE WHEN ck % 31 = 0 AND rn > 6 THEN '5000' ELSE '0' END",
    "DDLPI": (
        "CASE WHEN ok % 67 = 0 THEN NULL WHEN ck % 19 = 5 THEN CAST(CAST(FLOOR((m0 + rn - "
        "CASE WHEN rn > 4 THEN 4 ELSE rn - 1 END) / 12) AS INT) * 100 + (m0 + rn - CASE WHEN "
        "rn > 4 THEN 4 ELSE rn - 1 END) % 12 + 1 AS STRING) ELSE CAST(CAST(FLOOR((m0 + rn - "
        "1) / 12) AS INT) * 100 + (m0 + rn - 1) % 12 + 1 AS STRING) END"
    ),
    "MI_RECOVERIES": "NULL",
    "NET_SALE_PROCEEDS": "NULL",
    "NON_MI_RECOVERIES": "NULL",
    "TOTAL_EXPENSES": "NULL",
    "LEGAL_COSTS": "NULL",
    "MAINTENANCE_AND_PRESERVE_COSTS": "NULL",
    "TAXES_AND_INSURANCE": "NULL",
    "MISC_EXPENSES": "NULL",
    "ACTUAL_LOSS_CALC": "NULL",
    "CUMULATIVE_MOD_COST": (
        "CASE WHEN ck % 11 = 1 AND rn >= 5 THEN '120.5' WHEN ok % 59 = 0 THEN '-4' ELSE NULL "
        "END"
    ),
    "INTEREST_RATE_STEP_INDICATOR": (
        "CASE WHEN ck % 11 = 1 AND rn >= 5 THEN CASE WHEN ck % 2 = 0 THEN 'Y' ELSE 'N' END "
        "ELSE NULL END"
    ),
    "PAYMENT_DEFERRAL_FLAG": (
        "CASE WHEN ck % 37 = 3 AND rn = 3 THEN 'Y' WHEN ck % 37 = 3 AND rn > 3 THEN 'P' ELSE "
        "NULL END"
    ),
    "ELTV": "CASE WHEN copy = 2 THEN '39' WHEN ok % 53 = 0 THEN '999' ELSE CAST(40 + ck % 80 AS STRING) END",
    "ZERO_BALANCE_REMOVAL_UPB": "NULL",
    "DELINQUENT_ACCRUED_INTEREST": (
        "CASE WHEN ck % 13 = 1 AND rn = 8 THEN '2500.25' WHEN ok % 47 = 0 THEN '0' ELSE NULL "
        "END"
    ),
    "DELINQUENCY_DUE_TO_DISASTER": "CASE WHEN ck % 41 = 4 AND rn BETWEEN 3 AND 5 THEN 'Y' ELSE NULL END",
    "BORROWER_ASSISTANCE_STATUS_CODE": (
        "CASE WHEN ck % 43 = 5 THEN 'F' WHEN ck % 43 = 6 THEN 'R' WHEN ck % 43 = 7 THEN 'T' "
        "WHEN ck % 43 = 8 THEN '7' ELSE NULL END"
    ),
    "CURRENT_MONTH_MOD_COST": "CASE WHEN ck % 11 = 1 AND rn >= 5 THEN CAST(rn * 10 AS STRING) ELSE NULL END",
    "INTEREST_BEARING_UPB": "NULL",
}

# How each raw originations column follows from a customer.
ORIGINATIONS_RAW = {
    "CREDIT_SCORE": (
        "CASE WHEN copy = 2 THEN '301' WHEN ck % 23 = 0 THEN '9999' WHEN ck % 29 = 0 THEN NULL WHEN ck % 103 = 1 THEN "
        "'12' ELSE CAST(350 + (ck * 37) % 480 AS STRING) END"
    ),
    "FIRST_PAYMENT_DATE": (
        "CASE WHEN ck % 101 = 0 THEN 'bad' ELSE CONCAT('20', CAST(10 + ck % 14 AS STRING), "
        "'0', CAST(ck % 9 + 1 AS STRING)) END"
    ),
    "FIRST_TIME_HOMEBUYER_FLAG": (
        "CASE ck % 5 WHEN 0 THEN 'Y' WHEN 1 THEN ' n' WHEN 2 THEN '9' WHEN 3 THEN 'N' ELSE "
        "NULL END"
    ),
    "MATURITY_DATE": (
        "CASE WHEN ck % 107 = 0 THEN NULL ELSE CONCAT('20', CAST(40 + ck % 14 AS STRING), "
        "'0', CAST(ck % 9 + 1 AS STRING)) END"
    ),
    "MSA_OR_MET_DIV": (
        "CASE WHEN ck % 7 = 0 THEN NULL WHEN ck % 7 = 1 THEN ' nan' WHEN ck % 7 = 2 THEN 'x1' "
        "ELSE CONCAT(CAST(10000 + (ck % 50) * 20 AS STRING), '.0') END"
    ),
    "MI_PERCENT": "CASE WHEN ck % 23 = 1 THEN '999' ELSE CAST((ck * 7) % 60 AS STRING) END",
    "NUMBER_OF_UNITS": "CASE WHEN ck % 31 = 2 THEN '99' WHEN ck % 31 = 3 THEN '7' ELSE CAST(ck % 4 + 1 AS STRING) END",
    "OCCUPANCY_STATUS": "CASE WHEN ck % 71 = 0 THEN 'z' ELSE CASE ck % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'i ' WHEN 2 THEN 'S' ELSE '9' END END",
    "ORIGINAL_CLTV": "CASE WHEN ck % 23 = 3 THEN '999' ELSE CAST((ck * 13) % 260 AS STRING) END",
    "ORIGINAL_DTI_RATIO": "CASE WHEN ck % 23 = 2 THEN '999' ELSE CAST((ck * 11) % 70 AS STRING) END",
    "ORIGINAL_UPB": (
        "CASE WHEN ck % 211 = 0 THEN '0' WHEN ck % 223 = 0 THEN '4000000' ELSE CAST(50000 + "
        "(ck % 400) * 1000 AS STRING) END"
    ),
    "ORIGINAL_LTV": "CASE WHEN ck % 23 = 4 THEN '999' ELSE CAST((ck * 13) % 130 AS STRING) END",
    "ORIGINAL_INTEREST_RATE": "CASE WHEN ck % 97 = 0 THEN '0' ELSE CAST(2 + (ck % 24) * 0.125 AS STRING) END",
    "CHANNEL": (
        "CASE ck % 6 WHEN 0 THEN 'R' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'T' WHEN 4 "
        "THEN '9' WHEN 5 THEN ' r' END"
    ),
    "PPM_FLAG": "CASE ck % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN NULL END",
    "AMORTIZATION_TYPE": (
        "CASE ck % 4 WHEN 0 THEN 'FRM' WHEN 1 THEN 'ARM' WHEN 2 THEN 'frm' WHEN 3 THEN '?' "
        "END"
    ),
    "PROPERTY_STATE": (
        "CASE ck % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'ny' WHEN 2 THEN ' TX' WHEN 3 THEN 'ZZ' "
        "WHEN 4 THEN 'PR' ELSE NULL END"
    ),
    "PROPERTY_TYPE": (
        "CASE ck % 7 WHEN 0 THEN 'CO' WHEN 1 THEN 'PU' WHEN 2 THEN 'MH' WHEN 3 THEN 'SF' WHEN "
        "4 THEN 'CP' WHEN 5 THEN '99' WHEN 6 THEN NULL END"
    ),
    "POSTAL_CODE": (
        "CASE WHEN ck % 19 = 0 THEN '12345' WHEN ck % 19 = 1 THEN '0' WHEN ck % 19 = 2 THEN "
        "'abc' WHEN ck % 19 = 3 THEN '601.0' ELSE CAST((ck % 900 + 1) * 100 AS STRING) END"
    ),
    "LOAN_SEQUENCE_NUMBER": (
        "CASE WHEN ck % 499 = 0 THEN NULL WHEN ck % 83 = 3 THEN CONCAT('XX', LPAD(CAST(ck AS "
        "STRING), 7, '0')) ELSE CONCAT('F', CASE WHEN ck % 15 = 14 THEN '99' "
        "ELSE CAST(10 + ck % 14 AS STRING) END, 'Q', CAST(ck % 4 + 1 AS STRING), LPAD(CAST(ck "
        "AS STRING), 7, '0')) END"
    ),
    "LOAN_PURPOSE": (
        "CASE ck % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'C' WHEN 2 THEN 'N' WHEN 3 THEN 'R' WHEN 4 "
        "THEN '9' END"
    ),
    "ORIGINAL_LOAN_TERM": (
        "CASE WHEN ck % 61 = 0 THEN '0' WHEN ck % 61 = 1 THEN '30' WHEN ck % 61 = 2 THEN "
        "'600' ELSE CAST(120 + (ck % 3) * 120 AS STRING) END"
    ),
    "NUMBER_OF_BORROWERS": (
        "CASE WHEN ck % 47 = 0 THEN '99' WHEN ck % 47 = 1 THEN 'nan' WHEN ck % 47 = 2 THEN "
        "'2.0' ELSE CAST(ck % 12 + 1 AS STRING) END"
    ),
    "SELLER_NAME": (
        "CASE WHEN ck % 53 = 0 THEN NULL WHEN ck % 53 = 1 THEN ' nan' ELSE "
        "LOWER(c_mktsegment) END"
    ),
    "SERVICER_NAME": (
        "CASE WHEN ck % 59 = 0 THEN '' WHEN ck % 59 = 1 THEN NULL ELSE CONCAT(c_mktsegment, ' "
        "svc ') END"
    ),
    "SUPER_CONFORMING_FLAG": "CASE ck % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN NULL WHEN 3 THEN ' y' END",
    "PRE_RELIEF_LOAN_NUMBER": "NULL",
    "PROGRAM_INDICATOR": "CASE ck % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'F' WHEN 2 THEN 'R' WHEN 3 THEN '9' END",
    "RELIEF_REFI_INDICATOR": "CASE ck % 3 WHEN 0 THEN 'Y' WHEN 1 THEN NULL WHEN 2 THEN 'X' END",
    "PROP_VALUATION_METHOD": (
        "CASE ck % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' WHEN 4 "
        "THEN '9' END"
    ),
    "IO_INDICATOR": "CASE ck % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 2 THEN '9' WHEN 3 THEN NULL END",
    "MI_CANCEL_INDICATOR": (
        "CASE ck % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN '7' WHEN 3 THEN '9' ELSE 'Q' "
        "END"
    ),
}


# Keys of orders that may meet in one window partition.
KEYS_PER_BLOCK = 65_536


def order_positions(orders: DataFrame) -> DataFrame:
    """``rn``: position of each order among its customer's, by day, then key.

    Counting per day and block of keys first keeps a customer with very many orders, on
    many days or on one, from becoming one window partition: the window over a customer
    sees one row per day and block, the one over a block its bounded number of keys.
    """
    placed = orders.select(
        F.col("o_custkey").alias("ck"),
        F.col("o_orderkey").alias("ok"),
        F.col("o_orderdate").alias("day"),
        F.floor(F.col("o_orderkey") / KEYS_PER_BLOCK).alias("block"),
    )
    by_day = Window.partitionBy("ck").orderBy("day", "block")
    earlier = (
        placed.groupBy("ck", "day", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("ck", "day", "block", (F.sum("n").over(by_day) - F.col("n")).alias("earlier"))
    )
    within_block = F.row_number().over(Window.partitionBy("ck", "day", "block").orderBy("ok"))
    # One fixed join strategy: the plan is the same wherever this frame is used
    # within a query, so its shuffles are reused.
    return placed.join(earlier.hint("merge"), ["ck", "day", "block"]).select(
        "ck", "ok", (F.col("earlier") + within_block).alias("rn")
    )


def _raw_columns(df: DataFrame, expressions: dict[str, str], twice: str) -> DataFrame:
    copies = F.expr(f"CASE WHEN {twice} THEN ARRAY(1, 2) ELSE ARRAY(1) END")
    columns = [F.expr(e).cast("string").alias(name) for name, e in expressions.items()]
    return df.withColumn("copy", F.explode(copies)).select(*columns)


def performance_raw(spark: SparkSession, sf_dir: str, read_twice: bool = False) -> DataFrame:
    """``read_twice`` deals the positions by order, so that a query that reads the table to fit
    medians and again to clean it finds them once; such a query's readers share that shuffle."""
    placed = order_positions(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    if read_twice:
        placed = placed.repartition("ok")
    placed = placed.withColumn("m0", F.expr(FIRST_MONTH))
    return _raw_columns(placed, PERFORMANCE_RAW, PERFORMANCE_TWICE)


def originations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    # A small file of many rows is one task; a row makes 32 columns here, so rows are dealt first.
    placed = customers.select(F.col("c_custkey").alias("ck"), "c_mktsegment").repartition("ck")
    return _raw_columns(placed, ORIGINATIONS_RAW, ORIGINATIONS_TWICE)
