"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

    python bench.py [--times N] [--copies] [NAME...]

The raw tables are derived and stored as Parquet before the clock starts, so the times
are those of the operators. --times multiplies the loans; --copies adds copies of one
loan's month until they are a third of all performance rows.
"""

import argparse
import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.inputs import originations_raw, performance_raw  # noqa: E402
from checks.registry import as_text_file  # noqa: E402
from loanpanel.operators.features import loan_features  # noqa: E402
from loanpanel.operators.labels import (  # noqa: E402
    default_labels,
    pre_default_rows,
    with_default_flag,
)
from loanpanel.operators.originations import clean_originations  # noqa: E402
from loanpanel.operators.panel import drop_bad_loans  # noqa: E402
from loanpanel.operators.performance import clean_performance  # noqa: E402
from loanpanel.plans.training_set import (  # noqa: E402
    aggregate_performance,
    build_training_set,
    store_training_tables,
    stored_training_set,
    training_set,
)
from loanpanel.schemas import LOAN  # noqa: E402
from loanpanel.session import tuned  # noqa: E402
from loanpanel.sources.scratch import scratch, scratch_dir  # noqa: E402
from loanpanel.sources.stored import ByLoan  # noqa: E402


def flagged(performance: DataFrame) -> DataFrame:
    return with_default_flag(drop_bad_loans(clean_performance(performance)))


HEADLINES = {
    "clean_originations": lambda p, o, settle: clean_originations(o),
    "clean_performance": lambda p, o, settle: clean_performance(p),
    "drop_bad_loans": lambda p, o, settle: drop_bad_loans(clean_performance(p)),
    "default_labels": lambda p, o, settle: default_labels(flagged(p)),
    "loan_features": lambda p, o, settle: loan_features(pre_default_rows(flagged(p))),
    "aggregate_performance": lambda p, o, settle: aggregate_performance(clean_performance(p)),
    "join_performance_originations": lambda p, o, settle: training_set(p, o),
}
# Other ways to the same table; not part of the total.
VARIANTS = {
    "aggregate_performance_settled": lambda p, o, settle: aggregate_performance(
        clean_performance(p), settle=settle
    ),
    "aggregate_performance_cutoff_given": lambda p, o, settle: aggregate_performance(
        clean_performance(p), cutoff=F.lit("2024-06-01").cast("date")
    ),
}


def multiplied(raw: DataFrame, times: int) -> DataFrame:
    """The loans again under other keys, `times` in all."""
    if times == 1:
        return raw
    number = F.explode(F.sequence(F.lit(1), F.lit(times))).alias("number")
    key = F.concat(F.col(LOAN), F.col("number").cast("string"))
    return raw.select("*", number).withColumn(LOAN, key).drop("number")


def with_copies(raw: DataFrame) -> DataFrame:
    one = raw.where(F.col(LOAN).isNotNull()).limit(1)
    again = F.explode(F.sequence(F.lit(1), F.lit(raw.count() // 2)))
    return raw.unionByName(one.select("*", again.alias("again")).drop("again").repartition(8))


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--times", type=int, default=1)
    parser.add_argument("--copies", action="store_true")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tuned(
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # A run generates several hundred classes; the default cache of 100
        # forgets them before the next run.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    with scratch(spark) as settle:
        performance = multiplied(performance_raw(spark, sf_dir), options.times)
        performance = settle(with_copies(performance) if options.copies else performance)
        originations = settle(multiplied(originations_raw(spark, sf_dir), options.times))
        rows = performance.count()
        if options.times == 1 and not options.copies:
            files = [as_text_file(spark, raw, sf_dir) for raw in (performance_raw, originations_raw)]
            HEADLINES["build_training_set"] = lambda p, o, settle: build_training_set(spark, *files)
        if not options.names or "join_stored_tables" in options.names:
            folder = f"{scratch_dir(spark)}/stored-{uuid.uuid4().hex}"
            tables = [ByLoan(name, f"{folder}/{name}", int(cpus)) for name in ("features", "loans")]
            store_training_tables(
                aggregate_performance(clean_performance(performance)), clean_originations(originations), *tables
            )
            VARIANTS["join_stored_tables"] = lambda p, o, settle: stored_training_set(spark, *tables)
        cases = HEADLINES | VARIANTS
        for name in options.names or cases:
            best = None
            for _ in range(2):  # the first run also warms up the JVM
                started = time.perf_counter()
                df = cases[name](performance, originations, settle)
                df.write.format("noop").mode("overwrite").save()
                elapsed = time.perf_counter() - started
                best = elapsed if best is None else min(best, elapsed)
            seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "loan_panel_headline_total",
                "value": round(sum(s for name, s in seconds.items() if name in HEADLINES), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "performance_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
