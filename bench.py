"""Time the headline queries: one JSON line.

All queries run once to warm up the JVM; then each is timed over
``BENCH_REPEATS`` rounds, planning included, and the median counts.  Results go
to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from siftworks import settings
from siftworks.plans.catalogue import all_queries

HEADLINES = [
    "scan_csv_text",
    "trim_and_nullify",
    "standardise_text",
    "parse_mixed_timestamps",
    "fix_codes",
    "shape_profile",
    "null_profile",
    "distinct_counts",
    "dedupe_keep_first",
    "dedupe_orders",
    "duplicate_rows",
    "clean_rows",
    "quarantined_rows",
    "dq_report",
    "rejects_by_reason",
    "reconcile_summary",
    "reconcile_by_rule",
    "kpi_breach_rate",
    "kpi_stay_by_triage",
    "kpi_arrivals_by_hour",
    "answer_key",
    "cleaning_chain",
    "expectation_report",
    "full_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siftworks-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    settings.apply(spark)

    def run(name: str) -> float:
        start = time.perf_counter()
        all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        run(name)
    rounds = [{name: run(name) for name in names} for _ in range(repeats)]
    seconds = {n: round(statistics.median(r[n] for r in rounds), 3) for n in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
