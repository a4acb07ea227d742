"""The jobs as commands, for ``spark-submit`` or ``python -m siftworks``.

    feed     events to a messy CSV feed and its answer key
    peek     schema, row and value counts, and the first rows of a CSV feed
    shapes   the shapes found in columns of a CSV feed
    clean    the full job: clean, judge, report, reconcile, store
    check    what cleaning arrives at against the answer key of the feed
    kpis     the KPI views over the clean rows of a stored run
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks import settings
from siftworks.operators import kpi, profile
from siftworks.plans.expectations import expectation_report
from siftworks.plans.run import Run, full_run
from siftworks.sources import attendance_feed, text_csv
from siftworks.sources.answer_key import read_answer_key, true_reasons, write_answer_key


def feed(spark: SparkSession, events: str, raw: str, key: str) -> None:
    """Write the rows in feed order and what was planted in them."""
    messy = attendance_feed.messy_feed(attendance_feed.read_events(spark, events))
    text_csv.write_text_csv(
        messy.orderBy(*attendance_feed.FEED_ORDER).select(*a.RAW_COLUMNS), raw
    )
    write_answer_key(attendance_feed.planted_faults(messy), key)


def _scan(spark: SparkSession, raw: str) -> DataFrame:
    """The raw feed with the places of its rows, malformed lines whole."""
    return text_csv.read_text_csv(
        spark, raw, a.RAW_COLUMNS, corrupt_column=True, with_position=True
    )


def peek(spark: SparkSession, raw: str) -> None:
    df = _scan(spark, raw)
    profile.column_overview(df.select(*a.RAW_COLUMNS, text_csv.CORRUPT)).show(truncate=False)
    profile.peek(df, text_csv.SOURCE_ORDER).select(*a.RAW_COLUMNS).show(truncate=False)


def shapes(spark: SparkSession, raw: str, columns: Sequence[str]) -> None:
    """Of lines that are well formed; the others have no columns to speak of."""
    df = _scan(spark, raw).filter(F.col(text_csv.CORRUPT).isNull())
    for column in columns:
        profile.top_shapes(df, column).show(truncate=False)


def clean(
    spark: SparkSession,
    raw: str,
    out: str,
    key: str | None = None,
    year: int = 2025,
    longest_stay: int = a.LONGEST_STAY_MINUTES,
    breach_minutes: int = a.BREACH_MINUTES,
    null_triage_fails: bool = False,
    null_keys: str = "keep",
    include_zero: bool = False,
) -> Run:
    rules = a.reject_rules(year, longest_stay, null_triage_fails, text_csv.CORRUPT)
    names = [r.name for r in rules]
    return full_run(
        _scan(spark, raw),
        text_csv.SOURCE_ORDER,
        text_csv.SOURCE_ROW,
        rules,
        out,
        true_reasons(read_answer_key(spark, key), names) if key else None,
        null_keys,
        breach_minutes,
        include_zero,
    )


def check(spark: SparkSession, raw: str, key: str, year: int = 2025) -> None:
    """Cleaning against the answer key, count by count."""
    report = expectation_report(
        _scan(spark, raw),
        text_csv.SOURCE_ORDER,
        text_csv.SOURCE_ROW,
        a.reject_rules(year),
        read_answer_key(spark, key),
    )
    report.orderBy("ok", "check").show(100, truncate=False)


def kpis(spark: SparkSession, out: str) -> None:
    kpi.register_views(Run(spark, out, []).clean(), a.BREACH_MINUTES)
    for view in ("v_four_hour_breach", "v_los_by_triage", "v_arrivals_by_hour"):
        spark.table(view).show(24, truncate=False)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="siftworks", description=__doc__.split("\n")[0])
    commands = parser.add_subparsers(dest="command", required=True)

    make = commands.add_parser("feed")
    make.add_argument("--events", required=True)
    make.add_argument("--raw", required=True)
    make.add_argument("--key", required=True)

    look = commands.add_parser("peek")
    look.add_argument("--raw", required=True)

    shape = commands.add_parser("shapes")
    shape.add_argument("--raw", required=True)
    shape.add_argument("--columns", nargs="+", default=["arrival_time", "departure_time"])

    tidy = commands.add_parser("clean")
    tidy.add_argument("--raw", required=True)
    tidy.add_argument("--out", required=True)
    tidy.add_argument("--key")
    tidy.add_argument("--year", type=int, default=2025)
    tidy.add_argument("--longest-stay", type=int, default=a.LONGEST_STAY_MINUTES)
    tidy.add_argument("--breach-minutes", type=int, default=a.BREACH_MINUTES)
    tidy.add_argument("--null-triage-fails", action="store_true")
    tidy.add_argument("--null-keys", choices=["keep", "collapse"], default="keep")
    tidy.add_argument("--include-zero", action="store_true")

    test = commands.add_parser("check")
    test.add_argument("--raw", required=True)
    test.add_argument("--key", required=True)
    test.add_argument("--year", type=int, default=2025)

    views = commands.add_parser("kpis")
    views.add_argument("--out", required=True)

    options = vars(parser.parse_args(arguments))
    jobs = (feed, peek, shapes, clean, check, kpis)
    job = {j.__name__: j for j in jobs}[options.pop("command")]
    spark = settings.apply(SparkSession.builder.appName("siftworks").getOrCreate())
    result = job(spark, **options)
    if isinstance(result, Run):
        spark.read.parquet(result.metrics_path).show(truncate=False)
        result.dq_report().show(truncate=False)


if __name__ == "__main__":
    main()
