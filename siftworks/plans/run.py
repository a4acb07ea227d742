"""The full job: one raw scan, one shuffle by key, one stored result.

Everything after the write (counts, report, reconciliation, KPIs) reads the
stored table, so an executor lost later on costs no second cleaning.  How many rows
were read, and from which file, is stored with the rows by the same write.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.operators import kpi, reconcile, report
from siftworks.operators.dedupe import TALLY, TALLY_OF, NullKeys, collapse_copies
from siftworks.operators.rules import REASONS, Rule, is_clean, tag_failures
from siftworks.plans.cleaning import (
    ORIGINAL,
    deduplicated,
    deduplicated_with_tally,
    keep_original,
    normalised,
)
from siftworks.sources import tables
from siftworks.sources.text_csv import CORRUPT, write_report_csv

TIMES = ("arrival_time", "departure_time")
# The stored table, spelled out: it can be read when it has no rows, and no file is
# opened to learn its columns.
STORED = ", ".join(
    [
        *[f"{c} {'timestamp_ntz' if c in TIMES else 'string'}" for c in a.CLEAN_COLUMNS],
        f"{CORRUPT} string",
        f"{REASONS} array<string>",
        f"{ORIGINAL} struct<{', '.join(f'{c}: string' for c in [*a.RAW_COLUMNS, 'line'])}>",
        f"{TALLY} bigint",
        f"{TALLY_OF} string",
        f"{tables.OUTCOME} string",
    ]
)


@dataclass
class Run:
    """Where a run put its results, and how long its stages took."""

    spark: SparkSession
    folder: str
    rules: Sequence[Rule]
    seconds: dict[str, float] = field(default_factory=dict)

    @property
    def attendances(self) -> str:
        return f"{self.folder}/attendances"

    @property
    def report_path(self) -> str:
        return f"{self.folder}/dq_report"

    @property
    def counts_path(self) -> str:
        return f"{self.folder}/counts"

    @property
    def metrics_path(self) -> str:
        return f"{self.folder}/run_metrics"

    def _stored(self) -> DataFrame:
        return tables.read_outcomes(self.spark, self.attendances, STORED)

    def outcomes(self) -> DataFrame:
        rows = self._stored().filter(F.col(tables.OUTCOME).isin(tables.CLEAN, tables.QUARANTINED))
        return rows.drop(TALLY, TALLY_OF)

    def files_read(self) -> DataFrame:
        """(read_from, rows_read) of every input file; a feed without files is one part."""
        return self._stored().filter(F.col(tables.OUTCOME) == tables.READ).select(TALLY_OF, TALLY)

    def files_written(self) -> DataFrame:
        """(outcome, file, rows) of the stored table, as its footers have it."""
        return (
            self.outcomes()
            .groupBy(tables.OUTCOME, F.col("_metadata.file_name").alias("file"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )

    def clean(self) -> DataFrame:
        return tables.read_clean(self.spark, self.attendances, STORED).select(*a.CLEAN_COLUMNS)

    def quarantined(self) -> DataFrame:
        rows = tables.read_quarantined(self.spark, self.attendances, STORED)
        return rows.drop(TALLY, TALLY_OF)

    def counts(self) -> DataFrame:
        """One stored row: rows at every stage, and failures of every rule."""
        return self.spark.read.parquet(self.counts_path)

    def stage_counts(self) -> DataFrame:
        return self.counts().select(*STAGE_COUNTS)

    def dq_report(self, include_zero: bool = False) -> DataFrame:
        return report.report_from_counts(self.counts(), self.rules, include_zero)


STAGE_COUNTS = [
    "rows_read",
    "rows_deduplicated",
    "duplicates_removed",
    "rows_clean",
    "rows_quarantined",
]


def _stage_counts(rows_read: Column) -> list[Column]:
    """Aggregates over kept rows, given how many were read."""
    kept = F.count(F.lit(1))
    return [
        rows_read.cast("bigint").alias("rows_read"),
        kept.alias("rows_deduplicated"),
        (rows_read - kept).cast("bigint").alias("duplicates_removed"),
        F.count_if(is_clean()).alias("rows_clean"),
        F.count_if(~is_clean()).alias("rows_quarantined"),
    ]


def stage_counts(
    raw: DataFrame, order_by: Sequence[str], row_id: str, rules: Sequence[Rule]
) -> DataFrame:
    """One row: rows read, kept and judged, without storing them.

    The rules look at one row at a time, so they judge before the shuffle: only the
    key, the order and the reasons of a row travel.
    """
    narrow = dict.fromkeys([a.KEY, *order_by, row_id])
    judged = normalised(raw).transform(tag_failures, rules).select(*narrow, REASONS)
    kept = collapse_copies(judged, [a.KEY], order_by, row_id)
    return kept.agg(*_stage_counts(F.coalesce(F.sum("copies"), F.lit(0))))


def _tagged(raw: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Normalised and judged rows, with the untouched text of those that fail.

    Judged before the shuffle: the text then travels with the failing rows only.
    """
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    return (
        raw.transform(keep_original)
        .transform(normalised)
        .transform(tag_failures, rules)
        .withColumn(ORIGINAL, F.when(~is_clean(), F.col(ORIGINAL)))
    )


STORED_ROWS = [*a.CLEAN_COLUMNS, CORRUPT, REASONS, ORIGINAL]


def tagged_and_deduplicated(
    raw: DataFrame,
    order_by: Sequence[str],
    row_id: str,
    rules: Sequence[Rule],
    null_keys: NullKeys = "keep",
) -> DataFrame:
    """Judged rows, one per attendance, as they are stored."""
    return deduplicated(_tagged(raw, rules), order_by, row_id, null_keys).select(*STORED_ROWS)


def tagged_with_tally(
    raw: DataFrame,
    order_by: Sequence[str],
    row_id: str,
    rules: Sequence[Rule],
    null_keys: NullKeys = "keep",
) -> DataFrame:
    """``tagged_and_deduplicated``, and the rows that say how many were read of each file."""
    judged = deduplicated_with_tally(_tagged(raw, rules), order_by, row_id, null_keys)
    return judged.select(*STORED_ROWS, TALLY, TALLY_OF)


def full_run(
    raw: DataFrame,
    order_by: Sequence[str],
    row_id: str,
    rules: Sequence[Rule],
    folder: str,
    truth: DataFrame | None = None,
    null_keys: NullKeys = "keep",
    breach_minutes: int = a.BREACH_MINUTES,
    include_zero: bool = False,
) -> Run:
    """Clean, judge and store the feed, write the report, note the stages.

    ``truth`` holds (attendance_id, reason) pairs to reconcile against.  Rows
    without a key are all kept, or collapsed to one.  A feed without rows gives an
    empty table and counts of zero.
    """
    spark = raw.sparkSession
    run = Run(spark, folder, rules)
    began = time.perf_counter()

    def timed(stage: str, work) -> None:
        start = time.perf_counter()
        work()
        run.seconds[stage] = time.perf_counter() - start

    corrupt = [CORRUPT] if CORRUPT in raw.columns else []
    columns = [*a.RAW_COLUMNS, *corrupt, *dict.fromkeys([*order_by, row_id])]

    def clean_and_store() -> None:
        tagged = tagged_with_tally(raw.select(*columns), order_by, row_id, rules, null_keys)
        tables.write_outcomes(tagged, run.attendances)

    def count() -> None:
        """One aggregate over the stored rows; the feed is not read again.
        A count that a retried stage repeats is still right, unlike an accumulator."""
        read = run.files_read().agg(F.coalesce(F.sum(TALLY), F.lit(0)).alias("_read"))
        kept = run.outcomes().agg(*_stage_counts(F.lit(0)), *report.rule_counts(rules))
        rest = [c for c in kept.columns if c not in ("rows_read", "duplicates_removed")]
        removed = (F.col("_read") - F.col("rows_deduplicated")).alias("duplicates_removed")
        # Two rows of one line each.
        kept.crossJoin(read).select(F.col("_read").alias("rows_read"), removed, *rest).write.mode(
            "overwrite"
        ).parquet(run.counts_path)

    timed("clean_and_store", clean_and_store)
    timed("count", count)
    timed("report", lambda: write_report_csv(run.dq_report(include_zero), run.report_path))
    if truth is not None:
        timed(
            "reconcile",
            lambda: reconciliation(run, truth)
            .write.mode("overwrite")
            .parquet(f"{folder}/reconciliation"),
        )
    kpi.register_views(run.clean(), breach_minutes)
    run.seconds["total"] = time.perf_counter() - began
    run_metrics(run).write.mode("append").parquet(run.metrics_path)
    return run


def reconciliation(run: Run, truth: DataFrame) -> DataFrame:
    return reconcile.summary(run.quarantined(), truth, [a.KEY])


def found_reasons(tagged: DataFrame) -> DataFrame:
    """(attendance_id, reason) pairs of tagged rows."""
    return tagged.select(a.KEY, F.explode(REASONS).alias("reason"))


def run_metrics(run: Run) -> DataFrame:
    """Per stage: rows in and out, seconds where it was timed, and the time of
    the run, as the runs of a folder append to one table."""
    n = {c: F.col(c) for c in STAGE_COUNTS}
    kept = n["rows_deduplicated"]
    flows = [
        ("read", n["rows_read"], n["rows_read"], None),
        ("deduplicate", n["rows_read"], kept, None),
        ("keep_clean", kept, n["rows_clean"], None),
        ("quarantine", kept, n["rows_quarantined"], None),
        ("load", n["rows_clean"], n["rows_clean"], None),
        *[(s, None, None, sec) for s, sec in run.seconds.items()],
    ]
    lines = [
        F.struct(
            F.lit(stage).alias("stage"),
            (F.lit(None) if rows_in is None else rows_in).cast("bigint").alias("rows_in"),
            (F.lit(None) if rows_out is None else rows_out).cast("bigint").alias("rows_out"),
            F.lit(seconds).cast("double").alias("seconds"),
        )
        for stage, rows_in, rows_out, seconds in flows
    ]
    return run.stage_counts().select(
        F.inline(F.array(*lines)), F.current_timestamp().alias("run_at")
    )
