"""The cleaning chain on CSV files as they land in a folder.

All row-wise steps and the rules run unchanged.  Only deduplication needs
state: a key is remembered until ``horizon`` after it was read, so the state
does not grow with the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftworks import attendance as a
from siftworks.operators.rules import REASONS, Rule, is_clean, tag_failures
from siftworks.plans.cleaning import normalised
from siftworks.sources.tables import CLEAN, OUTCOME, QUARANTINED
from siftworks.sources.text_csv import CORRUPT, text_schema

READ_AT = "read_at"


def read_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """New files of a folder as rows of text, with the time of their batch.

    That time only moves forward, so no row is ever too late and left out, as
    could happen with the time of a file that was copied in.  Malformed lines are
    kept whole, as by the batch job.
    """
    return (
        spark.readStream.schema(text_schema(a.RAW_COLUMNS).add(CORRUPT, "string"))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(folder)
        .select("*", F.current_timestamp().alias(READ_AT))
    )


def first_arrivals(rows: DataFrame, horizon: str) -> DataFrame:
    """One row per key among the rows read within ``horizon``.

    Which of several rows with one key survives is settled by the engine, so
    this is for exact copies.  Rows without a key are not compared: each has a
    value of its own, so the source is read once for both kinds.  A copy that lands
    later than ``horizon`` stays; the batch job over the stored rows removes it.
    """
    return (
        rows.withColumn("_own", F.when(F.col(a.KEY).isNull(), F.uuid()))
        .withWatermark(READ_AT, horizon)
        .dropDuplicatesWithinWatermark([a.KEY, "_own"])
        .drop("_own")
    )


def judged_arrivals(rows: DataFrame, rules: Sequence[Rule], horizon: str) -> DataFrame:
    return (
        first_arrivals(normalised(rows), horizon)
        .transform(tag_failures, rules)
        .select(
            *a.CLEAN_COLUMNS,
            CORRUPT,
            REASONS,
            F.when(is_clean(), CLEAN).otherwise(QUARANTINED).alias(OUTCOME),
        )
    )


def clean_arrivals(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    rules: Sequence[Rule],
    horizon: str = "7 days",
) -> StreamingQuery:
    """Clean all files that have not been read yet, then stop.

    Clean and quarantined rows are stored side by side, as by the batch job.
    The checkpoint folder must be shared by all executors and kept between
    runs: it knows the files that were read and the keys that were seen.
    """
    return (
        judged_arrivals(read_arrivals(spark, folder), rules, horizon)
        .writeStream.format("parquet")
        .partitionBy(OUTCOME)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
