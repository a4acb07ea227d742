"""The answer key as a CSV file: what was planted, read back as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.sources.text_csv import read_text_csv, write_text_csv


def write_answer_key(key: DataFrame, path: str) -> None:
    """In order of the raw rows, and of the faults of one row."""
    ordered = key.orderBy("raw_row_number", "error_type")
    write_text_csv(ordered.select(*a.ANSWER_KEY_COLUMNS), path)


def read_answer_key(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, a.ANSWER_KEY_COLUMNS)


def true_reasons(key: DataFrame, rule_names: Sequence[str]) -> DataFrame:
    """(attendance_id, reason) pairs of the faults that are to be rejected."""
    return key.filter(F.col("error_type").isin(*rule_names)).select(
        a.KEY, F.col("error_type").alias("reason")
    )
