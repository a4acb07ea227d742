"""Small helpers on DataFrames that the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.sources.work_dir import new_folder

# Blanks of the contracts: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table in the shared folder.

    What follows reads files instead of computing the rows again, also when an
    executor is lost.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside send at most so many rows at once to Python, which bounds what
    whole texts take up on both sides; the session's own setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def remainder_of_id(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
