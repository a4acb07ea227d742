"""Stored tables: replace, load, and clean and quarantined rows in one write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftworks.operators.dedupe import TALLY
from siftworks.operators.rules import REASONS, is_clean
from siftworks.sources import versions

OUTCOME = "outcome"
CLEAN = "clean"
QUARANTINED = "quarantined"
# Not rows of the feed: how many of them were read, per input file.
READ = "read"


def load_table(df: DataFrame, path: str) -> int:
    """Replace the whole table and return how many rows it holds.

    The rows go from the executors to the files; the count is read from the
    stored files, whose footers know it.  Readers see the table before or the
    table after, also if the load dies; see ``versions``.
    """
    return versions.load(df, path).rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a loaded table, as they are now."""
    return versions.read(spark, path)


def write_outcomes(tagged: DataFrame, path: str) -> None:
    """Store clean and quarantined rows side by side in one pass.

    ``outcome`` is a partition column: a reader of one side opens only its
    files, and nothing downstream tags or deduplicates the rows again.  Rows are
    rebalanced by it before they are written, so both sides get few, full files.
    Rows that only tally what was read, where there are some, are a third side.
    """
    outcome = F.when(is_clean(), CLEAN).otherwise(QUARANTINED)
    if TALLY in tagged.columns:
        outcome = F.when(F.col(TALLY).isNotNull(), READ).otherwise(outcome)
    (
        tagged.withColumn(OUTCOME, outcome)
        .hint("rebalance", OUTCOME)
        .write.mode("overwrite")
        .partitionBy(OUTCOME)
        .parquet(path)
    )


def read_outcomes(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """The stored rows.  With the schema given, a table without rows reads as one,
    and no job looks the columns up in the files."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_clean(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    rows = read_outcomes(spark, path, schema)
    return rows.filter(F.col(OUTCOME) == CLEAN).drop(OUTCOME, REASONS)


def read_quarantined(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    return read_outcomes(spark, path, schema).filter(F.col(OUTCOME) == QUARANTINED).drop(OUTCOME)
