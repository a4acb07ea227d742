"""CSV files whose columns are all read as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Where a row came from; together they give the order of the rows.  The number in a
# file's name comes first, as text order would put 100000 before 99999.
SOURCE_NUMBER = "source_number"
SOURCE_FILE = "source_file"
SOURCE_BLOCK = "source_block"
SOURCE_ROW = "source_row"
SOURCE_ORDER = [SOURCE_NUMBER, SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW]


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    corrupt_column: bool = False,
    multi_line: bool = False,
    with_position: bool = False,
    header: bool = True,
) -> DataFrame:
    """Read CSV, with a header unless said otherwise; no type is guessed.

    The header must name the columns in this order, or reading fails.  With
    ``corrupt_column`` a line with too few or too many fields is kept whole in
    ``_corrupt_record``, whichever columns a query then selects: without it such
    a line is cut or filled up.  Line breaks inside quotes need ``multi_line``, which
    makes every file one task, so it is off by default.  ``with_position``
    adds the file, block and row that a row came from, to order rows by;
    ``source_row`` is unique, and as it follows from the split of the files it
    is the same when a lost task is run again.
    """
    schema = text_schema(columns)
    if corrupt_column:
        schema = schema.add(CORRUPT, T.StringType())
    df = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        # Only a line that is parsed whole is known to be malformed.
        .option("columnPruning", not corrupt_column)
        .csv(path)
    )
    if not with_position:
        return df
    return df.select(
        "*",
        F.expr(r"try_cast(regexp_extract(_metadata.file_name, '[0-9]+', 0) AS decimal(38, 0))").alias(
            SOURCE_NUMBER
        ),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias(SOURCE_BLOCK),
        F.monotonically_increasing_id().alias(SOURCE_ROW),
    )


def write_text_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header that ``read_text_csv`` reads back unchanged,
    padding and quotes included.  CSV knows no difference between empty and
    missing: both are read back as NULL."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report_csv(report: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header, in its order.

    Only for reports: one line per rule or shape, not per row.
    """
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
