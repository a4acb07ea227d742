"""Consecutive row numbers over a whole table without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window


def number_rows(
    df: DataFrame,
    spread_by: str,
    span: int,
    then_by: Sequence[str],
    as_column: str,
    buckets: int = 256,
) -> DataFrame:
    """Number the rows from 1 in the order of ``spread_by``, then ``then_by``.

    ``spread_by`` is a hash-like bigint in [0, span).  It is cut into equal
    ranges; the rows of the ranges before give each range its offset, and each
    range is numbered by itself.  The job chooses ``buckets`` by its data, so
    that the rows of one range sort in a task.  Values outside the span are
    numbered in order like all others, at the cost of the first or last range,
    and NULL comes first.  The input is read twice, for the counts and for the
    numbers, so it must be a stored table or derived from one without chance.
    """
    width = -(-span // buckets)
    inside = F.floor(F.col(spread_by) / F.lit(width))
    nth = F.greatest(F.lit(-1), F.least(F.lit(buckets), inside)).cast("int")
    # greatest() and least() pass over NULL, which needs a range of its own.
    ranged = df.withColumn("_range", F.when(F.col(spread_by).isNull(), -2).otherwise(nth))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_range").orderBy(spread_by, *then_by)
    return (
        ranged.withColumn("_place", F.row_number().over(within))
        .join(F.broadcast(offsets), "_range")  # buckets + 3 rows at most
        .withColumn(as_column, F.col("_offset") + F.col("_place"))
        .drop("_range", "_place", "_offset")
    )


# monotonically_increasing_id() has the place within a partition in its lower bits.
_PLACE_BITS = 33


def number_in_order(
    df: DataFrame, order_by: Sequence[str | Column], as_column: str, folder: str, ranges: int = 256
) -> DataFrame:
    """Number the rows from 1 in any order: times, texts, several columns, descending ones.

    Spark samples the order and splits the rows into ranges of like size; a row's place in
    the input breaks ties last, so a value that a third of all rows share is split over
    several ranges like any other.  Ranges are sorted where they arrive and stored in
    ``folder``, a new one, with the range and the place of each row; one narrow read
    counts the ranges, and the counts, one row per range, give each range its offset.

    NULL comes first in ascending and last in descending order.  Rows that tie in all of
    ``order_by`` are numbered in some order among themselves, once and for all, as
    numbers are read from the stored rows.  The names ``_tie``, ``_at``, ``_range`` and
    ``_offset`` must be free.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    (
        rows.repartitionByRange(ranges, *order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    schema = StructType([*df.schema.fields, StructField("_at", LongType())])
    stored = df.sparkSession.read.schema(schema).parquet(folder)
    ranged = stored.withColumn("_range", F.shiftright("_at", _PLACE_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    return (
        ranged.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn(as_column, F.col("_offset") + place)
        .select(*df.columns, as_column)
    )
