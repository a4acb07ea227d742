"""Profiles: nulls, shapes, distinct values, frequencies, a peek."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.text import shape


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many NULLs each column holds (0 on empty input)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named text columns as (column, value) rows, from one scan."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")


def shape_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column and shape: how many rows, and the smallest value as example.

    All columns are profiled in one pass; shapes are combined before the
    shuffle, so its size follows the number of shapes and not of rows.
    """
    return (
        _values(df, columns)
        .groupBy("column", shape(F.col("value")).alias("shape"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("value").alias("example_value"),
        )
    )


def top_shapes(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The n most frequent shapes of one column, ties in order of the shape."""
    return (
        shape_counts(df, [column])
        .drop("column")
        .orderBy(F.desc("row_count"), F.asc("shape"))
        .limit(n)
    )


def _distinct(c: str) -> Column:
    """Distinct values, where NULL is one of them."""
    return F.count_distinct(F.col(c)) + F.coalesce(
        F.max(F.col(c).isNull().cast("int")), F.lit(0)
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: exact distinct values per column, NULL counted as a value."""
    return df.agg(*[_distinct(c).cast("bigint").alias(c) for c in columns])


def approx_distinct_counts(
    df: DataFrame, columns: Sequence[str], rsd: float = 0.02
) -> DataFrame:
    """As ``distinct_counts`` but from sketches: no values are shuffled."""
    return df.agg(
        *[
            (
                F.approx_count_distinct(c, rsd)
                + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
            ).alias(c)
            for c in columns
        ]
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; NULL is a group."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def column_overview(df: DataFrame) -> DataFrame:
    """Per column: its place, name, type, rows, NULLs and distinct values.

    Values are counted per column first, combined before the shuffle, and the columns
    then: a row is not copied for each distinct count.  Values are compared as text.
    """
    fields = df.schema.fields
    names = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields, 1)],
        "position int, column string, type string",
    )
    per_column = (
        _values(df.select(*[F.col(f.name).cast("string") for f in fields]), df.columns)
        .groupBy(F.col("column").alias("_column"), "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("_column")
        .agg(
            F.sum("n").alias("row_count"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count(F.lit(1)).alias("distinct_values"),
        )
    )
    counts = ["row_count", "nulls", "distinct_values"]
    return names.join(per_column, F.col("column") == F.col("_column"), "left").select(
        "position", "column", "type", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]
    )


def peek(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows in an order."""
    return df.orderBy(*order_by).limit(n)
