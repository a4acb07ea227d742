"""Left lookup of values in a dimension table, and membership checks.

All joins are plain: Spark broadcasts a side by its size in bytes and splits the
partitions of hot values on the side of the rows.  No job runs while a query is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame, wanted: Column, dim: DataFrame, key: str, value: str, as_column: str
) -> DataFrame:
    """Add the dimension's value for each row, NULL when there is none.

    ``dim`` must hold each key once.
    """
    entries = dim.select(F.col(key).alias("_key"), F.col(value).alias(as_column))
    return df.withColumn("_key", wanted).join(entries, "_key", "left").drop("_key")


def members(
    df: DataFrame, wanted: Column, keys: DataFrame, key: str, outside: bool = False
) -> DataFrame:
    """The rows whose value is among the keys, or with ``outside`` is not.

    A missing value is neither inside nor outside, as with ``isin``; the keys
    may repeat.
    """
    how = "left_anti" if outside else "left_semi"
    entries = keys.select(F.col(key).alias("_key"))
    rows = df.filter(wanted.isNotNull()).withColumn("_key", wanted)
    return rows.join(entries, "_key", how).drop("_key")
