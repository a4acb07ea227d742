"""One row per key, with a survivor that does not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NullKeys = Literal["keep", "collapse"]

# Filled in rows that only say how many rows were read, and of which part of the input.
TALLY = "rows_read"
TALLY_OF = "read_from"


def _key_is_null(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])


def _groups(
    key: Sequence[str], row_id: str | None, null_keys: NullKeys, alone: Column | None = None
) -> list[Column]:
    """The grouping columns: the key, and for rows without one their own id.

    The id makes every keyless row its own group, so they all survive and
    spread over the cluster instead of meeting in one task.  So are the rows
    for which ``alone`` holds.
    """
    columns = [F.col(c) for c in key]
    apart = F.lit(False) if alone is None else alone
    if null_keys == "keep":
        apart = apart | _key_is_null(key)
    elif alone is None:
        return columns
    return [*columns, F.when(apart, F.col(row_id))]


def keep_first(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    row_id: str | None = None,
    null_keys: NullKeys = "keep",
    alone: Column | None = None,
) -> DataFrame:
    """The first row of each key in the given order.

    Spark turns ``row_number() = 1`` into a group limit before the shuffle, so
    each task sends at most one row per key, however often a key occurs, and
    unused columns are pruned.  Rows that tie on ``order_by`` are broken by
    ``row_id`` if given, else arbitrarily.

    ``null_keys``: ``keep`` leaves rows without a key alone (in the same pass
    when ``row_id`` names a unique column, else by a second branch over the
    input); ``collapse`` treats NULL as one more key value.  Rows for which
    ``alone`` holds are compared with none; that needs ``row_id``.
    """
    if null_keys == "keep" and row_id is None:
        keyed = keep_first(df.filter(~_key_is_null(key)), key, order_by, null_keys="collapse")
        return keyed.unionByName(df.filter(_key_is_null(key)))
    order = [*order_by, *([row_id] if row_id and row_id not in order_by else [])]
    window = Window.partitionBy(*_groups(key, row_id, null_keys, alone)).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def collapse_copies(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    row_id: str,
    copies_column: str = "copies",
    null_keys: NullKeys = "keep",
) -> DataFrame:
    """``keep_first`` that also says how many rows each survivor stands for.

    The number of rows before deduplication is then the sum of that column:
    data that a retried stage cannot count twice, unlike an accumulator.  One
    aggregate with map-side combine; it carries whole rows, so it suits jobs
    that store them all.
    """
    order = F.struct(*order_by, *([row_id] if row_id not in order_by else []))
    groups = [g.alias(f"_group_{i}") for i, g in enumerate(_groups(key, row_id, null_keys))]
    return (
        df.groupBy(*groups)
        .agg(
            F.min_by(F.struct(*df.columns), order).alias("_first"),
            F.count(F.lit(1)).alias(copies_column),
        )
        .select("_first.*", copies_column)
    )


def first_and_tally(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    row_id: str,
    null_keys: NullKeys = "keep",
    alone: Column | None = None,
    part_of: Column | None = None,
) -> DataFrame:
    """``keep_first``, and in the same pass how many rows were read from each part.

    Every row is followed by a row that only counts, whose group is the part of the input it
    came from (``part_of``, such as its file).  These are combined before the shuffle, so a
    task sends one for each part it read, and what comes out is one row for each part with
    ``rows_read`` and ``read_from`` filled and all other columns empty.  The counts are data
    of the same job and not accumulators: a task that runs again cannot count twice, and
    the input is read once.
    """
    columns = df.columns
    order = F.struct(*order_by, *([row_id] if row_id not in order_by else []))
    part = F.lit("") if part_of is None else F.coalesce(part_of.cast("string"), F.lit(""))
    groups = [g.alias(f"_group_{i}") for i, g in enumerate(_groups(key, row_id, null_keys, alone))]
    names = [f"_group_{i}" for i in range(len(groups))]
    with_groups = df.select(*groups, F.struct(*columns).alias("_row"), order.alias("_order"), part.alias("_part"))
    none = [F.lit(None).cast(with_groups.schema[n].dataType).alias(n) for n in names]
    row = F.struct(*names, "_row", "_order", F.lit(None).cast("string").alias("_part"))
    tally = F.struct(
        *none,
        F.lit(None).cast(with_groups.schema["_row"].dataType).alias("_row"),
        F.lit(None).cast(with_groups.schema["_order"].dataType).alias("_order"),
        F.col("_part"),
    )
    return (
        with_groups.select(F.inline(F.array(row, tally)))
        .groupBy(*names, "_part")
        .agg(F.min_by("_row", "_order").alias("_first"), F.count("_part").alias("_read"))
        .select(
            "_first.*",
            F.when(F.col("_part").isNotNull(), F.col("_read")).alias(TALLY),
            F.col("_part").alias(TALLY_OF),
        )
    )


def later_occurrences(df: DataFrame, key: str, row_number: str) -> DataFrame:
    """The rows that repeat a key already seen at a smaller row number.

    The first number per key is a hash aggregate with map-side combine.  The
    anti join then runs on the unique row number and not on the key, so a key
    with a third of all rows still spreads evenly.  Rows without a key repeat
    nothing.
    """
    keyed = df.filter(F.col(key).isNotNull())
    firsts = keyed.groupBy(key).agg(F.min(row_number).alias(row_number)).select(row_number)
    return keyed.join(firsts, row_number, "left_anti")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, one row each."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(key)
    )


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows in, rows out and the difference; rows without a key are kept."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    kept = F.when(F.col(key).isNull(), F.col("n")).otherwise(1)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("rows_out"),
        F.coalesce(F.sum(F.col("n") - kept), F.lit(0)).alias("duplicates_removed"),
    )
