"""Rollups by period that answer for any span of periods without the rows.

A period (a day, a month) is aggregated once, when its rows arrive, and stored; quantiles
and distinct counts of a week, a year or all time then merge what was stored.  Adding a
period again replaces it, so a failed load is just run again.

Exact forms: quantiles from counts per value, for values with a bounded number of different
ones (whole minutes, quantities), and distinct integer keys from bitmaps, 32,768 keys to a
row.  Sketched forms, of bounded size whatever the values: KLL for quantiles, HLL for
distinct counts of anything.  NULL values and keys count nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = "period"


def store(rollup: DataFrame, folder: str) -> None:
    """Write whole periods; those that the rollup does not have stay as they are."""
    (
        rollup.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PERIOD)
        .parquet(folder)
    )


def stored(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The stored rollup; a filter on the period opens the folders of that span only."""
    return spark.read.schema(like.schema).parquet(folder)


def value_counts(df: DataFrame, period: Column, value: Column, *groups: str) -> DataFrame:
    """(period, groups, value, n): rows per value, combined before the shuffle."""
    return (
        df.select(period.cast("string").alias(PERIOD), *groups, value.alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy(PERIOD, *groups, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(counts: DataFrame, fractions: Sequence[float], *groups: str | Column) -> DataFrame:
    """(groups, n, quantiles): exact, interpolated between neighbours, over all periods given."""
    at = F.array(*[F.lit(float(f)) for f in fractions])
    merged = counts.groupBy(*groups, "value").agg(F.sum("n").alias("n"))
    names = merged.columns[: len(groups)]
    return merged.groupBy(*names).agg(
        F.sum("n").alias("n"), F.percentile("value", at, F.col("n")).alias("quantiles")
    )


def key_bits(df: DataFrame, period: Column, key: Column, *groups: str) -> DataFrame:
    """(period, groups, bucket, bits): which integer keys occur, one bit each."""
    key = key.cast("bigint")
    return (
        df.select(
            period.cast("string").alias(PERIOD),
            *groups,
            F.bitmap_bucket_number(key).alias("bucket"),
            F.bitmap_bit_position(key).alias("at"),
        )
        .filter(F.col("bucket").isNotNull())
        .groupBy(PERIOD, *groups, "bucket")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )


def distinct_keys(bits: DataFrame, *groups: str | Column) -> DataFrame:
    """(groups, distinct_keys): exact over all periods given."""
    merged = bits.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = merged.columns[: len(groups)]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias("distinct_keys"))


def sketches(df: DataFrame, period: Column, value: Column, *groups: str) -> DataFrame:
    """(period, groups, quantile_sketch, distinct_sketch), one small row each."""
    return (
        df.select(period.cast("string").alias(PERIOD), *groups, value.alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy(PERIOD, *groups)
        .agg(
            F.kll_sketch_agg_double(F.col("value").cast("double")).alias("quantile_sketch"),
            F.hll_sketch_agg(F.col("value").cast("string")).alias("distinct_sketch"),
        )
    )


def distinct_estimate(found: DataFrame, *groups: str | Column) -> DataFrame:
    """(groups, distinct_values): the union of the sketches of all periods given."""
    union = F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch"))
    return found.groupBy(*groups).agg(union.alias("distinct_values"))


def quantile_estimates(found: DataFrame, fractions: Sequence[float], *groups: str | Column) -> DataFrame:
    """(groups, n, quantiles): values whose rank is near that of the fraction.

    Sketches are merged one into the next; there is one of bounded size for each period.
    """
    fold = F.aggregate(
        F.slice("all", F.lit(2), F.greatest(F.size("all") - 1, F.lit(0))),
        F.element_at("all", 1),
        lambda merged, one: F.kll_sketch_merge_double(merged, one),
    )
    merged = found.groupBy(*groups).agg(F.collect_list("quantile_sketch").alias("all"))
    names = merged.columns[: len(groups)]
    return merged.select(*names, fold.alias("one")).select(
        *names,
        F.kll_sketch_get_n_double("one").alias("n"),
        F.array(*[F.kll_sketch_get_quantile_double("one", F.lit(float(f))) for f in fractions]).alias("quantiles"),
    )
