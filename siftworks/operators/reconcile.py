"""Reconciliation of found keys against a ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership(found: DataFrame, truth: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every distinct key of either side, with ``in_found`` and ``in_truth``.

    The sides are stacked and grouped: one shuffle, in which repeats of a hot
    key are combined beforehand, and NULL keys match each other.
    """

    def side(df: DataFrame, is_found: bool) -> DataFrame:
        return df.select(
            *on, F.lit(is_found).alias("in_found"), F.lit(not is_found).alias("in_truth")
        )

    return (
        side(found, True)
        .unionByName(side(truth, False))
        .groupBy(*on)
        .agg(F.max("in_found").alias("in_found"), F.max("in_truth").alias("in_truth"))
    )


def matched(found: DataFrame, truth: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys on both sides."""
    both = F.col("in_found") & F.col("in_truth")
    return membership(found, truth, on).filter(both).select(*on)


def false_positives(found: DataFrame, truth: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys that were found but are not in the truth."""
    return membership(found, truth, on).filter(~F.col("in_truth")).select(*on)


def false_negatives(found: DataFrame, truth: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of the truth that were not found."""
    return membership(found, truth, on).filter(~F.col("in_found")).select(*on)


def summary(found: DataFrame, truth: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: keys per side, matched, and on one side only."""
    return membership(found, truth, on).agg(
        F.count_if("in_truth").alias("truth_keys"),
        F.count_if("in_found").alias("found_keys"),
        F.count_if(F.col("in_found") & F.col("in_truth")).alias("matched"),
        F.count_if(~F.col("in_truth")).alias("only_found"),
        F.count_if(~F.col("in_found")).alias("only_truth"),
    )


def by_label(found: DataFrame, truth: DataFrame, key: str, label: str) -> DataFrame:
    """Per label: (key, label) pairs per side, matched, precision and recall."""
    pairs = membership(found, truth, [key, label])
    hits = F.count_if(F.col("in_found") & F.col("in_truth"))
    return pairs.groupBy(label).agg(
        F.count_if("in_truth").alias("truth_rows"),
        F.count_if("in_found").alias("found_rows"),
        hits.alias("matched"),
        F.try_divide(hits, F.count_if("in_found")).alias("precision"),
        F.try_divide(hits, F.count_if("in_truth")).alias("recall"),
    )
