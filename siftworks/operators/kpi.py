"""KPIs over a clean table, as DataFrames and as views.

Stays are counted in whole clock minutes.  Medians come from a histogram of
stay lengths, so rows are combined before the shuffle and the exact median
sees at most one row per group and minute: in a clean table no more than the
longest allowed stay has minutes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.moments import minute_boundaries
from siftworks.functions.shares import percent


def stay_minutes() -> Column:
    return minute_boundaries(F.col("arrival_time"), F.col("departure_time"))


def breach_rate(clean: DataFrame, threshold_minutes: int) -> DataFrame:
    """One row: all stays, those above the threshold, and their share."""
    over = F.count_if(stay_minutes() > threshold_minutes)
    return clean.agg(F.count(F.lit(1)).alias("total_attendances"), over.alias("breaches")).select(
        "total_attendances",
        "breaches",
        percent(F.col("breaches"), F.col("total_attendances"), 1).alias("breach_rate_pct"),
    )


def stay_histogram(clean: DataFrame, *groups: str) -> DataFrame:
    """Rows per group and stay in minutes."""
    return clean.groupBy(*groups, stay_minutes().alias("los_minutes")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _median() -> Column:
    return F.round(F.percentile("los_minutes", F.lit(0.5), F.col("n")), 0)


def stay_by(clean: DataFrame, group: str) -> DataFrame:
    """Per group: rows, average and exact median stay, in order of the group."""
    mean = F.try_divide(
        F.sum(F.col("los_minutes") * F.col("n")),
        F.sum(F.when(F.col("los_minutes").isNotNull(), F.col("n"))),
    )
    return (
        stay_histogram(clean, group)
        .groupBy(group)
        .agg(
            F.sum("n").alias("attendances"),
            F.round(mean, 0).alias("avg_los_minutes"),
            _median().alias("median_los_minutes"),
        )
        .orderBy(group)
    )


def overall_median(clean: DataFrame) -> DataFrame:
    return stay_histogram(clean).agg(_median().alias("median_los_minutes"))


def approx_stay_by(clean: DataFrame, group: str, accuracy: int = 10_000) -> DataFrame:
    """As ``stay_by`` with an approximate median, for unbounded stays."""
    stays = clean.select(group, stay_minutes().alias("los_minutes"))
    return (
        stays.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("attendances"),
            F.round(F.avg("los_minutes"), 0).alias("avg_los_minutes"),
            F.percentile_approx("los_minutes", 0.5, accuracy).alias("median_los_minutes"),
        )
        .orderBy(group)
    )


def arrivals_by_hour(clean: DataFrame) -> DataFrame:
    """Rows per hour of arrival, in order; hours without rows are absent."""
    return (
        clean.groupBy(F.hour("arrival_time").alias("arrival_hour"))
        .agg(F.count(F.lit(1)).alias("attendances"))
        .orderBy("arrival_hour")
    )


def register_views(clean: DataFrame, threshold_minutes: int) -> None:
    """Create or replace the three KPI views in the session of ``clean``."""
    breach_rate(clean, threshold_minutes).createOrReplaceTempView("v_four_hour_breach")
    stay_by(clean, "triage_category").createOrReplaceTempView("v_los_by_triage")
    arrivals_by_hour(clean).createOrReplaceTempView("v_arrivals_by_hour")
