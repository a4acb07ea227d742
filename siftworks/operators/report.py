"""Failure reports over tagged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.shares import percent
from siftworks.operators.rules import REASONS, Rule


def reasons_listed(quarantined: DataFrame) -> DataFrame:
    """Rows per reason, most frequent first, from the arrays of reasons."""
    return (
        quarantined.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("reason"))
    )


def rule_counts(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates over all checked rows, clean ones too: their number as ``total``
    and the failures of each rule under its name.  Nothing is exploded, and each
    task sends one row."""
    return [
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(r.violated()).alias(r.name) for r in rules],
    ]


def failure_report(
    checked: DataFrame, rules: Sequence[Rule], include_zero: bool = False
) -> DataFrame:
    """Per rule: rows that break it and their share of all checked rows, from the
    rows before or after tagging."""
    return report_from_counts(checked.agg(*rule_counts(rules)), rules, include_zero)


def report_from_counts(
    counted: DataFrame, rules: Sequence[Rule], include_zero: bool = False
) -> DataFrame:
    """The report from one row of ``rule_counts``.  Rules that no row breaks are left
    out unless asked for."""
    lines = F.array(
        *[F.struct(F.lit(r.name).alias("reason"), F.col(r.name).alias("count")) for r in rules]
    )
    report = counted.select("total", F.inline(lines))
    if not include_zero:
        report = report.filter(F.col("count") > 0)
    return report.select(
        "reason",
        "count",
        percent(F.col("count"), F.col("total"), 2).alias("pct_of_input"),
    ).orderBy(F.desc("count"), F.asc("reason"))


def failure_report_from_reasons(quarantined: DataFrame, total_rows: int) -> DataFrame:
    """The same report when only the quarantine and the total are at hand."""
    return reasons_listed(quarantined).select(
        "reason",
        "count",
        percent(F.col("count"), F.lit(total_rows), 2).alias("pct_of_input"),
    ).orderBy(F.desc("count"), F.asc("reason"))
