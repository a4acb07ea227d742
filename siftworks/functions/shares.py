"""Shares of a total."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, total: Column, digits: int) -> Column:
    """``100 * part / total`` rounded half up; NULL when the total is 0.

    Rounding a decimal, not a double, keeps 0.145 from becoming 0.14.
    """
    exact = F.try_divide(100 * part, total).cast("decimal(38,10)")
    return F.round(exact, digits).cast("double")
