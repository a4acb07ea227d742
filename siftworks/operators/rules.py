"""Row validation: declared rules, reasons per row, clean and quarantined rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.moments import minutes_between, wall_clock

REASONS = "failure_reasons"


@dataclass(frozen=True)
class Rule:
    """A name and a predicate that is true for rows that break the rule.

    The predicate is built on use, as columns need a running session.  NULL
    counts as "does not break it".
    """

    name: str
    violated: Callable[[], Column]

    def reason(self) -> Column:
        return F.when(self.violated(), self.name)


def is_missing(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).isNull()


def is_present(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).isNotNull()


def unless(excused: Callable[[], Column], rule: Rule) -> Rule:
    """The rule, for rows that are not excused from it."""
    return Rule(rule.name, lambda: ~excused() & rule.violated())


def precedes(earlier: str, later: str) -> Callable[[], Column]:
    """Both are present and the first lies strictly before the second."""
    return lambda: F.col(earlier) < F.col(later)


def not_in(column: str, allowed: Sequence[str], null_fails: bool = False) -> Callable[[], Column]:
    """The value is not in the domain; NULL fails only on request."""

    def violated() -> Column:
        outside = ~F.col(column).isin(*allowed)
        return outside | F.col(column).isNull() if null_fails else outside

    return violated


def outside_period(column: str, start: str, end: str) -> Callable[[], Column]:
    """A present time lies outside the half-open period [start, end)."""
    return lambda: (F.col(column) < wall_clock(start)) | (F.col(column) >= wall_clock(end))


def lasts_longer_than(start: str, end: str, minutes: int) -> Callable[[], Column]:
    """Both are present and lie strictly more than so many minutes apart."""
    return lambda: minutes_between(F.col(start), F.col(end)) > minutes


def any_violated(rules: Sequence[Rule]) -> Column:
    """True when some rule is broken, otherwise false, never NULL."""
    return reduce(
        lambda a, b: a | b, [F.coalesce(r.violated(), F.lit(False)) for r in rules], F.lit(False)
    )


def tag_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the names of all broken rules, in rule order, as an array."""
    return df.withColumn(REASONS, F.array_compact(F.array(*[r.reason() for r in rules])))


def is_clean() -> Column:
    """Of tagged rows: no rule is broken."""
    return F.size(REASONS) == 0


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows without the reasons, and quarantined rows with them.

    Two filters over one lineage: give it a stored table when both sides are
    to be used, or the rows are tagged twice.
    """
    return tagged.filter(is_clean()).drop(REASONS), tagged.filter(~is_clean())


def passing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only the rows that break no rule, without building any reasons.

    Cheaper than tagging when the quarantine is not wanted: the predicates
    stay plain boolean code and only the columns they name are read.
    """
    return df.filter(~any_violated(rules))
