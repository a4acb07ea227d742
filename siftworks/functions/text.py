"""Text expressions: missing markers, case, codes and shapes."""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column, markers: Sequence[str]) -> Column:
    """Trim spaces; a value that spells "missing" in any case becomes NULL."""
    trimmed = F.trim(c)
    return F.when(~F.lower(trimmed).isin(*markers), trimmed)


def canonical_case(c: Column, values: Sequence[str]) -> Column:
    """Spell a value as the reference list does; other values pass unchanged.

    The list becomes one folded literal map, searched per row, so it is meant
    for short lists; ``operators.lookup`` joins long ones.
    """
    spelling = F.create_map(*[F.lit(x) for v in values for x in (v.lower(), v)])
    return F.coalesce(spelling[F.lower(c)], c)


def strip_decimal_suffix(c: Column) -> Column:
    """Drop one trailing ``.0``: ``3.0`` becomes ``3``, ``3.00`` stays."""
    return F.regexp_replace(c, r"\.0\z", "")


def has_decimal_suffix(c: Column) -> Column:
    return c.rlike(r"\.0\z")


def code_flag(c: Column, pattern: str) -> Column:
    """``missing``, ``malformed``, or NULL for a code that fits the pattern."""
    return F.when(c.isNull(), "missing").when(~F.upper(c).rlike(pattern), "malformed")


def normalised_code(c: Column, pattern: str) -> Column:
    """The code in upper case, NULL when it does not fit the pattern."""
    code = F.upper(c)
    return F.when(code.rlike(pattern), code)


def shape(c: Column) -> Column:
    """Digits become ``9``, ASCII letters ``X``; the rest stays.

    ``translate`` maps characters in one pass and costs about half of two
    regular expressions.
    """
    return F.translate(c, digits + ascii_letters, "9" * len(digits) + "X" * len(ascii_letters))


def is_padded(c: Column) -> Column:
    """The text has leading or trailing spaces."""
    return c != F.trim(c)
