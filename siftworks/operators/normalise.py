"""Row-wise normalisation steps, for ``DataFrame.transform``.

Each step is one projection, so that chained steps stay inside one stage.
Columns that a step does not name pass through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.functions import moments, text


def markers_to_null(df: DataFrame, columns: Sequence[str], markers: Sequence[str]) -> DataFrame:
    """Trim the columns and turn missing-value spellings into NULL."""
    return df.withColumns({c: text.blank_to_null(F.col(c), markers) for c in columns})


def canonicalise(df: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Spell each named column as its reference list does."""
    return df.withColumns({c: text.canonical_case(F.col(c), v) for c, v in values.items()})


def parse_timestamps(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """Text columns in mixed formats become wall-clock timestamps."""
    return df.withColumns({c: moments.parse_timestamp(F.col(c), formats) for c in columns})


def fill_default(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """NULL becomes the default value."""
    return df.fillna(value, subset=list(columns))


def fix_codes(
    df: DataFrame,
    decimal_columns: Sequence[str],
    code_column: str,
    code_pattern: str,
    flag_column: str,
    default_columns: Sequence[str],
    default: str,
) -> DataFrame:
    """Strip ``.0`` suffixes, check and flag a code, fill defaults."""
    code = F.col(code_column)
    return df.withColumns(
        {
            **{c: text.strip_decimal_suffix(F.col(c)) for c in decimal_columns},
            flag_column: text.code_flag(code, code_pattern),
            code_column: text.normalised_code(code, code_pattern),
        }
    ).transform(fill_default, default_columns, default)
