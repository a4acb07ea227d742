"""The cleaning chain of the attendance feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.operators import normalise as n
from siftworks.operators.dedupe import NullKeys, first_and_tally, keep_first
from siftworks.operators.rules import Rule, passing
from siftworks.sources.text_csv import CORRUPT, SOURCE_FILE

ORIGINAL = "original"


def keep_original(raw: DataFrame, columns: Sequence[str] = a.RAW_COLUMNS) -> DataFrame:
    """Carry the untouched text along, so that a quarantined row still shows
    the value that could not be read, and a malformed line is there whole."""
    line = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    return raw.withColumn(ORIGINAL, F.struct(*columns, line.alias("line")))


def without_malformed_values(raw: DataFrame) -> DataFrame:
    """No value of a malformed line counts: its fields may stand in wrong columns.

    That goes for the key too, so no good row is taken for its copy.
    """
    if CORRUPT not in raw.columns:
        return raw
    good = F.col(CORRUPT).isNull()
    return raw.withColumns({c: F.when(good, F.col(c)) for c in a.RAW_COLUMNS})


def blanks_to_null(raw: DataFrame) -> DataFrame:
    return n.markers_to_null(raw, a.RAW_COLUMNS, a.MISSING_MARKERS)


def standard_text(df: DataFrame) -> DataFrame:
    return n.canonicalise(
        df, {"presenting_complaint": a.COMPLAINTS, "disposition": a.DISPOSITIONS}
    )


def parsed_times(df: DataFrame) -> DataFrame:
    return n.parse_timestamps(df, ["arrival_time", "departure_time"], a.TIMESTAMP_FORMATS)


def fixed_codes(df: DataFrame) -> DataFrame:
    return n.fix_codes(
        df,
        decimal_columns=["triage_category"],
        code_column="gp_practice_code",
        code_pattern=a.GP_CODE_PATTERN,
        flag_column="gp_code_flag",
        default_columns=["presenting_complaint", "disposition"],
        default=a.UNKNOWN,
    )


def normalised(raw: DataFrame) -> DataFrame:
    """All row-wise steps; further columns pass through."""
    return (
        raw.transform(without_malformed_values)
        .transform(blanks_to_null)
        .transform(standard_text)
        .transform(parsed_times)
        .transform(fixed_codes)
    )


def deduplicated(
    df: DataFrame, order_by: Sequence[str], row_id: str | None, null_keys: NullKeys = "keep"
) -> DataFrame:
    """The first row of each attendance; malformed lines are copies of nothing."""
    alone = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else None
    return keep_first(df, [a.KEY], order_by, row_id, null_keys, alone)


def deduplicated_with_tally(
    df: DataFrame, order_by: Sequence[str], row_id: str, null_keys: NullKeys = "keep"
) -> DataFrame:
    """``deduplicated``, and one row for each input file with the rows read from it.

    A feed that does not say where its rows are from is one part.
    """
    alone = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else None
    part = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else None
    return first_and_tally(df, [a.KEY], order_by, row_id, null_keys, alone, part)


def checked_rows(raw: DataFrame, order_by: Sequence[str], row_id: str | None) -> DataFrame:
    """Normalised rows, one per attendance, that the rules are to judge."""
    return raw.transform(normalised).transform(deduplicated, order_by, row_id)


def clean_rows(
    raw: DataFrame, order_by: Sequence[str], row_id: str | None, rules: Sequence[Rule]
) -> DataFrame:
    return (
        checked_rows(raw, order_by, row_id).transform(passing, rules).select(*a.CLEAN_COLUMNS)
    )
