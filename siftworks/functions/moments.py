"""Timestamp expressions on wall-clock times (``timestamp_ntz``).

None of them depends on the session time zone: a feed's local times are taken
as written, also those inside a daylight-saving gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(text: str) -> Column:
    """A ``timestamp_ntz`` literal."""
    return F.lit(text).cast("timestamp_ntz")


ISO_FORMAT = "yyyy-MM-dd HH:mm:ss"
_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def separators(fmt: str) -> str | None:
    """A regular expression that every text in this format matches.

    It asks for the literal characters of the format in their order, in either
    case as the formatter does, and needs no backtracking.  None for formats
    with optional sections.
    """
    pieces = fmt.split("'")
    if len(pieces) % 2 == 0 or "" in pieces[1::2] or not fmt.isascii() or set(fmt) & set("[]"):
        return None
    pattern = "^"
    for place, piece in enumerate(pieces):
        quoted = place % 2 == 1
        for ch in piece:
            if ch.isalpha() and not quoted:
                continue
            either = ch.lower() + ch.upper() if ch.isalpha() else ch if ch.isdigit() else f"\\{ch}"
            pattern += f"[^{either}]*[{either}]"
    return pattern


def _read_as(c: Column, fmt: str) -> Column:
    """The instant of a text that is taken as UTC, NULL if it does not fit."""
    instant = F.try_to_timestamp(F.concat(c, F.lit(" Z")), F.lit(f"{fmt} X"))
    pattern = separators(fmt)
    return F.when(c.rlike(pattern), instant) if pattern else instant


def parse_timestamp(c: Column, formats: Sequence[str]) -> Column:
    """The first format that reads the whole text wins, else NULL.

    The text is read as UTC, so that no session zone can shift it, and the
    instant is then turned into the wall-clock time it was written as.

    A failed attempt costs an exception inside the formatter, some ten times a
    successful one, so a format is only tried on text with its separators.
    Text in the usual ISO form, if that format comes first, is cast instead.
    """
    instant = F.coalesce(*[_read_as(c, f) for f in formats])
    parsed = F.timestamp_add("SECOND", F.unix_seconds(instant), wall_clock("1970-01-01 00:00:00"))
    if formats[0] == ISO_FORMAT:
        return F.coalesce(F.when(c.rlike(_ISO_SHAPE), c.try_cast("timestamp_ntz")), parsed)
    return parsed


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end as bigint."""
    return (end - start).cast("interval second").cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Duration in minutes with its fraction."""
    return seconds_between(start, end) / 60


def minute_boundaries(start: Column, end: Column) -> Column:
    """How many full minutes of the clock lie between two whole-second times.

    10:00:59 to 10:01:00 is 1, and back is -1; it is not the elapsed time.
    """

    def minute(t: Column) -> Column:
        return F.floor(seconds_between(wall_clock("1970-01-01 00:00:00"), t) / 60)

    return (minute(end) - minute(start)).cast("bigint")

