"""The messy attendance feed, derived from the ``events`` table.

Every event becomes one good attendance; then faults are planted on rows
picked by the residue of ``event_id``.  Structural faults use disjoint residues
of one modulus, so a row carries at most one of them, save the added slot 24.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.operators.faults import (
    Fault,
    Pick,
    add_copies,
    answer_key,
    inject,
    log_faults,
    one_of,
    with_residues,
    write_in_formats,
)
from siftworks.operators.numbering import number_rows

EVENT = "event_id"
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint"

# All events of the given tables lie in this year.
FEED_YEAR = 2024

# Order of the feed: a permutation of the rows by a linear congruence.
ORDER_SPAN = 2**31
FEED_ORDER = ["feed_order", "source_row"]
ROW_ID = "source_row"

# Spellings of "no value" and invalid codes that are written.
WRITTEN_MARKERS = ["", "NULL", "N/A", "n/a", "-"]
INVALID_TRIAGE_CODES = ["0", "6", "9", "99", "X", "-1"]


def _slot(*residues: int) -> Pick:
    return Pick(97, residues)


def _noise(modulus: int, residue: int, *not_in_slots: int) -> Pick:
    return Pick(modulus, (residue,), _slot(*not_in_slots))


def _untidy(kind: str) -> str:
    """What the list lookup has to see through: a tail in capitals, only the
    first letter small, or blanks on one side, as many as the row says."""
    return (
        f"CASE {kind} WHEN 0 THEN concat(left({{value}}, 2), upper(substring({{value}}, 3))) "
        "WHEN 1 THEN concat(lower(left({value}, 1)), substring({value}, 2)) "
        f"ELSE concat({{value}}, repeat(' ', CAST(1 + {EVENT} % 4 AS INT))) END"
    )


def _stay(minutes: str) -> str:
    return f"timestampadd(MINUTE, {minutes}, arrival)"


def _missing(column: str, error_type: str, *slots: int) -> Fault:
    return Fault(error_type, (column,), _slot(*slots), one_of(WRITTEN_MARKERS, EVENT))


# 7 is prime to 100, so these residues hold 6, 5 and 4 of 100 rows.
MIXED_FORMATS = [
    (Pick(100, tuple(e for e in range(100) if low <= e * 7 % 100 < high)), pattern)
    for low, high, pattern in zip((85, 91, 96), (91, 96, 100), a.TIMESTAMP_FORMATS[1:])
]

MISSING_FAULTS = [
    _missing("arrival_time", "missing_arrival_time", 0, 24),
    _missing("departure_time", "missing_departure_time", 1, 2),
    _missing("pseudo_patient_id", "missing_patient_id", 9),
    _missing("gp_practice_code", "missing_gp_code", *range(12, 18)),
    _missing("presenting_complaint", "missing_presenting_complaint", *range(18, 22)),
    _missing("disposition", "missing_disposition", 22, 23),
]

INVALID_CODE_FAULTS = [
    Fault(
        "invalid_triage_code",
        ("triage_category",),
        _slot(5, 6, 24),
        one_of(INVALID_TRIAGE_CODES, EVENT),
    )
]

# What the pattern has to refuse: a character too few anywhere, a digit in place
# of the letter, a blank inside, a letter among the digits, one of each in turn.
MALFORMED_CODE_FAULTS = [
    Fault(
        "malformed_gp_code",
        ("gp_practice_code",),
        _slot(10, 11),
        f"CASE ({EVENT} div 97) % 4 "
        f"WHEN 0 THEN overlay({{value}} PLACING '' FROM CAST(1 + {EVENT} % 6 AS INT) FOR 1) "
        f"WHEN 1 THEN overlay({{value}} PLACING CAST({EVENT} % 10 AS STRING) FROM 1 FOR 1) "
        "WHEN 2 THEN overlay({value} PLACING ' ' FROM 4 FOR 1) "
        "ELSE overlay({value} PLACING 'O' FROM 6 FOR 1) END",
    )
]

# Values at the edges of the rules, beyond the usual faults: a day without its
# leading zero fits no format; a triage code that is missing passes the rules.
EDGE_FAULTS = [
    Fault("missing_arrival_time", ("arrival_time",), _slot(27), f"'5/3/{FEED_YEAR} 14:30'"),
    Fault(None, ("triage_category",), _slot(28), "'N/A'"),
]

NEGATIVE_STAY_FAULTS = [
    Fault(
        "departure_before_arrival",
        ("departure",),
        _slot(3, 4),
        _stay(f"-(1 + ({EVENT} div 97) * 13 % 2000)"),
        "departure_time",
    )
]

# From a minute before the arrival to a day and a half; stays from the limit up to
# a month; and two at the limit: just allowed, and just not.
EXTREME_STAY_FAULTS = [
    Fault(
        "extreme_length_of_stay",
        ("departure",),
        _slot(8),
        _stay(f"{a.LONGEST_STAY_MINUTES + 2} + ({EVENT} * 131) % 40000"),
        "departure_time",
    ),
    Fault(None, ("departure",), _slot(25), _stay(f"{a.LONGEST_STAY_MINUTES}")),
    Fault(
        "extreme_length_of_stay",
        ("departure",),
        _slot(26),
        _stay(f"{a.LONGEST_STAY_MINUTES + 1}"),
        "departure_time",
    ),
]

FUTURE_DATE_FAULTS = [
    Fault(
        "future_dated_attendance",
        ("arrival", "departure"),
        _slot(7),
        # Whole years ahead, so the date stays plausible in all but its year.
        f"timestampadd(YEAR, CAST(1 + {EVENT} % 7 AS INT), {{value}})",
        "arrival_time",
    )
]

DECIMAL_SUFFIX_FAULTS = [
    Fault(
        "triage_decimal_format",
        ("triage_category",),
        _noise(100, 50, 5, 6, 24, 28),
        "concat({value}, '.0')",
    )
]

LOWERCASE_FAULTS = [
    Fault(
        "gp_code_lowercase",
        ("gp_practice_code",),
        _noise(100, 60, *range(10, 18)),
        "lower({value})",
    )
]

TEXT_FAULTS = [
    Fault(
        "inconsistent_text_format",
        ("presenting_complaint",),
        _noise(10, 3, *range(18, 22)),
        _untidy(f"{EVENT} % 3"),
    ),
    Fault(
        "inconsistent_text_format",
        ("disposition",),
        _noise(12, 5, 22, 23),
        _untidy(f"({EVENT} div 12) % 3"),
    ),
]

# Only for the answer key: ``write_in_formats`` does the damage.
FORMAT_FAULTS = [
    Fault(
        "mixed_date_format",
        ("arrival_time", "departure_time"),
        Pick(100, tuple(r for pick, _ in MIXED_FORMATS for r in pick.residues)),
        "{value}",
    )
]

COPIED_ROWS = _slot(40, 41)

# Every modulus that a pick above uses.
MODULI = [97, 100, 10, 12]
RESIDUES = [f"_mod_{m}" for m in MODULI]

TIME_FAULTS = [*NEGATIVE_STAY_FAULTS, *EXTREME_STAY_FAULTS, *FUTURE_DATE_FAULTS]
VALUE_FAULTS = [*MISSING_FAULTS, *INVALID_CODE_FAULTS, *MALFORMED_CODE_FAULTS, *EDGE_FAULTS]
NOISE_FAULTS = [*DECIMAL_SUFFIX_FAULTS, *LOWERCASE_FAULTS, *TEXT_FAULTS]

# The faults of which a row is to carry at most one.
STRUCTURAL_FAULTS = [f for f in [*TIME_FAULTS, *VALUE_FAULTS] if f.error_type]


def good_attendances(events: DataFrame) -> DataFrame:
    """One faultless attendance per event, with its times as timestamps."""
    arrival = "CAST(ts AS TIMESTAMP_NTZ)"
    number = f"CAST({EVENT} AS STRING)"
    stay = f"(20 + ({EVENT} * 7919) % 881) * 60 + ({EVENT} * 31) % 60"
    return events.transform(with_residues, EVENT, MODULI).selectExpr(
        EVENT,
        *RESIDUES,
        f"concat('ATT', lpad({number}, greatest(6, length({number})), '0')) AS attendance_id",
        "concat('PSN', CAST(1000000 + user_id AS STRING)) AS pseudo_patient_id",
        f"{arrival} AS arrival",
        f"timestampadd(SECOND, {stay}, {arrival}) AS departure",
        f"CAST(1 + ({EVENT} * 13) % 5 AS STRING) AS triage_category",
        f"{one_of(a.COMPLAINTS, f'{EVENT} * 17')} AS presenting_complaint",
        f"{one_of(a.DISPOSITIONS, f'{EVENT} * 29')} AS disposition",
        "concat('E8', CAST(1000 + (user_id * 37) % 9000 AS STRING)) AS gp_practice_code",
    )


def as_text(attendances: DataFrame, mixed_formats: bool = True) -> DataFrame:
    """Times written as text, so that every raw column is text."""
    return write_in_formats(
        attendances,
        {"arrival_time": "arrival", "departure_time": "departure"},
        MIXED_FORMATS if mixed_formats else [],
        a.TIMESTAMP_FORMATS[0],
    ).select(EVENT, *RESIDUES, *a.RAW_COLUMNS)


def _place(copy: str) -> str:
    """Place of a row in the feed.  The residue before the product keeps it
    within a bigint for any event."""
    return f"(({EVENT} % {ORDER_SPAN}) * 1103515245 + 12345 + {copy} * 7) % {ORDER_SPAN}"


def messy_feed(events: DataFrame) -> DataFrame:
    """The whole damaged feed: raw text columns, its order, planted faults.

    ``source_row`` is unique and together with ``feed_order`` gives the order
    in which the rows arrive.
    """
    logged = [*TIME_FAULTS, *VALUE_FAULTS, *FORMAT_FAULTS, *NOISE_FAULTS]
    return (
        good_attendances(events)
        .transform(inject, TIME_FAULTS)
        .transform(as_text)
        .transform(inject, VALUE_FAULTS)
        .transform(inject, NOISE_FAULTS)
        .transform(log_faults, logged)
        .transform(add_copies, COPIED_ROWS)
        .withColumns(
            {"feed_order": F.expr(_place("copy")), "source_row": F.expr(f"{EVENT} * 2 + copy")}
        )
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The columns of ``events`` that attendances are made of; with the schema
    given, no job has to look it up in the files first."""
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def read_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_feed(read_events(spark, f"{sf_dir}/events.parquet"))


def numbered_feed(feed: DataFrame, buckets: int = 256) -> DataFrame:
    """The feed with ``raw_row_number`` from 1 in feed order."""
    return number_rows(
        feed, "feed_order", ORDER_SPAN, ["source_row"], "raw_row_number", buckets
    )


def with_duplicate_entry(feed: DataFrame) -> DataFrame:
    """Log the later row of each copied pair as a duplicate.

    Both rows of a pair know each other's place in the feed, as it follows
    from the event and the copy number: no grouping is needed.
    """
    return feed.withColumn(
        "planted",
        F.expr(
            f"CASE WHEN {COPIED_ROWS.rows()} AND feed_order > {_place('(1 - copy)')} "
            "THEN concat(planted, array(named_struct("
            "'column', '(entire row)', 'error_type', 'duplicate_row'))) ELSE planted END"
        ),
    )


def planted_faults(feed: DataFrame) -> DataFrame:
    """The answer key of the feed, with the numbers of the raw rows."""
    return answer_key(
        numbered_feed(with_duplicate_entry(feed)), a.ANSWER_KEY_COLUMNS, a.EXPECTED_ACTIONS
    )


def planted_reasons(feed: DataFrame, rule_names: list[str]) -> DataFrame:
    """(attendance_id, reason) pairs that the rules have to find.

    From the answer key without its row numbers, so nothing is sorted.  Copies
    repeat their pairs.
    """
    return (
        feed.select("attendance_id", F.explode("planted").alias("entry"))
        .filter(F.col("entry.error_type").isin(*rule_names))
        .select("attendance_id", F.col("entry.error_type").alias("reason"))
    )
