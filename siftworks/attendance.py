"""The one domain configuration: an emergency-department attendance feed.

Nothing outside this module and the feed in ``sources.attendance_feed`` knows
about attendances; the operators take columns, lists, formats and rules.
"""

from __future__ import annotations

from siftworks.operators.rules import (
    Rule,
    is_missing,
    is_present,
    lasts_longer_than,
    not_in,
    outside_period,
    precedes,
    unless,
)

# --- Fixed values: they must equal the published ones for equal results ------

# Spellings of "no value", compared after trimming and lower-casing.
MISSING_MARKERS = ["", "null", "n/a", "na", "-", "none", "nil"]

# Timestamp formats in the order in which they are tried.
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd-MMM-yyyy HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
]

COMPLAINTS = [
    "Abdominal pain",
    "Chest pain",
    "Shortness of breath",
    "Minor injury - limb",
    "Head injury",
    "Fall",
    "Laceration / wound",
    "Back pain",
    "Fever",
    "Headache",
    "Allergic reaction",
    "Urinary symptoms",
    "Vomiting / diarrhoea",
    "Eye problem",
    "Rash",
    "Palpitations",
]

DISPOSITIONS = [
    "Discharged home",
    "Admitted to ward",
    "Transferred to another provider",
    "Discharged with follow-up",
    "Referred to GP",
    "Left before treatment complete",
]

TRIAGE_CODES = ["1", "2", "3", "4", "5"]

# One capital letter and five digits.  ``\z`` and not ``$``: the latter lets a
# trailing line break through.
GP_CODE_PATTERN = r"^[A-Z]\d{5}\z"

UNKNOWN = "Unknown"
MALFORMED_LINE = "malformed_line"
LONGEST_STAY_MINUTES = 48 * 60
BREACH_MINUTES = 240

# What is to be done about each kind of planted fault.
EXPECTED_ACTIONS = {
    "duplicate_row": "remove (keep first)",
    "missing_arrival_time": "reject",
    "missing_departure_time": "reject",
    "departure_before_arrival": "reject",
    "invalid_triage_code": "reject",
    "future_dated_attendance": "reject",
    "extreme_length_of_stay": "reject",
    "missing_patient_id": "reject",
    "malformed_gp_code": "set to NULL and flag",
    "missing_gp_code": "set to NULL and flag",
    "missing_presenting_complaint": "fill with 'Unknown'",
    "missing_disposition": "fill with 'Unknown'",
    "triage_decimal_format": "fix (3.0 -> 3)",
    "gp_code_lowercase": "fix (upper-case)",
    "inconsistent_text_format": "fix (trim spaces, standardise case)",
    "mixed_date_format": "fix (parse into one timestamp format)",
}

# Names of the columns, of the answer key's too.
KEY = "attendance_id"

RAW_COLUMNS = [
    "attendance_id",
    "pseudo_patient_id",
    "arrival_time",
    "departure_time",
    "triage_category",
    "presenting_complaint",
    "disposition",
    "gp_practice_code",
]

CLEAN_COLUMNS = [*RAW_COLUMNS, "gp_code_flag"]

ANSWER_KEY_COLUMNS = [
    "raw_row_number",
    "attendance_id",
    "column",
    "error_type",
    "expected_action",
]


def reject_rules(
    year: int = 2025,
    longest_stay_minutes: int = LONGEST_STAY_MINUTES,
    null_triage_fails: bool = False,
    malformed_line: str | None = None,
) -> list[Rule]:
    """The seven reject rules, in the order in which reasons are listed.

    A missing triage code passes unless ``null_triage_fails`` is set.  With
    ``malformed_line``, the column that holds a line whose fields could not be told
    apart, such a row has that one reason, as none of its values can be trusted.
    """
    rules = [
        Rule("missing_arrival_time", is_missing("arrival_time")),
        Rule("missing_departure_time", is_missing("departure_time")),
        Rule("departure_before_arrival", precedes("departure_time", "arrival_time")),
        Rule(
            "invalid_triage_code",
            not_in("triage_category", TRIAGE_CODES, null_fails=null_triage_fails),
        ),
        Rule(
            "future_dated_attendance",
            outside_period(
                "arrival_time", f"{year}-01-01 00:00:00", f"{year + 1}-01-01 00:00:00"
            ),
        ),
        Rule(
            "extreme_length_of_stay",
            lasts_longer_than("arrival_time", "departure_time", longest_stay_minutes),
        ),
        Rule("missing_patient_id", is_missing("pseudo_patient_id")),
    ]
    if malformed_line is None:
        return rules
    malformed = is_present(malformed_line)
    return [Rule(MALFORMED_LINE, malformed), *[unless(malformed, r) for r in rules]]
