"""Hand-made attendance rows."""

from siftworks import attendance as a

GOOD = {
    "attendance_id": "ATT000001",
    "pseudo_patient_id": "PSN0000001",
    "arrival_time": "2025-06-01 10:00:00",
    "departure_time": "2025-06-01 12:00:00",
    "triage_category": "3",
    "presenting_complaint": "Headache",
    "disposition": "Discharged home",
    "gp_practice_code": "E12345",
}


def attendance(**changed):
    """A row that passes all rules, with some values changed."""
    return {**GOOD, **changed}


def raw(spark, rows, *extra):
    """Rows as a table of text, with further columns as ``name type``."""
    names = [*a.RAW_COLUMNS, *[e.split()[0] for e in extra]]
    schema = ", ".join([*[f"{c} string" for c in a.RAW_COLUMNS], *extra])
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
