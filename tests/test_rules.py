import pytest

from siftworks import attendance as a
from siftworks.operators.rules import REASONS, passing, split, tag_failures
from siftworks.plans.cleaning import normalised
from tests.rows import attendance, raw


def judge(spark, *rows, **options):
    tagged = tag_failures(normalised(raw(spark, rows)), a.reject_rules(**options))
    return [(r[a.KEY], r[REASONS]) for r in tagged.orderBy(a.KEY).collect()]


def reasons(spark, **changed):
    [(_, found)] = judge(spark, attendance(**changed))
    return found


def test_good_row_passes(spark):
    assert reasons(spark) == []


def test_departure_before_arrival(spark):
    changed = dict(arrival_time="2025-06-01 12:00:00", departure_time="2025-06-01 10:00:00")
    assert reasons(spark, **changed) == ["departure_before_arrival"]


def test_equal_times_pass(spark):
    assert reasons(spark, departure_time="2025-06-01 10:00:00") == []


@pytest.mark.parametrize("code", ["X", "0", "6", "99", "-1", "3.00", "33"])
def test_code_outside_the_domain(spark, code):
    assert reasons(spark, triage_category=code) == ["invalid_triage_code"]


@pytest.mark.parametrize("code", ["1", "5", " 3 ", "3.0"])
def test_code_inside_the_domain(spark, code):
    assert reasons(spark, triage_category=code) == []


def test_missing_code_passes_unless_it_is_to_fail(spark):
    row = attendance(triage_category="n/a")
    assert judge(spark, row) == [("ATT000001", [])]
    assert judge(spark, row, null_triage_fails=True) == [("ATT000001", ["invalid_triage_code"])]


def test_stay_limit_is_strict(spark):
    start = "2025-06-01 00:00:00"
    just = attendance(
        attendance_id="A1", arrival_time=start, departure_time="2025-06-03 00:00:00"
    )
    over = attendance(
        attendance_id="A2", arrival_time=start, departure_time="2025-06-03 00:01:00"
    )
    second = attendance(
        attendance_id="A3", arrival_time=start, departure_time="2025-06-03 00:00:01"
    )
    assert judge(spark, just, over, second) == [
        ("A1", []),
        ("A2", ["extreme_length_of_stay"]),
        ("A3", ["extreme_length_of_stay"]),
    ]
    assert judge(spark, over, longest_stay_minutes=2881) == [("A2", [])]


@pytest.mark.parametrize(
    ("arrival", "departure", "fails"),
    [
        ("2025-01-01 00:00:00", "2025-01-01 01:00:00", False),
        ("2024-12-31 23:59:59", "2025-01-01 01:00:00", True),
        ("2025-12-31 23:59:59", "2026-01-01 01:00:00", False),
        ("2026-01-01 00:00:00", "2026-01-01 01:00:00", True),
    ],
)
def test_year_of_arrival(spark, arrival, departure, fails):
    found = reasons(spark, arrival_time=arrival, departure_time=departure)
    assert found == (["future_dated_attendance"] if fails else [])


def test_year_is_a_parameter(spark):
    row = attendance(arrival_time="2024-06-01 10:00:00", departure_time="2024-06-01 11:00:00")
    assert judge(spark, row, year=2024) == [("ATT000001", [])]


@pytest.mark.parametrize(
    ("column", "reason"),
    [
        ("arrival_time", "missing_arrival_time"),
        ("departure_time", "missing_departure_time"),
        ("pseudo_patient_id", "missing_patient_id"),
    ],
)
def test_missing_values(spark, column, reason):
    assert reasons(spark, **{column: None}) == [reason]
    assert reasons(spark, **{column: " None "}) == [reason]


def test_unreadable_time_counts_as_missing(spark):
    assert reasons(spark, arrival_time="5/3/2025 14:30") == ["missing_arrival_time"]


def test_all_reasons_in_rule_order(spark):
    assert reasons(
        spark,
        arrival_time="-",
        departure_time="",
        triage_category="X",
        pseudo_patient_id="nil",
    ) == [
        "missing_arrival_time",
        "missing_departure_time",
        "invalid_triage_code",
        "missing_patient_id",
    ]


def test_several_reasons_on_present_times(spark):
    assert reasons(
        spark, arrival_time="2031-06-01 10:00:00", departure_time="2031-07-01 10:00:00"
    ) == ["future_dated_attendance", "extreme_length_of_stay"]


def test_split_and_passing_agree(spark):
    rows = [
        attendance(attendance_id="A1"),
        attendance(attendance_id="A2", triage_category="X"),
        attendance(attendance_id="A3", arrival_time=None),
    ]
    df = normalised(raw(spark, rows))
    clean, quarantined = split(tag_failures(df, a.reject_rules()))
    assert [r[a.KEY] for r in clean.collect()] == ["A1"]
    assert sorted(r[a.KEY] for r in quarantined.collect()) == ["A2", "A3"]
    assert clean.columns == df.columns
    assert passing(df, a.reject_rules()).collect() == clean.collect()


def test_rules_on_zoned_timestamps(spark):
    """The rules also take columns that were cast to plain timestamps."""
    df = raw(spark, [attendance(), attendance(attendance_id="A2", triage_category="X")])
    for c in ("arrival_time", "departure_time"):
        df = df.withColumn(c, df[c].cast("timestamp"))
    found = tag_failures(df, a.reject_rules()).orderBy(a.KEY).collect()
    assert [r[REASONS] for r in found] == [["invalid_triage_code"], []]
