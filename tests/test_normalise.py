import datetime as dt

import pytest
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.functions import moments, shares, text
from siftworks.plans.cleaning import normalised
from tests.rows import attendance, raw


def values(spark, expression, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_missing_markers_in_any_case_and_padding(spark):
    spellings = ["", "  ", "NULL", "null", " N/A ", "na", "-", "None", "NIL", None]
    assert values(spark, lambda c: text.blank_to_null(c, a.MISSING_MARKERS), *spellings) == [
        None
    ] * len(spellings)


def test_other_text_is_only_trimmed(spark):
    kept = ["nan", "--", "0", "  a b  ", "\tna\t"]
    assert values(spark, lambda c: text.blank_to_null(c, a.MISSING_MARKERS), *kept) == [
        "nan", "--", "0", "a b", "\tna\t"
    ]


def test_canonical_case(spark):
    given = ["HEADACHE", "headache", "Headache", "Toothache", None]
    assert values(spark, lambda c: text.canonical_case(c, a.COMPLAINTS), *given) == [
        "Headache", "Headache", "Headache", "Toothache", None
    ]


def test_one_decimal_suffix_is_stripped(spark):
    given = ["3.0", "3.00", "3.0.0", "3", ".0", None]
    assert values(spark, text.strip_decimal_suffix, *given) == ["3", "3.00", "3.0", "3", "", None]


def test_codes(spark):
    given = ["e12345", "E12345", "E1234", "E123456", "123456", "GPPRAC", "E12345\n", None]
    assert values(spark, lambda c: text.normalised_code(c, a.GP_CODE_PATTERN), *given) == [
        "E12345", "E12345", None, None, None, None, None, None
    ]
    assert values(spark, lambda c: text.code_flag(c, a.GP_CODE_PATTERN), *given) == [
        None, None, "malformed", "malformed", "malformed", "malformed", "malformed", "missing"
    ]


def test_shape(spark):
    given = ["05-Mar-2025 14:30", "", "Ünïcode 7", None]
    assert values(spark, text.shape, *given) == ["99-XXX-9999 99:99", "", "ÜXïXXXX 9", None]


@pytest.mark.parametrize("zone", ["UTC", "Europe/London", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        given = [
            "2025-03-30 01:30:00",  # skipped by London clocks
            "30/03/2025 01:30",
            "09-Mar-2025 02:30",  # skipped by New York clocks
            "2025-03-30T01:30:00",
            "1969-12-31 23:59:59",
        ]
        parsed = values(
            spark, lambda c: moments.parse_timestamp(c, a.TIMESTAMP_FORMATS), *given
        )
        assert parsed == [
            dt.datetime(2025, 3, 30, 1, 30),
            dt.datetime(2025, 3, 30, 1, 30),
            dt.datetime(2025, 3, 9, 2, 30),
            dt.datetime(2025, 3, 30, 1, 30),
            dt.datetime(1969, 12, 31, 23, 59, 59),
        ]
        df = spark.sql(
            "SELECT timestamp_ntz'2025-03-30 00:00:00' a, timestamp_ntz'2025-03-30 03:00:00' d"
        )
        row = df.select(
            moments.minutes_between(F.col("a"), F.col("d")),
            moments.minute_boundaries(F.col("a"), F.col("d")),
            F.hour(F.col("a") + F.expr("interval 90 minutes")),
        ).first()
        assert tuple(row) == (180.0, 180, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_texts_that_fit_no_format(spark):
    given = [
        "5/3/2025 14:30", "31/02/2025 10:00", "2025-02-30 10:00:00", "2025-03-05 10:00",
        "2025-03-05 10:00:00.5", "2025-03-05 10:00:00Z", "2025-03-05 24:00:00", "03/25/2025 10:00",
        "2025-03-05 10:00:60", "05-Foo-2025 10:00", "now", "", None,
    ]
    parsed = values(spark, lambda c: moments.parse_timestamp(c, a.TIMESTAMP_FORMATS), *given)
    assert parsed == [None] * len(given)


def test_case_of_months_and_literals_is_ignored(spark):
    given = ["05-MAR-2025 14:30", "05-mar-2025 14:30", "2025-03-05t14:30:00"]
    parsed = values(spark, lambda c: moments.parse_timestamp(c, a.TIMESTAMP_FORMATS), *given)
    assert parsed == [dt.datetime(2025, 3, 5, 14, 30)] * 3


def test_shortcuts_change_no_parsed_value(spark):
    """Against plain attempts of every format, on real and on damaged texts."""
    base = spark.range(3000).select(
        F.expr("timestamp_ntz'2019-12-31 22:01:07' + make_dt_interval(0, 0, id * 977, id)").alias(
            "t"
        ),
        "id",
    )
    written = F.coalesce(
        *[
            F.when(F.col("id") % 4 == i, F.date_format("t", f))
            for i, f in enumerate(a.TIMESTAMP_FORMATS)
        ]
    )
    damaged = F.when(
        F.col("id") % 3 == 0,
        F.overlay(written, F.substring(F.lit("0123456789-/: TxZ"), (F.col("id") % 17 + 1), F.lit(1)),
                  (F.col("id") % 19 + 1).cast("int")),
    ).otherwise(written)
    plain = F.coalesce(*[F.try_to_timestamp("x", F.lit(f)) for f in a.TIMESTAMP_FORMATS])
    df = base.select(damaged.alias("x")).select(
        "x",
        moments.parse_timestamp(F.col("x"), a.TIMESTAMP_FORMATS).alias("ours"),
        plain.cast("timestamp_ntz").alias("plain"),
    )
    assert df.filter("ours IS NOT NULL").count() > 2000
    assert df.filter("ours IS NULL").count() > 100
    assert df.filter(~F.col("ours").eqNullSafe(F.col("plain"))).collect() == []


def test_separators():
    assert moments.separators("dd/MM HH") == r"^[^\/]*[\/][^\ ]*[\ ]"
    assert moments.separators("dd'T'HH") == "^[^tT]*[tT]"
    assert moments.separators("yyyy[-MM]") is None
    assert moments.separators("yyyy''MM") is None


def test_minute_boundaries_are_not_elapsed_minutes(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2025-01-01 10:00:59' a, timestamp_ntz'2025-01-01 10:01:00' d"
    )
    row = df.select(
        moments.minute_boundaries(F.col("a"), F.col("d")),
        moments.minute_boundaries(F.col("d"), F.col("a")),
        moments.minute_boundaries(F.col("a"), F.col("a")),
    ).first()
    assert tuple(row) == (1, -1, 0)


def test_percent_rounds_half_up_and_survives_zero(spark):
    df = spark.sql("SELECT * FROM VALUES (29, 20000), (1, 0), (1, 3) AS t(n, total)")
    got = [r[0] for r in df.select(shares.percent(F.col("n"), F.col("total"), 2)).collect()]
    assert got == [0.15, None, 33.33]


def test_normalising_twice_changes_nothing(spark):
    rows = [
        attendance(attendance_id=" A1 ", triage_category="3.0", gp_practice_code="e12345"),
        attendance(attendance_id="A2", presenting_complaint="  HEADACHE ", disposition="n/a"),
        attendance(attendance_id="A3", arrival_time="01/06/2025 10:00", gp_practice_code="bad"),
    ]
    once = normalised(raw(spark, rows))
    texts = ["arrival_time", "departure_time"]
    again = once.drop("gp_code_flag").withColumns(
        {c: F.date_format(c, a.TIMESTAMP_FORMATS[0]) for c in texts}
    )
    columns = a.RAW_COLUMNS
    assert normalised(again).select(columns).collect() == once.select(columns).collect()
    first = once.orderBy(a.KEY).collect()
    assert [r["gp_code_flag"] for r in first] == [None, None, "malformed"]
    assert first[0]["triage_category"] == "3" and first[0]["gp_practice_code"] == "E12345"
    assert first[1]["presenting_complaint"] == "Headache" and first[1]["disposition"] == "Unknown"
