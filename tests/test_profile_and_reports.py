import statistics

import pytest
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.operators import kpi, lookup, profile, reconcile, report
from siftworks.operators.rules import split, tag_failures
from siftworks.plans.cleaning import normalised
from tests.rows import attendance, raw


def test_null_counts_of_empty_input_are_zero(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert tuple(profile.null_counts(df).first()) == (0, 0)
    df = spark.createDataFrame([(None, 1), ("x", None), (None, 2)], "a string, b int")
    assert profile.null_counts(df).first().asDict() == {"a": 2, "b": 1}


def test_shapes(spark):
    df = spark.createDataFrame(
        [("2025-01-02", "a"), ("2024-01-02", "b1"), ("02/01/2025", None)], "d string, c string"
    )
    got = {tuple(r) for r in profile.shape_counts(df, ["d", "c"]).collect()}
    assert got == {
        ("d", "9999-99-99", 2, "2024-01-02"),
        ("d", "99/99/9999", 1, "02/01/2025"),
        ("c", "X", 1, "a"),
        ("c", "X9", 1, "b1"),
        ("c", None, 1, None),
    }
    assert [r["shape"] for r in profile.top_shapes(df, "d", 1).collect()] == ["9999-99-99"]


def test_distinct_counts_include_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2), (None, 3)], "a string, b int")
    assert tuple(profile.distinct_counts(df, ["a", "b"]).first()) == (2, 3)
    assert tuple(profile.approx_distinct_counts(df, ["a", "b"]).first()) == (2, 3)
    empty = spark.createDataFrame([], "a string, b int")
    assert tuple(profile.distinct_counts(empty, ["a", "b"]).first()) == (0, 0)


def test_approximate_distinct_counts_are_close(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("v"))
    [n] = profile.approx_distinct_counts(df, ["v"]).first()
    assert abs(n - 5000) < 5000 * 0.08


def test_column_overview(spark):
    df = spark.createDataFrame([("a", 1), (None, 1)], "a string, b int")
    assert [tuple(r) for r in profile.column_overview(df).orderBy("position").collect()] == [
        (1, "a", "string", 2, 1, 2),
        (2, "b", "int", 2, 0, 1),
    ]


def tagged(spark):
    rows = [
        attendance(attendance_id="A1"),
        attendance(attendance_id="A2", triage_category="X"),
        attendance(attendance_id="A3", triage_category="X", arrival_time=None),
    ]
    return tag_failures(normalised(raw(spark, rows)), a.reject_rules())


def test_report(spark):
    df = tagged(spark)
    rules = a.reject_rules()
    want = [("invalid_triage_code", 2, 66.67), ("missing_arrival_time", 1, 33.33)]
    assert [tuple(r) for r in report.failure_report(df, rules).collect()] == want
    _, quarantined = split(df)
    again = report.failure_report_from_reasons(quarantined, 3)
    assert [tuple(r) for r in again.collect()] == want
    assert [tuple(r) for r in report.reasons_listed(quarantined).collect()] == [
        r[:2] for r in want
    ]
    whole = report.failure_report(df, rules, include_zero=True).collect()
    assert len(whole) == len(rules)
    assert [r["count"] for r in whole] == [2, 1, 0, 0, 0, 0, 0]


def test_report_of_nothing(spark):
    df = tagged(spark).limit(0)
    assert report.failure_report(df, a.reject_rules()).collect() == []
    whole = report.failure_report(df, a.reject_rules(), include_zero=True).collect()
    assert {r["pct_of_input"] for r in whole} == {None}


def ids(df):
    return sorted(r[0] or "" for r in df.collect())


def test_reconciliation(spark):
    found = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    truth = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "id string")
    assert ids(reconcile.matched(found, truth, ["id"])) == ["", "b"]
    assert ids(reconcile.false_positives(found, truth, ["id"])) == ["a"]
    assert ids(reconcile.false_negatives(found, truth, ["id"])) == ["c"]
    assert reconcile.summary(found, truth, ["id"]).first().asDict() == {
        "truth_keys": 3,
        "found_keys": 3,
        "matched": 2,
        "only_found": 1,
        "only_truth": 1,
    }
    # The set operations agree.
    assert ids(found.intersect(truth)) == ["", "b"]
    assert ids(found.distinct().subtract(truth)) == ["a"]


def test_reconciliation_by_label(spark):
    found = spark.createDataFrame([("a", "r1"), ("b", "r1"), ("b", "r2")], "id string, rule string")
    truth = spark.createDataFrame([("a", "r1"), ("b", "r3")], "id string, rule string")
    got = {
        r["rule"]: (r["truth_rows"], r["found_rows"], r["matched"], r["precision"], r["recall"])
        for r in reconcile.by_label(found, truth, "id", "rule").collect()
    }
    assert got == {
        "r1": (1, 2, 1, 0.5, 1.0),
        "r2": (0, 1, 0, 0.0, None),
        "r3": (1, 0, 0, None, 0.0),
    }


@pytest.fixture(params=["10m", "-1"])
def broadcast_limit(request, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_keys_are_joined_as_they_are(spark):
    """No job while the query is built, no copies of the dimension, no forced hint."""
    keys = spark.range(200_000).withColumn("key", F.col("id").cast("string"))
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup(None)
    for df in (
        lookup.members(keys, F.col("key"), keys, "key"),
        lookup.lookup(keys, F.col("key"), keys, "key", "id", "found"),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "ResolvedHint" not in plan and "strategy=" not in plan
    assert tracker.getJobIdsForGroup(None) == before


def test_lookup_is_the_same_by_broadcast_and_by_shuffle(spark, broadcast_limit):
    rows = spark.range(900).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
    )
    dim = spark.createDataFrame([("hot", "H"), ("1", "one"), ("49", "x")], "key string, v string")
    found = lookup.lookup(rows, F.col("k"), dim, "key", "v", "name")
    names = {"hot": "H", "1": "one", "49": "x"}
    assert found.columns == ["id", "k", "name"]
    got = {r["id"]: r["name"] for r in found.collect()}
    assert got == {i: names.get("hot" if i % 3 == 0 else str(i % 50)) for i in range(900)}


def test_members_and_outsiders(spark, broadcast_limit):
    rows = spark.createDataFrame(
        [(i, k) for i, k in enumerate(["hot"] * 50 + ["a", "b", None])], "id int, k string"
    )
    keys = spark.createDataFrame([("hot",), ("hot",), ("b",), (None,)], "key string")

    def ids_of(**options):
        found = lookup.members(rows, F.col("k"), keys, "key", **options)
        assert found.columns == ["id", "k"]
        return sorted(r["id"] for r in found.collect())

    assert ids_of() == [*range(50), 51]
    assert ids_of(outside=True) == [50]


def stays(spark):
    rows = [
        ("1", "2025-01-01 10:00:00", f"2025-01-01 {10 + h:02d}:{m:02d}:00")
        for h, m in [(0, 10), (4, 0), (4, 1), (9, 59)]
    ] + [("2", "2025-01-01 23:59:59", "2025-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "triage_category string, a string, d string")
    return df.select(
        "triage_category",
        F.col("a").cast("timestamp_ntz").alias("arrival_time"),
        F.col("d").cast("timestamp_ntz").alias("departure_time"),
    )


def test_kpis(spark):
    df = stays(spark)
    assert tuple(kpi.breach_rate(df, 240).first()) == (5, 2, 40.0)
    minutes = [10, 240, 241, 599]
    assert [tuple(r) for r in kpi.stay_by(df, "triage_category").collect()] == [
        ("1", 4, 273.0, 241.0),  # 272.5 and 240.5, rounded half up
        ("2", 1, 1.0, 1.0),
    ]
    assert statistics.median(minutes) == 240.5
    assert kpi.overall_median(df).first()[0] == 240.0
    assert [tuple(r) for r in kpi.arrivals_by_hour(df).collect()] == [(10, 4), (23, 1)]
    approx = kpi.approx_stay_by(df, "triage_category").collect()
    assert [r["median_los_minutes"] for r in approx] == [240, 1]


def test_kpi_views_and_empty_input(spark):
    kpi.register_views(stays(spark), 240)
    assert spark.sql("SELECT breaches FROM v_four_hour_breach").first()[0] == 2
    assert spark.table("v_los_by_triage").orderBy("triage_category").count() == 2
    kpi.register_views(stays(spark).limit(0), 240)
    assert tuple(spark.table("v_four_hour_breach").first()) == (0, 0, None)
    assert spark.table("v_arrivals_by_hour").count() == 0
