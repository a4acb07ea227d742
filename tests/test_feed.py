from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.operators.faults import Fault, Pick, add_copies, append_copies, inject, with_residues
from siftworks.sources import attendance_feed as feed

SF = "/root/testdata/sf0.001"


def test_first_fault_of_a_column_wins_and_others_stay(spark):
    df = spark.range(10).select("id", F.lit("v").alias("x"))
    faults = [
        Fault("one", ("x",), Pick(5, (0,)), "upper({value})"),
        Fault("two", ("x",), Pick(2, (0,)), "concat({value}, '!')"),
    ]
    got = with_residues(df, "id", [5, 2]).transform(inject, faults).orderBy("id").collect()
    assert [r["x"] for r in got] == ["V", "v", "v!", "v", "v!", "V", "v!", "v", "v!", "v"]


def test_copies_in_place_and_by_union_agree(spark):
    df = with_residues(spark.range(20), "id", [7])
    ours = add_copies(df, Pick(7, (1,)))
    union = append_copies(df, Pick(7, (1,)))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, union.collect()))
    assert ours.count() == 23


def test_every_row_has_at_most_one_structural_fault_but_for_one_slot():
    residues = [r for f in feed.STRUCTURAL_FAULTS for r in f.pick.residues]
    twice = {r for r in residues if residues.count(r) > 1}
    assert twice == {24}


def test_shares_of_the_written_formats():
    assert [len(pick.residues) for pick, _ in feed.MIXED_FORMATS] == [6, 5, 4]


def test_every_planted_error_has_an_action(spark):
    key = feed.planted_faults(feed.read_feed(spark, SF))
    assert key.columns == a.ANSWER_KEY_COLUMNS
    found = key.select("error_type", "expected_action").distinct().collect()
    assert {r[0]: r[1] for r in found} == a.EXPECTED_ACTIONS


def test_ids_are_not_cut_off_when_there_are_many_events(spark):
    events = spark.createDataFrame([(7,), (1_234_567,), (12_345_670_000,)], "event_id bigint").selectExpr(
        "event_id", "timestamp_ntz'2024-01-05 10:00:00' ts", "3L user_id"
    )
    messy = feed.messy_feed(events)
    assert sorted(r[0] for r in messy.select(a.KEY).collect()) == [
        "ATT000007",
        "ATT1234567",
        "ATT12345670000",
    ]
    assert messy.filter("feed_order < 0").count() == 0


def test_keys_that_are_text_are_hashed(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit("V").alias("x"))
    picked = with_residues(df, "key", [10]).transform(inject, [Fault("f", ("x",), Pick(10, (3,)), "lower({value})")])
    assert 60 < picked.filter("x = 'v'").count() < 140
