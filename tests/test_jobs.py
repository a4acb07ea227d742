import pytest

from siftworks import __main__ as jobs
from siftworks.sources import attendance_feed, text_csv
from siftworks import attendance as a

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    paths = {name: str(base / name) for name in ("raw", "key", "out")}
    jobs.feed(spark, f"{SF}/events.parquet", paths["raw"], paths["key"])
    return paths


def test_from_events_to_a_reconciled_run(spark, folders):
    run = jobs.clean(spark, folders["raw"], folders["out"], folders["key"], year=2024)
    got = spark.read.parquet(f"{run.folder}/reconciliation").first().asDict()
    assert got["only_found"] == got["only_truth"] == 0 < got["matched"]
    counts = run.stage_counts().first()
    assert counts["rows_read"] == text_csv.read_text_csv(spark, folders["raw"], a.RAW_COLUMNS).count()
    assert counts["duplicates_removed"] > 0


def test_the_answer_key_numbers_the_lines_of_the_feed(spark, folders):
    """Row 1 of the key is the first line after the header, and so on."""
    rows = text_csv.read_text_csv(spark, folders["raw"], a.RAW_COLUMNS, with_position=True)
    lines = rows.orderBy(*text_csv.SOURCE_ORDER).select(a.KEY).collect()
    key = attendance_feed.planted_faults(attendance_feed.read_feed(spark, SF)).collect()
    assert all(lines[r["raw_row_number"] - 1][0] == r[a.KEY] for r in key)
    seen = set()
    repeats = set()
    for number, (name,) in enumerate(lines, 1):
        if name in seen:
            repeats.add(number)
        seen.add(name)
    assert repeats == {r["raw_row_number"] for r in key if r["error_type"] == "duplicate_row"}


def test_commands(spark, folders, capsys):
    jobs.main(["peek", "--raw", folders["raw"]])
    jobs.main(["shapes", "--raw", folders["raw"], "--columns", "arrival_time"])
    jobs.main(["clean", "--raw", folders["raw"], "--out", folders["out"], "--year", "2024"])
    jobs.main(["kpis", "--out", folders["out"]])
    shown = capsys.readouterr().out
    for expected in ("9999-99-99 99:99:99", "presenting_complaint", "quarantine", "breach_rate"):
        assert expected in shown
