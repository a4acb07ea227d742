from siftworks import attendance as a
from siftworks.operators.rules import REASONS
from siftworks.sources import tables, text_csv
from siftworks.streaming.arrivals import clean_arrivals
from tests.rows import attendance, raw


def _land(spark, folder, name, rows):
    text_csv.write_text_csv(raw(spark, rows), f"{folder}/in/{name}")


def _clean(spark, folder):
    clean_arrivals(
        spark,
        f"{folder}/in/*",
        f"{folder}/out",
        f"{folder}/checkpoint",
        a.reject_rules(malformed_line=text_csv.CORRUPT),
    ).awaitTermination()
    found = tables.read_outcomes(spark, f"{folder}/out").collect()
    return sorted((r[a.KEY] or "", r["outcome"], tuple(r[REASONS])) for r in found)


def test_files_are_cleaned_once_and_copies_across_files_are_dropped(spark, tmp_path):
    folder = str(tmp_path)
    _land(
        spark,
        folder,
        "first",
        [attendance(attendance_id="A1"), attendance(attendance_id="A2", triage_category="X")],
    )
    first = [("A1", "clean", ()), ("A2", "quarantined", ("invalid_triage_code",))]
    assert _clean(spark, folder) == first

    _land(
        spark,
        folder,
        "second",
        [attendance(attendance_id="A1"), attendance(attendance_id="A3", triage_category="4.0")],
    )
    assert _clean(spark, folder) == [*first, ("A3", "clean", ())]
    assert _clean(spark, folder) == [*first, ("A3", "clean", ())]


def test_rows_without_a_key_are_all_kept(spark, tmp_path):
    folder = str(tmp_path)
    _land(spark, folder, "only", [attendance(attendance_id=m) for m in ("N/A", "-", "null")])
    assert _clean(spark, folder) == [("", "clean", ())] * 3


def test_malformed_lines_are_quarantined_whole(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "in" / "one").mkdir(parents=True)
    lines = [",".join(a.RAW_COLUMNS), "A1,too,short", "A2" + "," * 8 + "too long"]
    (tmp_path / "in" / "one" / "part.csv").write_text("\n".join(lines) + "\n")
    assert _clean(spark, folder) == [("", "quarantined", ("malformed_line",))] * 2
    found = tables.read_outcomes(spark, f"{folder}/out").collect()
    assert sorted(r[text_csv.CORRUPT] for r in found) == lines[1:]


def test_the_source_is_read_once(spark, tmp_path):
    folder = str(tmp_path)
    rows = [attendance(attendance_id=k) for k in ("A1", "A1", "-", "A2")]
    _land(spark, folder, "only", rows)
    query = clean_arrivals(
        spark, f"{folder}/in/*", f"{folder}/out", f"{folder}/checkpoint", a.reject_rules(malformed_line=text_csv.CORRUPT)
    )
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows)
