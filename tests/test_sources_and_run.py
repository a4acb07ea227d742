import glob

import pytest
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.operators.rules import REASONS
from siftworks.operators import dedupe
from siftworks.plans import run as run_module
from siftworks.plans.run import full_run, found_reasons
from siftworks.sources import attendance_feed as feed
from siftworks.sources import tables, text_csv, work_dir
from tests.rows import attendance, raw

SF = "/root/testdata/sf0.001"


def write(path, text):
    path.mkdir(exist_ok=True)
    (path / "part.csv").write_text(text, newline="")
    return str(path)


def test_quotes_short_and_long_lines(spark, tmp_path):
    folder = write(tmp_path / "in", 'a,b\n1,"say ""x"", then y"\nshort\n1,2,3\n" p ",\n')
    df = text_csv.read_text_csv(spark, folder, ["a", "b"], corrupt_column=True)
    assert [tuple(r) for r in df.collect()] == [
        ("1", 'say "x", then y', None),
        ("short", None, "short"),
        ("1", "2", "1,2,3"),
        (" p ", None, None),
    ]


def test_line_breaks_inside_quotes(spark, tmp_path):
    folder = write(tmp_path / "in", 'a,b\n1,"two\nlines"\n')
    df = text_csv.read_text_csv(spark, folder, ["a", "b"], multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", "two\nlines")]


def test_header_must_fit(spark, tmp_path):
    folder = write(tmp_path / "in", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        text_csv.read_text_csv(spark, folder, ["a", "b"]).collect()


def test_positions_give_the_order_of_a_file(spark, tmp_path):
    lines = "".join(f"{i},x\n" for i in range(20_000))
    folder = write(tmp_path / "in", "a,b\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = text_csv.read_text_csv(spark, folder, ["a", "b"], with_position=True)
        assert df.rdd.getNumPartitions() > 4
        got = [int(r["a"]) for r in df.orderBy(*text_csv.SOURCE_ORDER).collect()]
        assert got == list(range(20_000))
        assert df.select(text_csv.SOURCE_ROW).distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_text_survives_a_csv_round_trip(spark, tmp_path):
    rows = [attendance(disposition='  "a", b\\ '), attendance(disposition=None)]
    text_csv.write_text_csv(raw(spark, rows), str(tmp_path / "out"))
    back = text_csv.read_text_csv(spark, str(tmp_path / "out"), a.RAW_COLUMNS)
    assert {r["disposition"] for r in back.collect()} == {'  "a", b\\ ', None}


def test_loading_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert tables.load_table(spark.range(10), path) == 10
    assert tables.load_table(spark.range(3), path) == 3
    assert tables.read_table(spark, path).count() == 3


def test_work_folder_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir.new_folder(spark, "x").startswith(f"{shared}/siftworks/x-")
    assert work_dir.new_folder(spark, "x") != work_dir.new_folder(spark, "x")


class Unset:
    """A session without a shared folder."""

    def __init__(self, master):
        self.conf = {"spark.master": master}


def test_no_machine_local_folder_on_a_cluster():
    assert work_dir.shared_folder(Unset("local[4]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir.shared_folder(Unset("k8s://somewhere"))


def run_at(spark, folder, partitions=None):
    raw_feed = feed.read_feed(spark, SF)
    if partitions:
        raw_feed = raw_feed.repartition(partitions)
    rules = a.reject_rules(year=feed.FEED_YEAR)
    truth = feed.planted_reasons(raw_feed, [r.name for r in rules])
    return full_run(raw_feed, feed.FEED_ORDER, feed.ROW_ID, rules, str(folder), truth)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    return run_at(spark, tmp_path_factory.mktemp("run"))


def test_counts_of_a_run_add_up(spark, run):
    n = run.stage_counts().first().asDict()
    events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert n["rows_deduplicated"] == events
    assert n["rows_read"] == feed.read_feed(spark, SF).count()
    assert n["rows_read"] - n["duplicates_removed"] == events
    assert n["rows_clean"] + n["rows_quarantined"] == events
    assert run.clean().count() == n["rows_clean"]
    assert run.clean().columns == a.CLEAN_COLUMNS
    assert run.quarantined().count() == n["rows_quarantined"]


def test_a_run_finds_exactly_the_planted_faults(spark, run):
    got = spark.read.parquet(f"{run.folder}/reconciliation").first().asDict()
    assert got["only_found"] == got["only_truth"] == 0
    assert got["matched"] == got["truth_keys"] == got["found_keys"] > 0


def test_the_report_adds_up_to_the_reasons(spark, run):
    listed = found_reasons(run.quarantined()).count()
    assert sum(r["count"] for r in run.dq_report().collect()) == listed
    stored = spark.read.csv(run.report_path, header=True)
    assert [r["reason"] for r in stored.collect()] == [
        r["reason"] for r in run.dq_report().collect()
    ]
    assert len(glob.glob(f"{run.report_path}/part-*.csv")) == 1


def test_quarantined_rows_keep_the_original_text(run):
    shown = run.quarantined().filter("original.arrival_time = '5/3/2024 14:30'")
    assert shown.count() > 0
    assert shown.filter("arrival_time IS NOT NULL").count() == 0
    assert run.quarantined().filter("original IS NULL").count() == 0
    assert run.outcomes().filter("outcome = 'clean' AND original IS NOT NULL").count() == 0


def test_one_side_is_read_without_the_other(run):
    plan = run.clean()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan


def test_metrics_of_a_run(spark, run):
    stages = {r["stage"]: r for r in spark.read.parquet(run.metrics_path).collect()}
    assert stages["deduplicate"]["rows_in"] > stages["deduplicate"]["rows_out"]
    assert stages["clean_and_store"]["seconds"] > 0
    assert set(stages) == {
        "read", "deduplicate", "keep_clean", "quarantine",
        "load", "clean_and_store", "count", "report", "reconcile", "total",
    }
    assert stages["load"]["rows_out"] == run.clean().count()
    assert stages["total"]["seconds"] >= stages["clean_and_store"]["seconds"]


def test_views_are_registered(spark, run):
    assert spark.table("v_four_hour_breach").first()["total_attendances"] == run.clean().count()


def test_result_does_not_depend_on_the_partitioning(spark, run, tmp_path):
    other = run_at(spark, tmp_path, partitions=13)
    columns = [*a.CLEAN_COLUMNS, REASONS]
    mine, its = run.outcomes().select(columns), other.outcomes().select(columns)
    assert mine.exceptAll(its).count() == its.exceptAll(mine).count() == 0


def test_rows_without_a_key_in_a_run(spark, tmp_path):
    rows = [attendance(attendance_id=m, n=i) for i, m in enumerate(["-", None, "n/a", "A1", "A1"])]
    source = raw(spark, rows, "n int")
    rules = a.reject_rules()
    kept = full_run(source, ["n"], "n", rules, str(tmp_path / "kept"))
    one = full_run(source, ["n"], "n", rules, str(tmp_path / "one"), null_keys="collapse")
    assert tuple(kept.stage_counts().first()) == (5, 4, 1, 4, 0)
    assert tuple(one.stage_counts().first()) == (5, 2, 3, 2, 0)


MALFORMED = [
    "A2,P2,2025-01-05 10:00:00,2025-01-05 11:00:00,1,Fall,over, with a comma,E12345",
    "A3,P3,2025-01-05 10:00:00",
    "A1,P1,2025-01-05 10:00:00,2025-01-05 11:00:00,1,Fall,Discharged home,E12345,extra",
]


def malformed_feed(spark, tmp_path):
    good = "A1,P1,2025-01-05 10:00:00,2025-01-05 11:00:00,1,Fall,Discharged home,E12345"
    lines = [",".join(a.RAW_COLUMNS), MALFORMED[2], good, *MALFORMED[:2]]
    folder = write(tmp_path / "in", "\n".join(lines) + "\n")
    return text_csv.read_text_csv(spark, folder, a.RAW_COLUMNS, corrupt_column=True, with_position=True)


@pytest.mark.parametrize("null_keys", ["keep", "collapse"])
def test_no_malformed_line_becomes_a_clean_row(spark, tmp_path, null_keys):
    rules = a.reject_rules(malformed_line=text_csv.CORRUPT)
    scanned = malformed_feed(spark, tmp_path)
    run = full_run(scanned, text_csv.SOURCE_ORDER, text_csv.SOURCE_ROW, rules, str(tmp_path / "out"), null_keys=null_keys)
    # The malformed line with the id of a good row does not push it out.
    assert [r[a.KEY] for r in run.clean().collect()] == ["A1"]
    kept = run.quarantined().collect()
    assert sorted(r["original"]["line"] for r in kept) == sorted(MALFORMED)
    assert all(r[REASONS] == ["malformed_line"] and r[a.KEY] is None for r in kept)
    assert [tuple(r)[:2] for r in run.dq_report().collect()] == [("malformed_line", 3)]


def test_malformed_lines_are_found_whatever_is_selected(spark, tmp_path):
    scanned = malformed_feed(spark, tmp_path)
    found = scanned.select("disposition", text_csv.CORRUPT).filter(f"{text_csv.CORRUPT} IS NOT NULL")
    assert sorted(r[1] for r in found.collect()) == sorted(MALFORMED)
    assert scanned.filter(f"{text_csv.CORRUPT} IS NULL").select("disposition").collect()[0][0] == "Discharged home"


@pytest.mark.parametrize("rows", [[], [attendance(triage_category="X")], [attendance()]])
def test_feeds_without_rows_of_one_kind(spark, tmp_path, rows):
    source = raw(spark, [{**r, "n": 1} for r in rows], "n int")
    run = full_run(source, ["n"], "n", a.reject_rules(), str(tmp_path / "out"), include_zero=not rows)
    bad = len([r for r in rows if r["triage_category"] == "X"])
    assert tuple(run.stage_counts().first()) == (len(rows), len(rows), 0, len(rows) - bad, bad)
    assert run.clean().count() == len(rows) - bad and run.quarantined().count() == bad
    assert run.dq_report().count() == bad
    rate = spark.table("v_four_hour_breach").first()["breach_rate_pct"]
    assert (rate is None) == (len(rows) == bad)
    run_metrics = spark.read.parquet(run.metrics_path)
    assert run_metrics.filter("stage = 'load'").first()["rows_out"] == len(rows) - bad


def test_files_count_by_their_numbers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for number in (100000, 99999):
        (folder / f"part-{number}.csv").write_text(f"a,b\n{number},x\n")
    df = text_csv.read_text_csv(spark, str(folder), ["a", "b"], with_position=True)
    assert [r["a"] for r in df.orderBy(*text_csv.SOURCE_ORDER).collect()] == ["99999", "100000"]


def test_the_answer_key_is_written_in_order(spark, tmp_path):
    from siftworks.sources.answer_key import read_answer_key, write_answer_key

    write_answer_key(feed.planted_faults(feed.read_feed(spark, SF)).repartition(5), str(tmp_path / "key"))
    files = sorted(glob.glob(f"{tmp_path}/key/part-*.csv"))
    rows = [r for f in files for r in read_answer_key(spark, f).collect()]
    got = [(int(r["raw_row_number"]), r["error_type"]) for r in rows]
    assert got == sorted(got) and len(got) > 100


def test_a_run_reads_its_feed_once(spark, tmp_path, monkeypatch):
    """The feed goes away as soon as its rows are stored; all counts are there."""
    import shutil

    folder = tmp_path / "in"
    folder.mkdir()
    line = "A{},P1,2025-01-05 10:00:00,2025-01-05 11:00:00,1,Fall,Discharged home,E12345"
    for name, n in (("part-1.csv", 30), ("part-2.csv", 50)):
        lines = [",".join(a.RAW_COLUMNS), *[line.format(k % 40) for k in range(n)], "too,few"]
        (folder / name).write_text("\n".join(lines) + "\n")
    (folder / "part-3.csv").write_text(",".join(a.RAW_COLUMNS) + "\n")
    scanned = text_csv.read_text_csv(spark, str(folder), a.RAW_COLUMNS, corrupt_column=True, with_position=True)
    rules = a.reject_rules(malformed_line=text_csv.CORRUPT)
    order, row = text_csv.SOURCE_ORDER, text_csv.SOURCE_ROW
    plan = run_module.tagged_with_tally(scanned, order, row, rules)
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    stored = tables.write_outcomes

    def store_and_lose_the_feed(*given):
        stored(*given)
        shutil.rmtree(folder)

    monkeypatch.setattr(run_module.tables, "write_outcomes", store_and_lose_the_feed)
    run = full_run(scanned, order, row, rules, str(tmp_path / "out"))
    assert tuple(run.stage_counts().first()) == (82, 42, 40, 40, 2)
    read = {r["read_from"].rsplit("/", 1)[1]: r["rows_read"] for r in run.files_read().collect()}
    assert read == {"part-1.csv": 31, "part-2.csv": 51}
    written = run.files_written().groupBy("outcome").sum("rows").collect()
    assert {r[0]: r[1] for r in written} == {"clean": 40, "quarantined": 2}
    footers = run.files_written()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in footers


def test_a_hot_key_and_its_tally_are_combined_before_the_shuffle(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    out = dedupe.first_and_tally(rows.repartition(4, "id"), ["k"], ["id"], "id", part_of=F.pmod("id", F.lit(2)))
    kept = out.filter("rows_read IS NULL")
    assert kept.count() == 2001 and kept.filter("k = 'hot'").first()["id"] == 0
    assert sorted(tuple(r) for r in out.filter("rows_read IS NOT NULL").select("read_from", "rows_read").collect()) == [("0", 1500), ("1", 1500)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > 0 and "partial_count" in plan
