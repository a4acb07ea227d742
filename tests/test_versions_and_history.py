"""Versioned tables, and deduplication against stored history."""

import json
import pathlib
import threading

import pytest
from pyspark.sql import functions as F

from siftworks.operators import history as h
from siftworks.operators.dedupe import keep_first
from siftworks.sources import tables, versions

SF = "/root/testdata/sf0.001"


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select("id", (F.col("id") % 3).alias("kind"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_each_load_replaces_the_whole_table(spark, tmp_path):
    table = str(tmp_path / "t")
    first = versions.load(numbers(spark, 100).repartition(4), table, note="first")
    before = versions.read(spark, table)
    second = versions.load(numbers(spark, 7, start=1000), table)
    assert (first.version, first.rows, second.version, second.rows) == (1, 100, 2, 7)
    assert sum(first.files.values()) == 100 and len(first.files) == 4
    assert ids(versions.read(spark, table)) == list(range(1000, 1007))
    # A reader that began before stays with what it saw.
    assert ids(before) == ids(versions.read(spark, table, 1)) == list(range(100))
    assert [tuple(r) for r in versions.history(spark, table).orderBy("version").collect()] == [
        (1, 100, 4, "first"),
        (2, 7, len(second.files), ""),
    ]
    assert versions.roll_back(spark, table, 1).version == 3
    assert ids(versions.read(spark, table)) == list(range(100))


def test_a_load_that_dies_is_never_seen(spark, tmp_path):
    """Half of the tasks write their files, then one fails: as when a job is killed."""
    table = str(tmp_path / "t")
    versions.load(numbers(spark, 50), table)
    rows = numbers(spark, 400).repartition(8, "id")
    dies = rows.withColumn("kind", F.when(F.col("id") == 399, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("kind")))
    with pytest.raises(Exception, match="killed"):
        versions.load(dies, table)
    assert versions.numbers(spark, table) == [1]
    assert ids(versions.read(spark, table)) == list(range(50))
    # What it left behind is not in the way of the next load, and can be cleared.
    left = {p.name for p in pathlib.Path(table, "data").iterdir()}
    assert versions.load(numbers(spark, 400), table).rows == 400
    assert ids(versions.read(spark, table)) == list(range(400))
    kept = {versions.version(spark, table, n).folder for n in (1, 2)}
    assert set(versions.clear(spark, table, keep=2, older_than_seconds=0)) == left - kept


def test_killed_between_data_and_manifest(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    versions.load(numbers(spark, 5), table)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "_publish", killed)
    with pytest.raises(KeyboardInterrupt):
        versions.load(numbers(spark, 9), table)
    monkeypatch.undo()
    assert versions.numbers(spark, table) == [1]
    assert versions.read(spark, table).count() == 5
    # Also when it died while it wrote the manifest under its other name.
    pathlib.Path(table, "manifests", ".half").write_text('{"version": 2, "fol')
    assert versions.version(spark, table).version == 1


def test_readers_beside_loads_see_whole_versions(spark, tmp_path):
    table = str(tmp_path / "t")
    versions.load(numbers(spark, 10), table)
    seen, stop = [], threading.Event()

    def reader():
        while not stop.is_set():
            rows = ids(versions.read(spark, table))
            seen.append((len(rows), rows[0]))

    thread = threading.Thread(target=reader)
    thread.start()
    for k in range(1, 5):
        versions.load(numbers(spark, 10 + k, start=1000 * k).repartition(6), table)
    stop.set()
    thread.join()
    assert set(seen) <= {(10 + k, 1000 * k) for k in range(5)} and len(seen) > 1


def test_loads_that_end_together_get_a_number_each(spark, tmp_path):
    table = str(tmp_path / "t")
    made = []
    threads = [
        threading.Thread(target=lambda k=k: made.append(versions.load(numbers(spark, k + 1), table))) for k in range(4)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v.version for v in made) == versions.numbers(spark, table) == [1, 2, 3, 4]
    for v in made:
        assert versions.read(spark, table, v.version).count() == v.rows


def test_tables_without_rows_or_versions(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(versions.NoVersion):
        versions.read(spark, table)
    empty = numbers(spark, 0)
    assert versions.load(empty, table).rows == 0
    assert versions.read(spark, table).dtypes == empty.dtypes
    assert versions.read(spark, table).count() == 0
    with pytest.raises(versions.NoVersion):
        versions.read(spark, table, 9)


def test_counts_are_those_of_the_footers(spark, tmp_path):
    table = str(tmp_path / "t")
    made = versions.load(numbers(spark, 300).repartition(5), table, partition_by=("kind",))
    assert made.rows == 300 and all(name.startswith("kind=") for name in made.files)
    plan = spark.read.parquet(f"{table}/data/{made.folder}").groupBy("_metadata.file_path").count()
    assert "ReadSchema: struct<>" in plan._jdf.queryExecution().executedPlan().toString()
    manifest = json.loads(next(pathlib.Path(table, "manifests").glob("0*.json")).read_text())
    assert manifest["rows"] == 300 and manifest["files"] == made.files


def test_load_table_keeps_what_was_there_until_it_is_done(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.load_table(numbers(spark, 20), path) == 20
    bad = numbers(spark, 3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.load_table(bad, path)
    assert tables.read_table(spark, path).count() == 20
    assert tables.load_table(numbers(spark, 3), path) == 3
    assert ids(tables.read_table(spark, path)) == [0, 1, 2]


# --- History ----------------------------------------------------------------


def feed(spark, rows):
    return spark.createDataFrame(rows, "n long, key string, day string")


def union_dedupe(rows):
    """First row of each key in order of n; rows without a key all stay."""
    seen, out = set(), []
    for n, key, day in sorted(rows):
        if key is None or key not in seen:
            out.append((n, key, day))
            seen.add(key)
    return out


@pytest.mark.parametrize("blocks", [1, 5])
def test_day_by_day_equals_all_at_once(spark, tmp_path, blocks):
    rows = [(n, None if n % 17 == 0 else f"k{(n * n) % 211}", f"2024-01-{1 + n // 100:02d}") for n in range(600)]
    rows += [(600 + n, "hot", "2024-01-07") for n in range(200)] + [(800 + n, "hot", "2024-01-08") for n in range(5)]
    store = h.History(spark, str(tmp_path / "h"), blocks)
    got = []
    for day in sorted({r[2] for r in rows}):
        today = feed(spark, [r for r in rows if r[2] == day]).repartition(3)
        new = store.new_rows(today, ["key"], ["n"], "n") if day > "2024-01-01" else keep_first(today, ["key"], ["n"], "n")
        got += [tuple(r) for r in new.collect()]
        store.add(today, F.col("key"), F.col("day"))
    assert sorted(got) == union_dedupe(rows)


def test_a_late_copy_of_any_age_is_found(spark, tmp_path):
    store = h.History(spark, str(tmp_path / "h"), 4)
    for k in range(3):
        store.add(feed(spark, [(k, f"k{k}", f"2020-0{k + 1}-01")]), F.col("key"), F.col("day"))
    late = feed(spark, [(9, "k0", "2024-01-01"), (10, "k2", "2024-01-01"), (11, "new", "2024-01-01"), (12, None, "x")])
    assert {r["n"] for r in store.new_rows(late, ["key"], ["n"], "n").collect()} == {11, 12}


def test_adding_a_period_again_replaces_it(spark, tmp_path):
    store = h.History(spark, str(tmp_path / "h"), 2)
    store.add(feed(spark, [(1, "wrong", "d1"), (2, "other", "d2")]), F.col("key"), F.col("day"))
    store.add(feed(spark, [(1, "right", "d1"), (1, "right", "d1"), (3, None, "d1")]), F.col("key"), F.col("day"))
    assert sorted(map(tuple, store.keys().select("period", "key").collect())) == [("d1", "right"), ("d2", "other")]
    asked = spark.createDataFrame([(x,) for x in ("wrong", "right", "other", None)], "key string")
    assert sorted(r["key"] for r in store.known(asked).collect()) == ["other", "right"]


def test_filters_miss_nothing_and_are_seldom_wrong(spark):
    keys = spark.range(20_000).select(F.lit("p").alias("period"), F.concat(F.lit("key "), "id").alias("key"))
    blocks = h.blocks_for(20_000)
    found = h.filters(keys, blocks)
    assert h.probe(keys.select("key"), found, blocks).count() == 20_000
    others = spark.range(20_000, 40_000).select(F.concat(F.lit("key "), "id").alias("key"))
    assert h.probe(others, found, blocks).count() < 20_000 * 0.03
    # A filter of all periods together is the union of theirs.
    halves = h.filters(keys.withColumn("period", F.length("key").cast("string")), blocks)
    assert sorted(map(tuple, h.merged(halves).collect())) == sorted(map(tuple, h.merged(found).collect()))


def test_only_candidates_meet_the_stored_keys(spark, tmp_path):
    store = h.History(spark, str(tmp_path / "h"), 8)
    store.add(feed(spark, [(n, f"k{n}", f"d{n % 4}") for n in range(400)]), F.col("key"), F.col("day"))
    fresh = spark.range(300).select(F.concat(F.lit("unseen "), "id").alias("key"))
    assert h.probe(fresh, h.merged(store.filters()), 8).count() < 5
    assert store.known(fresh).count() == 0
    fill = {r["period"]: (r["keys"], r["bits_set"]) for r in store.fill().collect()}
    assert set(fill) == {"d0", "d1", "d2", "d3"} and all(k == 100 and 600 < b <= 700 for k, b in fill.values())


def test_larger_filters_from_the_stored_keys(spark, tmp_path):
    store = h.History(spark, str(tmp_path / "h"), 1)
    store.add(feed(spark, [(n, f"k{n}", "d") for n in range(50)]), F.col("key"), F.col("day"))
    larger = store.rebuilt(16)
    asked = spark.createDataFrame([("k1",), ("k49",), ("k50",)], "key string")
    assert sorted(r["key"] for r in larger.known(asked).collect()) == ["k1", "k49"]
    assert larger.filters().select("block").distinct().count() > 1


def test_keys_of_several_columns_stay_apart(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "b1"), (2, "ab", "1"), (3, "a", None)], "n long, x string, y string")
    store = h.History(spark, str(tmp_path / "h"), 2)
    store.add(rows.filter("n = 1"), h.joined_key(["x", "y"]), F.lit("p"))
    assert {r["n"] for r in store.new_rows(rows, ["x", "y"], ["n"], "n").collect()} == {2, 3}
