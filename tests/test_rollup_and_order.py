"""Row numbers in any order, and rollups by period, against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from siftworks.operators import numbering, rollup

ROWS = 20_000


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows share a text; some are missing, some rows are repeated."""
    rng = random.Random(5)
    made = []
    for i in range(ROWS):
        text = rng.choice(["hot", "hot", rng.choice(["", "é", "z", "Z", None]), f"w{rng.randrange(900)}", f"w{rng.randrange(9)}"])
        made.append((f"2024-{1 + i % 12:02d}", text, rng.choice([None, *range(-700, 700)]), i // 2))
    return spark.createDataFrame(made, "month string, text string, value bigint, id bigint").repartition(13)


def in_order(r):
    return (r["text"] is not None, (r["text"] or "").encode())


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_numbers_of_texts(spark, rows, tmp_path, ranges):
    out = numbering.number_in_order(rows, ["text", F.desc("id")], "no", str(tmp_path / "n"), ranges)
    assert out.columns == [*rows.columns, "no"]
    got = sorted(out.collect(), key=lambda r: r["no"])
    assert [r["no"] for r in got] == list(range(1, ROWS + 1))
    want = sorted(rows.collect(), key=lambda r: (*in_order(r), -r["id"]))
    assert [(r["text"], r["id"]) for r in got] == [(r["text"], r["id"]) for r in want]


def test_a_hot_value_is_split(spark, tmp_path):
    """Rows that are all alike go to several ranges, and each gets its own number."""
    alike = spark.range(5_000, numPartitions=5).select(F.lit("x").alias("text"))
    out = numbering.number_in_order(alike, ["text"], "no", str(tmp_path / "n"), 8)
    assert sorted(r["no"] for r in out.collect()) == list(range(1, 5_001))
    ranges = spark.read.parquet(str(tmp_path / "n")).groupBy(F.shiftright("_at", 33)).count().collect()
    assert len(ranges) == 8 and max(r["count"] for r in ranges) < 2_000


def test_no_rows_and_nothing_but_null(spark, rows, tmp_path):
    assert numbering.number_in_order(rows.limit(0), ["text"], "no", str(tmp_path / "a")).count() == 0
    nulls = spark.createDataFrame([(None,), (None,)], "text string")
    got = numbering.number_in_order(nulls, [F.desc("text")], "no", str(tmp_path / "b"), 3).collect()
    assert sorted(r["no"] for r in got) == [1, 2]


def test_exact_rollups_of_spans(spark, rows, tmp_path):
    counts = rollup.value_counts(rows, F.col("month"), F.col("value"))
    bits = rollup.key_bits(rows, F.col("month"), F.col("value"))
    for made, name in ((counts, "counts"), (bits, "bits")):
        rollup.store(made, str(tmp_path / name))
        # A period again replaces it and leaves the others.
        rollup.store(made.filter("period = '2024-03'"), str(tmp_path / name))
    counts = rollup.stored(spark, str(tmp_path / "counts"), counts)
    bits = rollup.stored(spark, str(tmp_path / "bits"), bits)
    plain = [(r["month"], r["value"]) for r in rows.collect() if r["value"] is not None]
    for first, last in (("2024-01", "2024-12"), ("2024-03", "2024-03"), ("2024-02", "2024-07")):
        span = F.col("period").between(first, last)
        values = sorted(v for m, v in plain if first <= m <= last)
        [got] = rollup.quantiles(counts.filter(span), [0, 0.5, 1]).collect()
        assert (got["n"], got["quantiles"]) == (len(values), [values[0], statistics.median(values), values[-1]])
        [got] = rollup.distinct_keys(bits.filter(span)).collect()
        assert got["distinct_keys"] == len(set(values))
    assert rollup.quantiles(counts.filter("false"), [0.5], "period").count() == 0
    assert rollup.distinct_keys(bits.filter("false"), "period").count() == 0


def test_sketches_of_spans(spark, rows, tmp_path):
    made = rollup.sketches(rows, F.col("month"), F.col("value"))
    rollup.store(made, str(tmp_path / "s"))
    found = rollup.stored(spark, str(tmp_path / "s"), made)
    plain = [(r["month"], r["value"]) for r in rows.collect() if r["value"] is not None]
    for first, last in (("2024-01", "2024-12"), ("2024-05", "2024-05")):
        span = F.col("period").between(first, last)
        values = sorted(v for m, v in plain if first <= m <= last)
        [got] = rollup.quantile_estimates(found.filter(span), [0.1, 0.5, 0.9]).collect()
        assert got["n"] == len(values)
        for fraction, v in zip([0.1, 0.5, 0.9], got["quantiles"], strict=True):
            below, upto = sum(x < v for x in values), sum(x <= v for x in values)
            assert below / len(values) - 0.03 <= fraction <= upto / len(values) + 0.03
        [got] = rollup.distinct_estimate(found.filter(span)).collect()
        assert got["distinct_values"] == pytest.approx(len(set(values)), rel=0.05)
