import random

import pytest
from pyspark.sql import functions as F

from siftworks.operators import dedupe
from siftworks.operators.numbering import number_rows

ORDER = ["place"]


@pytest.fixture(scope="module")
def rows():
    """A third of the rows share one key, some have none; payloads differ."""
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 100 + [f"k{rng.randrange(300)}" for _ in range(700)]
    rng.shuffle(keys)
    places = rng.sample(range(10_000), len(keys))
    return [(k, p, i, f"payload {i}") for i, (k, p) in enumerate(zip(keys, places))]


def table(spark, rows, partitions=8):
    schema = "key string, place bigint, id bigint, payload string"
    return spark.createDataFrame(rows, schema).repartition(partitions)


def firsts(rows, null_keys="keep"):
    found = {}
    for k, p, i, v in rows:
        group = (None, i) if k is None and null_keys == "keep" else (k,)
        found[group] = min(found.get(group, (p, k, i, v)), (p, k, i, v), key=lambda r: r[0])
    return sorted((p, i, v) for p, k, i, v in found.values())


def got(df):
    return sorted((r["place"], r["id"], r["payload"]) for r in df.collect())


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_first_row_of_each_key_whatever_the_partitioning(spark, rows, partitions):
    df = table(spark, rows, partitions)
    want = firsts(rows)
    assert got(dedupe.keep_first(df, ["key"], ORDER, "id")) == want
    assert got(dedupe.keep_first(df, ["key"], ORDER)) == want
    assert got(dedupe.collapse_copies(df, ["key"], ORDER, "id")) == want


def test_null_keys_can_be_collapsed(spark, rows):
    df = table(spark, rows)
    want = firsts(rows, "collapse")
    assert got(dedupe.keep_first(df, ["key"], ORDER, "id", "collapse")) == want
    collapsed = dedupe.collapse_copies(df, ["key"], ORDER, "id", null_keys="collapse")
    assert got(collapsed) == want


def test_copies_add_up_to_the_input(spark, rows):
    copies = dedupe.collapse_copies(table(spark, rows), ["key"], ORDER, "id")
    assert copies.agg(F.sum("copies")).first()[0] == len(rows)
    assert copies.filter("key = 'hot'").first()["copies"] == 400
    assert copies.filter("key IS NULL").agg(F.max("copies")).first()[0] == 1


def test_ties_are_broken_by_the_row_id(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 1), ("a", 1, 3)], "key string, place int, id int")
    kept = dedupe.keep_first(df, ["key"], ["place"], "id").collect()
    assert [r["id"] for r in kept] == [1]
    assert dedupe.collapse_copies(df, ["key"], ["place"], "id").first()["id"] == 1


def test_a_hot_key_is_reduced_before_the_shuffle(spark, rows):
    plan = dedupe.keep_first(table(spark, rows), ["key"], ORDER, "id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    before_shuffle = text.split("Exchange hashpartitioning(key")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_composite_keys(spark):
    df = spark.createDataFrame(
        [(1, "x", 5, 0), (1, "x", 4, 1), (1, None, 3, 2), (1, None, 2, 3), (2, "x", 1, 4)],
        "a int, b string, place int, id int",
    )
    kept = dedupe.keep_first(df, ["a", "b"], ["place"], "id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3, 4]


def test_later_occurrences(spark, rows):
    df = table(spark, rows)
    seen, want = set(), []
    for k, p, i, v in sorted(rows, key=lambda r: r[1]):
        if k in seen and k is not None:
            want.append(p)
        seen.add(k)
    later = dedupe.later_occurrences(df, "key", "place").collect()
    assert sorted(r["place"] for r in later) == sorted(want)


def test_duplicate_counts(spark, rows):
    kept = len(firsts(rows))
    counts = dedupe.duplicate_counts(table(spark, rows), "key").first()
    assert tuple(counts) == (len(rows), kept, len(rows) - kept)
    empty = dedupe.duplicate_counts(table(spark, [], 1), "key").first()
    assert tuple(empty) == (0, 0, 0)


@pytest.mark.parametrize("buckets", [1, 7, 500])
def test_row_numbers(spark, rows, buckets):
    df = table(spark, rows)
    numbered = number_rows(df, "place", 10_000, ["id"], "n", buckets).collect()
    want = {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1)}
    assert {r["id"]: r["n"] for r in numbered} == want


def test_row_numbers_with_ties(spark):
    df = spark.createDataFrame([(5, i) for i in range(20)] + [(1, 99)], "place bigint, id bigint")
    numbered = number_rows(df, "place", 10, ["id"], "n").collect()
    assert sorted((r["n"], r["id"]) for r in numbered)[:3] == [(1, 99), (2, 0), (3, 1)]
    assert len({r["n"] for r in numbered}) == 21


@pytest.mark.parametrize("buckets", [1, 4, 100])
def test_row_numbers_of_missing_negative_and_large_values(spark, buckets):
    places = [5, None, -3, 1, 2**40, None, 99, -(2**40), 100, 0]
    df = spark.createDataFrame(list(enumerate(places)), "id int, place bigint")
    numbered = number_rows(df, "place", 100, ["id"], "n", buckets).collect()
    order = sorted(range(len(places)), key=lambda i: (places[i] is not None, places[i] or 0, i))
    assert {r["id"]: r["n"] for r in numbered} == {i: n for n, i in enumerate(order, 1)}
