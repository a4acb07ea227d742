"""Unmatched spellings against all pairs by brute force."""

import random

from hypothesis import given as each
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftworks.operators import spelling


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(values, known, within, fold=True):
    form = (lambda t: t.strip(" ").lower()) if fold else (lambda t: t)
    pairs = {(v, k, edit_distance(form(v), form(k))) for v in values for k in known if v is not None and k is not None}
    return sorted(p for p in pairs if p[2] <= within)


def frame(spark, texts, name):
    return spark.createDataFrame([(t,) for t in texts], f"{name} string")


def found(spark, values, known, within, fold=True):
    out = spelling.neighbours(frame(spark, values, "v"), "v", frame(spark, known, "k"), "k", within, fold)
    return sorted(tuple(r) for r in out.collect())


def damaged(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        text = rng.choice([text[:at] + "q" + text[at:], text[:at] + text[at + 1 :], text[:at] + "z" + text[at + 1 :]])
    return text


def test_all_pairs_of_short_and_long_texts(spark):
    rng = random.Random(4)
    known = ["", "a", "Fall", "fall ", "Back pain", "x" * 39, "y" * 41, "ab" * 20, "abc" * 14]
    known += ["".join(rng.choice("abcde ") for _ in range(n)) for n in (8, 30, 37, 38, 39, 40, 41, 42, 43, 44, 90, 300)]
    values = [damaged(rng, k, e) for k in known for e in (0, 1, 1, 2, 2, 2, 3)] + [None, "no match at all"]
    for within in (0, 1, 2):
        assert found(spark, values + values, known + [None, known[3]], within) == brute(values, known, within)
    assert found(spark, values, known, 2, fold=False) == brute(values, known, 2, fold=False)


def test_the_nearest_and_ties(spark):
    values = frame(spark, ["falll", "FALL", "bat", "xxxxxxxx"], "v")
    known = frame(spark, ["Fall", "Hall", "cat", "hat"], "k")
    got = sorted(tuple(r) for r in spelling.meant(values, "v", known, "k").collect())
    assert got == [("FALL", "Fall", 0, 1), ("bat", None, 1, 2), ("falll", "Fall", 1, 1)]
    assert spelling.meant(values.limit(0), "v", known, "k").count() == 0
    assert spelling.meant(values, "v", known.limit(0), "k").count() == 0


def test_characters_beyond_the_basic_plane(spark):
    values, known = ["\U0001f600x", "\U0001f600"], ["\U0001f601x", "x\U0001f600", "\u00e9"]
    assert found(spark, values, known, 1) == brute(values, known, 1)


def test_neither_side_is_broadcast(spark):
    """A side looks as small as its texts, while its hashes are many times that."""
    names = spark.range(20_000).select(F.format_string("Customer#%09d", "id").alias("k"))
    values = names.select(F.expr("substr(k, 2)").alias("v"))
    pairs = spelling.neighbours(values, "v", names, "k", within=1, fold_case=False)
    assert pairs.filter("distance = 1 and known = concat('C', value)").count() == pairs.count() == 20_000
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=5, deadline=None)
@each(st.lists(st.text(alphabet="ab", max_size=6), min_size=1, max_size=8))
def test_texts_of_two_letters(spark, texts):
    assert found(spark, texts, texts, 1, fold=False) == brute(texts, texts, 1, fold=False)
