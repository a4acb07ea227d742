import collections
import hashlib

import pytest

from siftworks.llm import line_dedup, mixing
from tests.compare import connect, difference
from tests.llm.rows import SF, WORD, documents, given, rows_of

BLANKS = " \t\n\x0b\x0c\r"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def kept_lines(texts, least=10):
    lines = [(t or "").split("\n") for t in texts]
    key = lambda x: x.strip(BLANKS).translate(UPPER)
    counts = collections.Counter(k for part in lines for k in {key(x) for x in part})
    out = []
    for part in lines:
        kept = [x for x in part if not key(x) or counts[key(x)] < least]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((len(part), len(part) - len(kept), digest))
    return out


def test_line_dedup_equals_its_sql(spark):
    con = connect(SF)
    assert difference(line_dedup.line_dedup_digest(given(spark)), con, line_dedup.ORACLE) is None


def test_line_dedup_on_awkward_documents(spark):
    more = [(100 + i, f" Shared LINE\t\nown {i}\n\nshared line\x0b", "en", "a") for i in range(9)]
    more += [(200, "shared line", "en", "a"), (201, "Äshared line", "en", "a")] + [(None, "x\nsHARED line", None, None)] * 3
    from tests.llm.rows import TEXTS

    texts = TEXTS + more
    got = rows_of(line_dedup.line_dedup_digest(documents(spark, texts)))
    want = [(i, *k) for (i, *_), k in zip(texts, kept_lines([t for _, t, *_ in texts]), strict=True)]
    assert got == sorted(want, key=repr)
    assert sum(w[2] for w in want) == 9 * 2 + 1 + 3


def test_lines_below_the_threshold_stay(spark):
    texts = [(i, "same line\nmine", "en", "a") for i in range(9)]
    out = line_dedup.without_repeated_lines(documents(spark, texts))
    assert out.columns == documents(spark, []).columns
    assert rows_of(out) == rows_of(documents(spark, texts))


def test_line_dedup_of_nothing(spark):
    assert line_dedup.line_dedup_digest(documents(spark, [])).count() == 0


def test_mixing_equals_its_sql(spark):
    assert difference(mixing.mixing_digest(given(spark)), connect(SF), mixing.ORACLE) is None


def test_mixing_on_awkward_documents(spark):
    from tests.llm.rows import TEXTS

    got = mixing.mixing_digest(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    assert sum(r["size"] for r in got) == sum(len(WORD.findall(t or "")) for _, t, *_ in TEXTS)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert sum(r["taken"] for r in got) == pytest.approx(1.5 * sum(r["size"] for r in got), abs=16 * 5)


def test_mixing_of_nothing(spark):
    assert mixing.mixing_digest(documents(spark, [])).count() == 0
    empty = documents(spark, [(1, None, "en", "a"), (2, " ", "en", None)])
    assert {r["taken"] for r in mixing.mixing_digest(empty).collect()} == {0}


@pytest.mark.parametrize("block,shard", [(1, 100), (16, 1000), (64, 1 << 18)])
def test_taken_words_meet_the_targets(spark, block, shard):
    docs = given(spark)
    out = mixing.mix(docs, block_words=block, shard_words=shard).join(docs.select("doc_id", "source"), "doc_id")
    per_source = collections.defaultdict(lambda: [0, 0.0, 0, 0])
    for r in out.collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = per_source[r["source"]]
        s[0], s[1], s[2] = s[0] + r["taken"], r["target"], r["source_size"]
    for taken, target, size, _ in per_source.values():
        assert target <= 2 * size
        assert abs(taken - target) <= block * (2 + size / shard)


def highest_quotients(weights, seats):
    got = [0] * len(weights)
    for _ in range(seats):
        i = max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@pytest.mark.parametrize(
    "weights,seats",
    [([53.0, 24.0, 23.0], 7), ([1.0] * 9, 4), ([1000.0, 1.0, 1.0, 1.0], 50), ([5.0, 0.0, 3.5], 11), ([7.0], 3), ([1.0, 1.0], 0)],
)
def test_apportionment_is_by_highest_quotients(spark, weights, seats):
    items = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)], "g int, i int, w double, s long")
    got = {r["i"]: r["q"] for r in mixing.apportion(items, ["g"], "i", "w", "s", "q").collect()}
    assert [got[i] for i in range(len(weights))] == highest_quotients(weights, seats)


def test_the_mix_holds_the_words_that_it_says(spark):
    docs = given(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = collections.Counter()
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["text"] in whole[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixing_digest(docs).collect() if r["taken"]}
    assert dict(words) == taken


def test_the_mix_of_awkward_documents(spark):
    docs = documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    total = sum(len(WORD.findall(r["text"])) for r in mixed.collect())
    assert total == sum(r["taken"] for r in mixing.mixing_digest(docs).collect())
