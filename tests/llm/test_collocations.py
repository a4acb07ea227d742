import collections
import re

import numpy as np
import pytest

from siftworks.llm import collocations as c
from siftworks.llm import queries
from tests.compare import connect, difference
from tests.llm.rows import SF, documents, given

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count=30, top=2000):
    """The contract in plain Python."""
    f, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    f = {k: n for k, n in f.items() if n >= min_count}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        score, _, left, right = min(
            (2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))
        )
        absorbed = any(
            100 * n >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (other, q), n in f.items()
            if other == lang and len(q) > len(p)
        )
        if not absorbed:
            out.append((lang, -score, -a, " ".join(p).encode(), left, right))
    ranked, at = [], collections.Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        at[lang] += 1
        if at[lang] <= top:
            ranked.append((lang, at[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return ranked


def rows(df):
    return sorted(tuple(r[x] for x in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_given_documents(spark):
    docs = given(spark)
    want = brute([(r["text"], r["lang"]) for r in docs.collect()])
    assert rows(c.collocation_digest(docs)) == want
    assert difference(queries.op13_collocations(spark, SF), connect(SF), c.ORACLE) is None


AWKWARD = [
    "New York City, new york. NEW\tYORK city!",
    "new york:new york;york new\x0bnew york\x0cnew york\rnew york",
    "a a a a a a",
    "é É ß é É ß",
    "Zürich ist schön. Zürich ist schön",
    " \t . , \n",
]


def awkward():
    texts = [(i, t, lang, "s") for i, t in enumerate(AWKWARD) for lang in ("en", None, "und", "")]
    texts += [(90, None, "en", None), (None, "new york", "en", None), (91, "", None, None), (92, "x y " * 40_000, "xx", "s")]
    return texts * 3


def test_awkward_documents(spark):
    texts = awkward()
    docs = documents(spark, texts).repartition(5)
    want = brute([(t, lang) for _, t, lang, _ in texts], min_count=3)
    assert len(want) > 20
    got = c.collocations(docs, min_count=3, n_bits=1 << 12)
    assert rows(got) == want
    assert c.collocation_digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("proposed", [1, 2, 10**9])
def test_whatever_the_sample_proposes(spark, proposed):
    """No phrase is lost when the sample proposes nothing at all: passes make up for it."""
    texts = awkward()
    docs = documents(spark, texts)
    want = brute([(t, lang) for _, t, lang, _ in texts], min_count=3)
    known, _, passes = c.frequent_phrases(docs, min_count=3, sample=2, proposed=proposed, n_bits=1 << 16)
    # Nothing proposed: one pass for each length, and one that counts the longest by text.
    assert passes == (5 if proposed == 10**9 else passes)
    assert known.groupBy("lang", "phrase").count().filter("count > 1").count() == 0
    assert rows(c.collocations(docs, min_count=3, sample=2, proposed=proposed, n_bits=1 << 16)) == want


def test_a_full_bit_table_only_costs_time(spark):
    docs = given(spark)
    want = brute([(r["text"], r["lang"]) for r in docs.collect()])
    assert rows(c.collocations(docs, n_bits=1 << 9)) == want


def test_ties_at_the_end_go_by_the_phrase(spark):
    texts = [(1, f"{x} {y}.", "en", "s") for x in "bac" for y in "é日z"] * 4
    docs = documents(spark, texts)
    want = brute([(t, lang) for _, t, lang, _ in texts], min_count=4, top=3)
    assert rows(c.collocations(docs, top=3, min_count=4)) == want


def test_phrases_that_share_a_hash(spark, monkeypatch):
    """Hashes of few values: what shares one only looks more frequent than it is."""
    docs = documents(spark, awkward())
    want = rows(c.collocations(docs, min_count=3))
    plain = c._longer
    monkeypatch.setattr(c, "_longer", lambda h, word: plain(h, word) % np.uint64(97))
    assert rows(c.collocations(docs, min_count=3, proposed=10**9)) == want


def test_rare_failures_take_one_pass_more(spark):
    """A phrase that the sample misses opens all that it is in at once."""
    texts = [(i, "one two three four five " * 400, "en", "s") for i in range(6)]
    texts += [(10 + i, f"x{i} rare  old\tphrase indeed x{i}. one rare old", "en", "s") for i in range(12)]
    docs = documents(spark, texts)
    want = brute([(t, lang) for _, t, lang, _ in texts], min_count=10)
    assert "rare old phrase indeed" in {r[2] for r in want}
    known, _, passes = c.frequent_phrases(docs, min_count=10, sample=2, proposed=100)
    assert passes == 2
    assert known.groupBy("lang", "phrase").count().filter("count > 1").count() == 0
    assert rows(c.collocations(docs, min_count=10, sample=2, proposed=100)) == want


@pytest.mark.parametrize("limit", [1, 12, 1 << 18])
def test_texts_of_phrases(monkeypatch, limit):
    monkeypatch.setattr(c, "PHRASE_BYTES", limit)
    data = b"ab  c\td\xc3\xa9 f"
    buffer = np.frombuffer(data + bytes(8), np.uint8)
    start, length = np.array([0, 4, 6, 10]), np.array([2, 1, 3, 1])

    def said(at, m):
        return [x for part in c._phrases(buffer, start, length, np.array(at), m) for x in part.to_pylist()]

    assert said([0, 1, 0], 3) == [b"ab c d\xc3\xa9", b"c d\xc3\xa9 f", b"ab c d\xc3\xa9"]
    assert said([3, 0], 1) == [b"f", b"ab"]
