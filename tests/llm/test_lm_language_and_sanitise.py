import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from siftworks.llm import language_id, lm_scoring, sanitise, words
from tests.llm.rows import SF, TEXTS, documents, given, tokens


def base_scores(docs):
    split = {k: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for k, (i, _) in enumerate(docs)}
    parts = [[*tokens(t), None] for _, t in docs]
    c = collections.Counter(w for k, part in enumerate(parts) if not split[k] for w in part)
    n, v = sum(c.values()), len(c)
    return [
        (i, split[k], len(p), sum(c[w] > 0 for w in p), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in p))
        for k, ((i, _), p) in enumerate(zip(docs, parts, strict=True))
    ]


@pytest.mark.parametrize("head", [1 << 20, 300, 0])
def test_counts_and_base_scores(spark, monkeypatch, head):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
    docs = given(spark)
    got = {r["doc_id"]: r for r in lm_scoring.lm_digest(docs).collect()}
    for i, held, n, known, train, base in base_scores([(r["doc_id"], r["text"]) for r in docs.collect()]):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_of_awkward_documents(spark):
    got = sorted(
        ((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in lm_scoring.lm_digest(documents(spark)).collect()),
        key=repr,
    )
    want = [(*r[:5], round(r[5], 6)) for r in base_scores([(i, t) for i, t, *_ in TEXTS])]
    assert got == sorted(want, key=repr)
    assert lm_scoring.lm_digest(documents(spark, [])).count() == 0


def test_nothing_to_train_on(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    out = lm_scoring.lm_digest(documents(spark, [(i, "a b", "en", "a") for i in held])).collect()
    assert all(r["n_known"] == 0 and r["score"] == r["base_score"] for r in out)


def test_held_out_score_a_token(spark):
    """With corpus shares within classes it was about -3.2."""
    docs = given(spark, sf=SF.replace("0.001", "0.01"))
    held = [r for r in lm_scoring.lm_digest(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > -3.125


def of_parts(docs):
    return docs.select("text", F.xxhash64("doc_id", "text").alias("part"))


def test_probabilities_add_up_to_one(spark):
    """Over the vocabulary and the unknown token, after some context."""
    texts = of_parts(given(spark))
    vocab = lm_scoring.vocabulary(texts)
    model = lm_scoring.fit(texts, vocab)
    data = b"the of and"
    t = lm_scoring.tokens(words.padded(np.frombuffer(data, np.uint8), 0, len(data)), np.array([0, len(data)]))
    place = model.find(t)
    after = model.features(t, place, model.classes(t, place))[-1:]
    rows = vocab.toPandas()
    at = model.index.find(rows["h"].to_numpy().view(np.uint64))
    of_word = lm_scoring.Tokens(rows["h"].to_numpy().view(np.uint64), rows["ending"].to_numpy(), np.zeros(len(rows)), 1)
    classes, leaves = model.classes(of_word, at), model.leaves(at)
    p, unknown = (np.exp(x) for x in model.log_probabilities(np.repeat(after, len(rows), axis=0), classes, leaves))
    inside = (rows["c"].to_numpy() - lm_scoring.DISCOUNT) / model.mass[classes, leaves]
    assert unknown[0] + (p * inside).sum() == pytest.approx(1.0, abs=1e-4)
    assert len(np.unique(leaves[classes > lm_scoring.ALONE])) > 200


@pytest.mark.parametrize("head", [1 << 20, 300])
def test_leaves_hold_the_mass_of_their_class(head):
    rng = np.random.default_rng(3)
    count = np.sort(rng.zipf(1.5, head if head < 1000 else 5000))[::-1].astype(np.int64)
    classes = rng.integers(0, lm_scoring.CLASSES, len(count))
    total = np.bincount(classes, count - lm_scoring.DISCOUNT, lm_scoring.CLASSES) + 7
    leaf, mass = lm_scoring._leaves(classes, count, total)
    assert mass.sum(axis=1) == pytest.approx(total)
    held = np.zeros_like(mass)
    np.add.at(held, (classes, leaf), count - lm_scoring.DISCOUNT)
    held[:, -1] += 7
    assert mass == pytest.approx(held)
    for k in range(lm_scoring.CLASSES):
        assert (np.diff(leaf[classes == k].astype(int)) >= 0).all()


def test_sums_by_row():
    rng = np.random.default_rng(5)
    rows = np.stack([rng.integers(0, high, 3000) for high in (2, 50, 60000)], axis=1).astype(np.uint16)
    z = rng.normal(size=(3000, 4))
    at, times, sums = lm_scoring._sums_by_row(z, rows)
    want, seen = np.zeros((65536, 4)), np.zeros(65536, int)
    for k in range(3):
        np.add.at(want, rows[:, k], z)
        np.add.at(seen, rows[:, k], 1)
    assert sorted(at) == list(np.flatnonzero(seen))
    assert (times == seen[at]).all()
    assert sums == pytest.approx(want[at])


@pytest.mark.parametrize("size", [1.0, 12.0, 100.0])
def test_logarithms_of_probabilities(size):
    """By products of powers, and by sums where powers would leave the limits of their type."""
    rng = np.random.default_rng(6)
    weights = (rng.normal(size=(60, 5)) * size).astype(np.float32)
    rows, y = rng.integers(0, 59, (2000, 4)).astype(np.uint16), rng.integers(0, 5, 2000)
    z = weights.astype(float)[rows].sum(axis=1) + weights[59]
    top = z.max(axis=1, keepdims=True)
    want = z - top - np.log(np.exp(z - top).sum(axis=1, keepdims=True))
    got = lm_scoring._log_softmax(weights, lm_scoring._powers(weights, 59, 4), rows, 59, y, 0)
    assert got[0] == pytest.approx(want[np.arange(2000), y], rel=1e-4, abs=1e-4)
    assert got[1] == pytest.approx(want[:, 0], rel=1e-4, abs=1e-4)


def test_steps_by_brute_force(monkeypatch):
    """Narrow tables take as many numbers at once as wide ones, so fewer calls."""
    calls, plain = [], lm_scoring._logits
    monkeypatch.setattr(lm_scoring, "_logits", lambda *of: calls.append(len(of[0])) or plain(*of))
    rng = np.random.default_rng(7)
    n, width = 4 * lm_scoring.BLOCK, lm_scoring.GROUPS
    w = rng.normal(size=(60, width)).astype(np.float32)
    spread, touched = np.full(60, 1e-2, np.float32), np.zeros(60, np.int64)
    rows, y = rng.integers(0, 59, (n, 3)).astype(np.uint16), rng.integers(1, width, n)
    share = rng.random(n).astype(np.float32)
    power = np.exp(w.astype(float)[rows].sum(axis=1))
    z = -power / power.sum(axis=1, keepdims=True)
    z[np.arange(n), y] += 1 - share
    z[:, 0] += share
    sums = np.zeros((60, width))
    for k in range(3):
        np.add.at(sums, rows[:, k], z)
    moved = 1e-2 + (sums**2).mean(axis=1)
    want = w + lm_scoring.RATE / np.sqrt(moved)[:, None] * sums
    lm_scoring._step(w, spread, touched, rows, None, (y, 1 - share), (0, share))
    assert w == pytest.approx(want, rel=1e-3, abs=1e-3)
    assert spread == pytest.approx(moved, rel=1e-3)
    assert (touched == np.bincount(rows.ravel(), minlength=60)).all()
    assert calls == [n]


def test_powers_of_weights_serve_many_calls(monkeypatch):
    rng = np.random.default_rng(8)
    shapes = (
        (lm_scoring.ROWS + 1, lm_scoring.CLASSES),
        (lm_scoring.INNER_ROWS + lm_scoring.CLASSES, lm_scoring.GROUPS),
        (lm_scoring.INNER_ROWS + lm_scoring.CLASSES * lm_scoring.GROUPS, lm_scoring.GROUPS),
    )
    weights = [rng.normal(size=x).astype(np.float32) for x in shapes]
    model = lm_scoring.Model(1, 1, None, *[np.zeros(0)] * 4, 0.0, weights)
    features = rng.integers(0, 1 << 62, (5000, 4)).astype(np.uint64)
    classes, leaves = rng.integers(0, lm_scoring.CLASSES, 5000), rng.integers(0, lm_scoring.LEAVES, 5000)
    want, powers = model.log_probabilities(features, classes, leaves), model.powers()
    monkeypatch.setattr(lm_scoring, "_powers", None)
    got = model.log_probabilities(features, classes, leaves, powers)
    assert all((x == y).all() for x, y in zip(got, want, strict=True))


def test_tokens_and_lookups_by_brute_force():
    rng = np.random.default_rng(9)
    letters = np.frombuffer(b" \t\n\x0b\x0c\r\x08\x0e\x00@AZ[`az{\xc3\xff", np.uint8)
    seen = {}
    for nth in range(300):
        texts = [rng.choice(letters[rng.integers(0, 2) * 5 :], rng.integers(0, (3, 12, 70)[nth % 3])).tobytes() for _ in range(4)]
        data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        t = lm_scoring.tokens(words.padded(data, 0, len(data), lower=True), ends)
        want = [(row, w) for row, x in enumerate(texts) for w in [*re.findall(rb"[^\x20\x09-\x0D]+", x.lower()), None]]
        assert t.row.tolist() == [row for row, _ in want]
        for (_, w), h, ending in zip(want, t.h.tolist(), t.ending.tolist(), strict=True):
            assert seen.setdefault(w, (h, ending)) == (h, ending)
            tail = np.array([int.from_bytes((w or b"")[-3:].rjust(3, b"\0"), "little") + 1], np.uint64)
            assert ending == (0 if w is None else int(words.mix64(tail)[0]) % (lm_scoring.ENDINGS - 1) + 1)
    assert len({h for h, _ in seen.values()}) == len(seen) > 1000
    known = np.array([0, 1, 2, 5, 1 << 40, (1 << 64) - 2, (1 << 64) - 1, *rng.integers(0, 1 << 63, 50)], np.uint64)
    place = {h: k for k, h in enumerate(known.tolist())}
    wanted = np.concatenate([known, known + np.uint64(1), known ^ np.uint64(4)])
    assert words.SortedHashes(known).find(wanted).tolist() == [place.get(h, -1) for h in wanted.tolist()]


def test_company_by_brute_force(spark):
    docs = given(spark).select("text")
    parts = [t for b in docs.toArrow().to_batches() for _, _, t in lm_scoring._token_parts(b.column(0))]
    kinds, counts = np.unique(np.concatenate([t.h for t in parts]), return_counts=True)
    frequent = kinds[np.argsort(-counts, kind="stable")][: lm_scoring.ALONE]
    place = {h: i for i, h in enumerate(frequent.tolist())}
    want = collections.Counter()
    for t in parts:
        h, ending, row = t.h.tolist(), t.ending.tolist(), t.row.tolist()
        for i in range(len(h)):
            for k in range(max(0, i - 3), min(len(h), i + 4)):
                if k != i and row[k] == row[i] and h[k] in place:
                    want[ending[i], place[h[k]]] += 1
    got = lm_scoring.company(docs, frequent)
    assert {(i, j): got[i, j] for i, j in zip(*np.nonzero(got), strict=True)} == want


def test_more_partitions_make_no_more_slices(spark, monkeypatch):
    """What slices send grows with them, so they follow the texts and not the settings."""
    monkeypatch.setattr(lm_scoring, "SLICE_TOKENS", 20_000)
    taught = []
    plain = lm_scoring.train_round

    def counted(texts, shared):
        taught.append(texts.groupBy(F.spark_partition_id()).count().count())
        return plain(texts, shared)

    monkeypatch.setattr(lm_scoring, "train_round", counted)
    frame = type(spark.range(1))
    for name in ("repartition", "repartitionById"):
        plain_deal = getattr(frame, name)
        monkeypatch.setattr(
            frame,
            name,
            lambda self, n, *by, f=plain_deal: f(self, max(n, 61) if by and isinstance(n, int) else n, *by),
        )
    docs = given(spark)
    texts = docs.select("text", F.xxhash64("doc_id", "text").alias("part"))
    model = lm_scoring.fit(texts, lm_scoring.vocabulary(texts))
    slices = round(model.n / 20_000)
    assert slices > 1
    assert sum(taught) <= slices + len(taught)


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    """Neither on the partitions of the input; several slices and rounds, too."""
    docs = given(spark).select("doc_id", "text")
    monkeypatch.setattr(lm_scoring, "SLICE_TOKENS", 20_000)
    one, many = (
        {r["doc_id"]: r["score"] for r in lm_scoring.lm_digest(docs.repartition(k)).collect()} for k in (1, 23)
    )
    assert one.keys() == many.keys()
    assert all(many[i] == pytest.approx(x, rel=1e-5) for i, x in one.items())


def test_held_out_languages(spark):
    docs = given(spark, sf=SF.replace("0.001", "0.01"))
    out = language_id.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_languages_of_awkward_documents(spark):
    out = language_id.language_digest(documents(spark)).collect()
    assert len(out) == len(TEXTS)
    letters = collections.Counter((i, any(c.isalpha() for c in t or "")) for i, t, *_ in TEXTS)
    assert collections.Counter((r["doc_id"], r["lang_pred"] != "und") for r in out) == letters
    assert language_id.language_digest(documents(spark, [])).count() == 0


def test_no_language_to_learn(spark):
    out = language_id.language_digest(documents(spark, [(2, "some text", None, "a")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in out] == [("und", 0.0)]


def test_probabilities_are_those_of_kneser_ney():
    """Against the textbook recursion, and adding up to one."""
    text = {"a": "banana bandana ananas", "b": "otto motto lotto"}
    order, d = language_id.ORDER, language_id.DISCOUNT
    counts = {}
    for language, line in text.items():
        c = collections.Counter()
        for w in line.split():
            w = " " * (order - 1) + w + " "
            c.update(w[i : i + order] for i in range(len(w) - order + 1))
        counts[language] = dict(c)
    models = language_id.Models(["a", "b"], counts)
    chars = sorted({g[-1] for c in counts.values() for g in c})

    def level(language, k):
        if k == order:
            return counts[language]
        return collections.Counter(g[1:] for g in level(language, k + 1))

    def p(language, context, char):
        """Interpolated, with the context shortened one character at a time."""
        k = len(context) + 1
        if k == 0:
            return 1 / (len(chars) + 1)
        grams = level(language, k)
        total = sum(v for g, v in grams.items() if g[:-1] == context)
        lower = p(language, context[1:], char) if k > 1 else 1 / (len(chars) + 1)
        if not total:
            return lower
        kinds = sum(g[:-1] == context for g in grams)
        return max(grams.get(context + char, 0) - d, 0) / total + d * kinds / total * lower

    for language in "ab":
        # Over all characters, and the one for all that were never seen.
        for context in ("ana", "zzz", "n"):
            assert sum(p(language, context, c) for c in [*chars, "\0"]) == pytest.approx(1, abs=1e-9)
    for word in ("banana", "motto", "xylo", "na"):
        w = language_id.distinct_words([word])
        bits = models.bits(w)[0][0]
        padded = " " * (order - 1) + word + " "
        for i, language in enumerate("ab"):
            want = -sum(math.log2(p(language, padded[j : j + order - 1], padded[j + order - 1])) for j in range(len(word) + 1))
            assert bits[i] == pytest.approx(want, rel=1e-9)


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda d=d: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=d: 9 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


TRICKY = [
    "a@b.c@d.e",
    "x a@b.cc%d@e.f g",
    "1.2.3.4.5.6.7.8",
    "256.1.1.1 001.2.3.4 1.2.3..4.5.6.7 0000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111 4111  1111",
    "+1 (017) 555-7713+49 30 1234567 +12 ++1234567890",
    "😀é a.b@c.d 😀 +1-234-567-8901 é",
    "@a.b user@host a@b.",
    "a" * 5000 + "@" + "b." * 2000 + "c",
    "1" * 30_000,
    "1 " * 3000,
    "a@b.c " * 300,
    "\n+1\n234 567 8901 +1 234 567 8901\n",
]


def check_base(spark, texts):
    docs = documents(spark, texts)
    got = collections.Counter(
        (r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in sanitise.sanitise_digest(docs).collect()
    )
    want = collections.Counter()
    for i, t, *_ in texts:
        spans = base_spans(t)
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        n = [sum(s[3] == k for s in spans) for k in PLAIN]
        want[(i, *n, hashlib.sha256(written.encode()).hexdigest())] += 1
    assert got == want


def test_base_spans(spark):
    check_base(spark, TEXTS + [(600 + i, t, "en", "a") for i, t in enumerate(TRICKY)])


def test_base_spans_of_the_given_documents(spark):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in given(spark, sf=SF.replace("0.001", "0.01")).collect()]
    check_base(spark, docs)


def test_terms_that_give_an_address_away(spark):
    fill = "alpha beta gamma delta epsilon zeta theta iota kappa lambda".split()
    told = [(i, f"{fill[i % 10]} the Quimby wrote from q@x.org on {fill[(i * 3 + 1) % 10]} the day", "en", "a") for i in range(10)]
    copied = [(50 + i, "the Zorblatt sent z@x.org to the desk", "en", "a") for i in range(10)]
    clean = [(100 + i, f"the {fill[i % 10]} wrote from on sent to day desk {fill[i * 7 % 10]}", "en", "a") for i in range(400)]
    docs = documents(spark, told + copied + clean + [(900, "a Quimby without address", "en", "a")])
    out = {r["doc_id"]: r["spans"] for r in sanitise.sanitise_digest(docs).collect()}
    for i, text, *_ in told:
        at = text.index("Quimby")
        assert f"term:{at}:{at + 6}" in out[i].split(",")
        assert out[i].count("term") == 1
    # A passage that names a person beside an address gives the person away in each copy;
    # rows without an entity stay as they are.
    assert all(out[50 + i] == "term:4:12,email:18:25" for i in range(10))
    assert all(out[i] == "" for i in [900, *range(100, 500)])
    hidden = {r["doc_id"]: r["text"] for r in sanitise.sanitised(docs).collect()}
    assert set(hidden) == {*range(10), *range(50, 60)}
    assert "Quimby" not in hidden[0] and "q@x.org" not in hidden[0] and "[EMAIL]" in hidden[0]


def test_terms_far_from_a_value_or_behind_a_number(spark):
    fill = "alpha beta gamma delta epsilon zeta theta iota kappa lambda".split()
    far = "and then the day went on and on from desk to desk until the day was done"
    rows = [(i, f"Quimby {fill[i % 10]} 42 {far} card 4111 1111 1111 1111 {fill[i * 3 % 10]} sent", "en", "a") for i in range(10)]
    rows += [(50 + i, f"Zorblatt, 42 {fill[i % 10]} card 5500 0000 0000 0004 {fill[i * 3 % 10]} sent", "en", "a") for i in range(10)]
    rows += [(100 + i, f"{fill[i % 10]} card sent {far} {fill[i * 7 % 10]}", "en", "a") for i in range(400)]
    out = {r["doc_id"]: r["spans"] for r in sanitise.sanitise_digest(documents(spark, rows)).collect()}
    for i in range(10):
        assert "term:0:6" in out[i].split(",") and out[i].count("term") == 1
        assert "term:0:8" in out[50 + i].split(",") and out[50 + i].count("term") == 1
    assert all(out[100 + i] == "" for i in range(400))


def test_names_that_stand_beside_an_address_once(spark):
    """Each document has its own person, handle and address, and common words."""
    rows = [(i, f"the xq{chr(97 + i % 26)}{chr(97 + i // 26)}n or r2d_{i} wrote from p{i}@x.org on the day", "en", "a") for i in range(40)]
    out = {r["doc_id"]: r["spans"] for r in sanitise.sanitise_digest(documents(spark, rows)).collect()}
    for i, text, *_ in rows:
        handle, address = f"r2d_{i}", f"p{i}@x.org"
        at = text.index(address)
        assert out[i] == f"term:4:9,term:13:{13 + len(handle)},email:{at}:{at + len(address)}"
    assert "xqaan" not in sanitise.sanitised(documents(spark, rows)).filter("doc_id = 0").first()["text"]


def brute_terms(docs):
    """Terms by entity with their ratios, from dictionaries."""
    word = regex.compile(r"(?<![\p{L}\p{M}\p{N}_])[\p{L}_][\p{L}\p{M}\p{N}_]+")
    of_entity, of_term = collections.defaultdict(set), collections.defaultdict(set)
    for row, (_, text, *_) in enumerate(docs):
        text = text or ""
        for start, _, end, kind in base_spans(text):
            value = text[start:end]
            same = value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value)
            of_entity[f"{kind}:{same}"].add(row)
        for term in word.findall(re.sub(PLAIN["email"], " ", text).lower()):
            of_term[term].add(row)
    n, out = len(docs), {}
    for entity, rows in of_entity.items():
        p = len(rows) / n
        near = {t for t, places in of_term.items() if places & rows}
        for term in near if p < 1 else ():
            given = (len(of_term[term] & rows) + 0.5 * p) / (len(of_term[term]) + 0.5)
            ratio = math.log(given / p) / math.log(1 / p)
            if ratio >= sanitise.GENERALISE:
                out[entity, term] = ratio
    return out


@pytest.mark.parametrize("which", ["made", "given"])
def test_disclosed_shares_by_brute_force(spark, which):
    fill = "alpha beta gamma delta of epsilon zeta theta iota no kappa lambda".split()
    docs = [(i, f"{fill[i % 12]} Al{i % 50} q{i % 9}@x.org {fill[i * 5 % 7]} 10.0.0.{i % 30} b{i}", "en", "a") for i in range(300)]
    docs += [(i, f"{fill[i % 11]} {fill[i % 5]} Al{i % 70}", "en", "a") for i in range(500)] + docs[:20] + [(None, None, None, None)]
    # One page with very many addresses, some of them known elsewhere.
    docs += [(7, " ".join(f"n{k} q{k}@x.org" for k in range(300)), "en", "a")]
    if which == "given":
        docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in given(spark).collect()]
    frame = documents(spark, docs)
    found = sanitise.stored(sanitise.scan(frame), "test-scan")
    got = {(r["entity"], r["term"]): r["ratio"] for r in sanitise.disclosing_terms(frame, found).collect()}
    want = brute_terms(docs)
    assert len(want) > 10 and set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_a_table_of_numbers_takes_time_in_proportion(spark):
    """A document of 100,000 numbers, each of which the card pattern matches."""
    numbers = " ".join(str(100 + k % 900) for k in range(100_000))
    text = f"{numbers}, to a@b.org from 10.0.0.1 {numbers}"
    docs = documents(spark, [(1, text, "en", "a")])
    (row,) = sanitise.scan(docs.select("doc_id", "text")).select("base").collect()
    at, ip = text.index("a@b.org"), text.index("10.0.0.1")
    got = [(s["kind"], s["start"], s["end"]) for s in row["base"]]
    assert got == [("email", at, at + 7), ("ip", ip, ip + 8)]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4095, 4096, 4097, 9000])
def test_places_of_many_matches(spark, n):
    text = "".join(f"{'é' * (k % 3)}x{k}@b.c " for k in range(n))
    docs = documents(spark, [(1, text, "en", "a")])
    (row,) = sanitise.scan(docs.select("doc_id", "text")).select("base").collect()
    assert all(text[s["start"] : s["end"]] == f"x{k}@b.c" for k, s in enumerate(row["base"])) and len(row["base"]) == n


def test_nothing_to_sanitise(spark):
    assert sanitise.sanitise_digest(documents(spark, [])).count() == 0
