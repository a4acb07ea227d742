import collections

from pyspark.sql import functions as F

from siftworks.llm import quality_rules as q
from tests.llm.rows import SF, TEXTS, WORD, documents, given


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    counts = collections.Counter(windows)
    covered = set()
    for k, x in enumerate(windows):
        if counts[x] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def check(rows, texts):
    got = collections.Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in rows
    )
    want = collections.Counter()
    for i, t in texts:
        m = measures(t)
        want[(i, *m, m[0] < 20 or 100 * m[4] > 30 * m[0])] += 1
    assert got == want


def test_measures_of_the_given_documents(spark):
    docs = given(spark)
    out = q.quality_digest(docs, given(spark, "labels")).collect()
    check(out, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert not any(r["kept"] and r["base_failed"] for r in out)


def test_measures_of_awkward_documents(spark):
    labels = spark.createDataFrame([(4, 0, 0), (9, 1, 0), (None, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    w = "a b c d e f g h"
    texts = TEXTS + [(300 + i, t, "en", "a") for i, t in enumerate([f"{w} {w}", f"{w} x {w} y {w}", "a " * 40, "p\np\n p\np#*"])]
    out = q.quality_digest(documents(spark, texts), labels).collect()
    check(out, [(i, t) for i, t, *_ in texts])


def test_nothing_to_judge_or_to_learn_from(spark):
    labels = given(spark, "labels")
    assert q.quality_digest(documents(spark, []), labels).count() == 0
    docs = given(spark)
    out = q.quality_digest(docs, labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in out)


def test_a_planted_conjunction_is_learned(spark):
    rows = [(bool(i % 4 == 0 and i % 100 > 40), i % 3 == 0, float(i % 100), float(i % 4), float(i * 7919 % 101)) for i in range(4000)]
    labelled = spark.createDataFrame(rows, "bad boolean, aside boolean, x double, y double, noise double").cache()
    rules = q.learn_rules(labelled)
    assert rules
    names = {c: c for c in ("x", "y", "noise")}
    said = F.lit(False)
    for rule in rules:
        said = said | q._met(rule, lambda f: F.col(names[f]))
    wrong = labelled.filter(said != F.col("bad")).count()
    assert wrong <= 80


def test_held_out_labels(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = given(spark, sf=sf), given(spark, "labels", sf)
    fitted = q.fit(docs, labels.filter("doc_id % 2 = 0"))
    out, _, _, kept = q.judged(docs, fitted)
    seen = out.withColumn("kept", kept).join(labels.filter("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r["quality"]: r["kept"] for r in seen}
    assert share[1] > 0.93 and share[0] < 0.1


def test_documents_that_pass_are_unchanged(spark):
    docs = documents(spark)
    kept = q.keep_good(docs, given(spark, "labels"))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {9, 6, 8}


def test_each_measure_is_computed_once_a_row(spark):
    docs = given(spark)
    names = q.features(dict.fromkeys(q.MEASURES, "x"))
    rules = [tuple(q.Condition(f, at_least, 0.5 + k) for f in names) for k, at_least in enumerate([True, False, True])]
    out, passes = q.with_verdict(docs, rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    alone = q.with_measures(docs)[0]._jdf.queryExecution().executedPlan().toString()
    for name in ("regexp_extract_all", "xxhash64", "array_distinct"):
        assert 0 < plan.count(name) <= alone.count(name)
    # The filter that follows reads the stored verdict and no text.
    kept = q.keep_good(docs, given(spark, "labels"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan and f"PushedFilters: [IsNotNull({passes}), EqualTo({passes},true)]" in plan
