"""The stages by their own operators, checked against brute force."""

import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from siftworks.llm import byte_bpe, line_dedup, mixing, near_dedup, quality_rules
from tests.llm.rows import SF, WORD, documents, given
from tests.llm.test_line_dedup_and_mixing import kept_lines
from tests.llm.test_near_dedup_and_search import brute_classes


@pytest.fixture(scope="module")
def stages(spark):
    docs = given(spark)
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs)
    return out


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k[: k.index("_") + 1] for k in names if k.startswith("op")}
    assert names["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in entry.oracle_sql()


def test_stages_keep_the_columns(stages):
    for docs in stages[:-1]:
        assert docs.columns == stages[0].columns


def test_stages_do_what_their_operators_say(spark, stages):
    docs, good, lined, single, mixed, ids = stages
    kept = quality_rules.quality_digest(docs, given(spark, "labels")).filter("kept").select("doc_id")
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(r["doc_id"] for r in kept.collect())
    rows = good.collect()
    dropped = {r["doc_id"]: k[1] for r, k in zip(rows, kept_lines([r["text"] for r in rows]), strict=True)}
    before = {r["doc_id"]: r["text"] for r in rows}
    for r in lined.collect():
        assert len(before[r["doc_id"]].split("\n")) - dropped[r["doc_id"]] == len(r["text"].split("\n")) or not r["text"]
    classes = brute_classes([(r["doc_id"], r["text"]) for r in lined.collect()])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for _, c in classes})
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixing_digest(single).collect() if r["taken"]}
    words = collections.Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert words == taken
    codec = byte_bpe.codec()
    texts = collections.Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert collections.Counter((r["doc_id"], codec.decode(r["ids"]).decode()) for r in ids.collect()) == texts


def test_the_whole_pipeline(spark, stages):
    whole = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "ids_sha256"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, stages[-1].select(*key).collect()))


def test_awkward_documents_pass_all_stages(spark):
    docs = documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    for operator in (line_dedup.without_repeated_lines, near_dedup.one_of_each, mixing.mixed_documents):
        assert operator(documents(spark)).columns == columns
