import base64
import gzip
import hashlib
import json
import pathlib
import struct

import public_tokenizers
import pytest
import tiktoken

from siftworks.llm import byte_bpe, warc
from tests.llm.rows import TEXTS, documents, given, rows_of


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec()


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(encoding, i, text):
    ids = encoding.encode_ordinary(text or "")
    raw = b"".join(struct.pack("<I", x) for x in ids)
    return (i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_the_hash_is_minimal_and_perfect(codec):
    whole = codec.whole
    assert sorted(whole.entry.tolist()) == list(range(whole.n))


def test_unknown_spans_are_not_found(codec):
    import numpy as np

    data = b"zqxjkvzqxjkv the"
    buffer = np.frombuffer(data + b"\0" * 8, np.uint8)
    found, _ = codec.whole.find(buffer, np.array([0, 12]), np.array([12, 4]))
    assert found[0] == -1 and codec.token[codec.ids[found[1]]] == b" the"


def test_ids_of_the_given_documents(spark, reference_encoding):
    docs = given(spark)
    want = sorted((expected(reference_encoding, r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert rows_of(byte_bpe.bpe_digest(docs)) == want


def test_ids_of_awkward_documents(spark, reference_encoding):
    more = ["<|endoftext|> don't DON'T we'll", "\n\n  x   ", "é" * 3000, "1234567890" * 50, "a" * 2_000_000 + " b"]
    texts = TEXTS + [(500 + i, t, "en", "a") for i, t in enumerate(more)]
    # A run of two million letters is one pre-token, too long for the other library.
    want = [expected(reference_encoding, i, t) for i, t, *_ in texts if len(t or "") < 1_000_000]
    got = rows_of(byte_bpe.bpe_digest(documents(spark, texts)))
    long = [r for r in got if r[0] == 504]
    assert long[0][3] == hashlib.sha256(more[-1].encode()).hexdigest()
    assert [r for r in got if r[0] != 504] == sorted(want, key=repr)


def test_long_texts_are_cut_between_pre_tokens(codec, reference_encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 50)
    text = "some words, and é 日本 numbers 12345 in a text\n that is cut   many times " * 20
    ids = [x for part in byte_bpe.Encoder(codec).rows(["", text, "b"]) for a in part for x in a.tolist()]
    assert ids == reference_encoding.encode_ordinary(text) + reference_encoding.encode_ordinary("b")


def test_encoded_documents_keep_their_columns(spark):
    docs = documents(spark)
    out = byte_bpe.encoded_documents(docs)
    assert [c for c in docs.columns if c not in ("text", "n_tokens")] == [
        c for c in out.columns if c in docs.columns and c != "n_tokens"
    ]
    assert out.count() == len(TEXTS)
    assert byte_bpe.bpe_digest(documents(spark, [])).count() == 0


def expected_pages(pages):
    rows = [(i, (h or "").encode()) for i, h in pages]
    first = {}
    for i, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h, i)
    used, out = set(), []
    for i, h in rows:
        digest = base64.b32encode(hashlib.sha1(h).digest()).decode()
        response = i == first[h] and h not in used
        used |= {h} if response else set()
        out.append((i, len(h), digest, "response" if response else "revisit", None if response else first[h]))
    return sorted(out, key=repr)


def test_archives_of_the_given_pages(spark):
    pages = given(spark, "pages")
    want = expected_pages([(r["page_id"], r["html"]) for r in pages.collect()])
    assert rows_of(warc.warc_digest(pages)) == want


def test_archives_of_awkward_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 4)
    rows = [
        (5, "http://a/\r\nX: y", "same"),
        (3, None, "same"),
        (3, "u", "same"),
        (None, "u", "same"),
        (7, "u", None),
        (8, "u", ""),
        (9, "u", "x\r\n\r\ny\r\n\r\nWARC/1.1"),
        (10, "ü é", "é" * 500_000),
        (None, None, "only without id"),
        (11, "u", "é" * 500_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    pages = spark.createDataFrame(pages.collect(), pages.schema).withColumnRenamed("url", "url")
    got = rows_of(warc.archived(pages, str(tmp_path)))
    assert got == expected_pages([(i, h) for i, _, h in rows])
    # The files are what they claim to be: members that open one by one.
    archives = sorted(pathlib.Path(tmp_path, "records").glob("*.warc.gz"))
    assert len(archives) > 1
    for path in archives:
        raw = path.read_bytes()
        index = [json.loads(x) for x in path.with_name(path.name.replace(".warc.gz", ".index.jsonl")).read_text().splitlines()]
        assert sum(x["length"] for x in index) == len(raw)
        for x in index:
            member = gzip.decompress(raw[x["offset"] : x["offset"] + x["length"]])
            assert member.startswith(b"WARC/1.1\r\nWARC-Type: re")


def test_no_pages(spark):
    assert warc.warc_digest(given(spark, "pages").limit(0)).count() == 0


def test_small_payloads_may_all_be_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.archived(pages, str(tmp_path), min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_ids_of_64_bits(spark, tmp_path):
    # Revisits and responses side by side, with a missing id in the archive.
    big = 2**60
    rows = [(big + k, "u", "same" if k % 2 else f"own {k}") for k in range(1, 12)]
    rows += [(None, "u", "own"), (-(2**63), "u", "least"), (2**63 - 1, "u", "same"), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert rows_of(warc.archived(pages, str(tmp_path))) == expected_pages([(i, h) for i, _, h in rows])
