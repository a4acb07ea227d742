import hashlib
import json

import pytest
from hypothesis import given as each
from hypothesis import settings
from hypothesis import strategies as st

from siftworks.llm import chat_format as c
from tests.llm.rows import given

ROWS = "conv_id long, turn long, role string, text string, record string, sample int, head string"


def brute(rows):
    """Digests from the rows themselves: no template involved."""
    by_id = {}
    for i, turn, role, text in rows:
        by_id.setdefault(i, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for i, turns in by_id.items():
        turns = [t[2:] for t in sorted(turns)]
        learnt = "".join(text for role, text in turns if role == "assistant")
        out[i] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(learnt),
            hashlib.sha256(learnt.encode()).hexdigest(),
        )
    return out


def digest(df):
    columns = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    return {r["conv_id"]: tuple(r[x] for x in columns) for r in df.collect()}


PROBE = [(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]


def test_given_conversations(spark):
    table = given(spark, "conversations")
    rows = [tuple(r[x] for x in ("conv_id", "turn", "role", "text")) for r in table.collect()]
    assert digest(c.chat_digest(table)) == brute(rows + PROBE)


AWKWARD = [
    (1, 0, "user", None),
    (1, 1, None, "text of nobody"),
    (1, 2, "assistant", "<|start|>user\nno turn<|end|>\n"),
    (1, 2, "assistant", "<|start|>user\nno turn<|end|>\n"),
    (1, None, "system", "no number"),
    (2, 5, "two\nlines \\n <|", "[~INST] <~~| <s></s> [/INST]<|"),
    (2, 3, "assistant", ""),
    (2, 4, "assistant", "<" * 50_000 + "|" * 50_000),
    (None, 0, "user", "of no conversation"),
    (None, 0, "assistant", "😀é\r\n"),
    (3, 2**62, "assistant", "last"),
    (3, -(2**62), "human", "first"),
    (-1, 7, "user", "has the id of the probe"),
]


def test_awkward_conversations(spark):
    table = spark.createDataFrame([(*r, "{}", 9, "h") for r in AWKWARD], ROWS).repartition(3)
    got = c.chat_digest(table)
    assert digest(got) == brute(AWKWARD + PROBE)
    assert digest(c.chat_digest(table.limit(0))) == brute(PROBE)


def test_samples_hold_whole_turns_and_show_their_loss(spark):
    rows = [(7, k, ("user", "assistant")[k % 2], f"{k} </s> " * k) for k in range(40)] + [(8, 0, "assistant", "x" * 900)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    samples = c.formatted(turns, sample_chars=400).collect()
    assert len(samples) > 10 and max(len(r["text"]) for r in samples if r["conv_id"] == 7 and r["sample"] < 5) <= 400
    for i in (7, 8):
        mine = sorted((r["sample"], r["text"], r["loss"]) for r in samples if r["conv_id"] == i)
        assert [m[0] for m in mine] == list(range(len(mine)))
        read = [t for m in mine for t in c.read_turns(m[1])]
        assert [(t[0], t[1]) for t in read] == [(r[2], r[3]) for r in rows if r[0] == i]
        for _, text, loss in mine:
            spans = [(a, b) for role, _, a, b in c.read_turns(text) if role == "assistant"]
            assert [(s["start"], s["end"]) for s in loss] == spans
    # From a stored table in any order as well.
    shuffled = c.formatted(turns, sample_chars=400).repartition(5, "sample")
    assert digest(c.read_back(shuffled)) == brute(rows)


def test_layouts(spark):
    said = [("user", "q"), ("assistant", "a")]
    records = {
        "messages": {"messages": [{"role": "human", "content": "q"}, {"role": "assistant", "content": "a"}], "id": "x"},
        "conversations": {"conversations": [{"from": "human", "value": "q"}, {"value": "a", "from": "gpt"}]},
        "turns": {"turns": [{"role": "user", "text": "q"}, {"role": "model", "text": "a"}], "metadata": {"deep": [1, {"b": 2}]}},
        "prompt": {"completion": "a", "prompt": "q"},
        "response": {"prompt": "q", "response": "a", "lang": None},
        "preference": {"prompt": "q", "chosen": "a", "rejected": "b"},
        "instruction": {"instruction": "q", "output": "a", "input": ""},
        "question": {"question": "q", "answer": "a"},
        "pairs": {"history": [{"user": "q", "assistant": "a"}]},
    }
    rows = [(k, json.dumps(r)) for k, r in enumerate(records.values())]
    out = c.canonical_turns(spark.createDataFrame(rows, "conv_id long, record string")).collect()
    for k, name in enumerate(records):
        mine = sorted((r["turn"], r["role"], r["text"], r["layout"]) for r in out if r["conv_id"] == k)
        assert [(m[1], m[2]) for m in mine] == said, name
        assert {m[3] for m in mine} == {name}


def test_texts_of_an_instruction_are_joined_and_a_system_text_leads(spark):
    record = {"instruction": "do", "input": "this", "output": 1.5, "system": "be kind"}
    rows = spark.createDataFrame([(1, json.dumps(record))], "conv_id long, record string")
    got = [(r["turn"], r["role"], r["text"]) for r in c.canonical_turns(rows).orderBy("turn").collect()]
    assert got == [(0, "system", "be kind"), (1, "user", "do\n\nthis"), (2, "assistant", '1.5')]


def test_records_that_nobody_declared_are_kept_and_reported(spark):
    odd = ['{"foo": {"bar": [1, {"baz": 2}]}}', '{"foo": {"bar": [{"baz": 3}, 2]}}', "no json", "[1]", None, "", '{"messages": []}']
    records = spark.createDataFrame([(k, r) for k, r in enumerate(odd)], "conv_id long, record string")
    out = {r["conv_id"]: r for r in c.canonical_turns(records).collect()}
    assert set(out) == set(range(6))  # messages without entries: known, no turns
    assert [out[k]["record"] for k in range(6)] == odd[:6]
    assert out[0]["fingerprint"] == out[1]["fingerprint"] is not None
    assert all(out[k]["layout"] is None for k in out)
    seen = {r["fingerprint"]: (r["rows"], r["example"]) for r in c.fingerprints(records).collect()}
    assert seen[out[0]["fingerprint"]] == (2, min(odd[:2]))
    assert seen[None][0] == 4


def test_a_layout_of_ones_own(spark):
    mine = c.Layout("mine", (("@log[].who", "log[].words.plain"),))
    record = json.dumps({"log": [{"who": "bot", "words": {"plain": "hi"}}]})
    rows = spark.createDataFrame([(1, record)], "conv_id long, record string")
    (row,) = c.canonical_turns(rows, (*c.LAYOUTS, mine)).collect()
    assert (row["role"], row["text"], row["layout"]) == ("assistant", "hi", "mine")


@settings(max_examples=300, deadline=None)
@each(st.text(alphabet="<[~|/sINT]>aé\n\\", max_size=60))
def test_escapes_are_reversible_and_leave_no_marks(text):
    import re

    escaped = re.sub(c.TO_ESCAPE, r"\1~\2\3", text)
    assert c.unescaped(escaped) == text
    for mark in ("<|", "<s>", "</s>", "[INST]", "[/INST]"):
        assert mark not in escaped


def test_samples_that_are_none():
    with pytest.raises(ValueError):
        c.read_turns("hello")
