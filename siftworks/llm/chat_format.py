"""Chat formatting: records of many layouts become turns, and turns become marked text.

A record is JSON: a prompt with its answer, an instruction with or without input, a list
of messages, pairs of texts, a preference pair, one message a row.  The set of its nested
field paths is hashed to a fingerprint, which selects one of the declared ``Layout``s; a
layout says which paths hold roles and texts.  Layouts with optional fields are entered
once for every choice of them.  Records whose fingerprint nobody declared are kept whole
with the layout null, and ``fingerprints`` reports them with their paths, ready to be
declared.

The template marks a turn as ``<|start|>role\\ntext<|end|>\\n``.  Control strings inside
texts (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) get a ``~`` behind their first
character, and ones that already have some get one more, so no text can open or close a
turn and every text can be read back exactly.  Line breaks and backslashes of roles are
escaped too.  The loss mask is a list of (start, end) in code points of the formatted
text: the escaped texts of assistant turns.

A conversation is not gathered: its turns stream through a task in order, and a formatted
sample ends at the first turn that would make it longer than ``SAMPLE_CHARS``; one longer
turn is a sample of its own.  Only the digest over all turns of a conversation has to see
them in one place, as a hash is sequential, and it holds one sample at a time.

Defined cases: a null text or role is empty; turns are ordered by their number, a missing
one first, then by role and text, so repeated rows count each time and in a defined
order; rows without conversation id are one conversation; a record that is no JSON
object has no layout; a field that is null counts as present; numbers in places of
texts are written as JSON, and an object there makes another layout; an empty table gives no rows; extra columns of a
table play no part, and clash with nothing.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_CHARS = 1 << 20
START, END = "<|start|>", "<|end|>\n"
ASSISTANT = "assistant"

# Control strings of common chat templates, as a pattern with room for escapes.
_CONTROL = r"([<\[])({})(\||/?s>|/?INST\])"
TO_ESCAPE = _CONTROL.format("~*")
ESCAPED = _CONTROL.format("~+")

# What other layouts call the same roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    ``turns`` lists (role, path); a role that starts with ``@`` is itself a path.  Paths
    through a list end in ``[]``, and all that begin with the same list advance together.
    Texts of neighbouring entries with one role are joined by an empty line, empty ones
    are left out where ``join`` is set.  ``number`` is the path of a turn's number.
    """

    name: str
    turns: tuple[tuple[str, str], ...]
    optional: frozenset[str] = field(default_factory=frozenset)
    number: str | None = None
    join: bool = False

    def needed(self) -> set[str]:
        found = {p for _, p in self.turns} | {r[1:] for r, _ in self.turns if r.startswith("@")}
        return (found | ({self.number} if self.number else set())) - self.optional


LAYOUTS = (
    Layout("messages", (("@messages[].role", "messages[].content"),)),
    Layout("conversations", (("@conversations[].from", "conversations[].value"),)),
    Layout("turns", (("@turns[].role", "turns[].text"),)),
    Layout("row", (("@role", "text"),), number="turn"),
    Layout("prompt", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), frozenset({"system"})),
    Layout("response", (("system", "system"), ("user", "prompt"), ("assistant", "response")), frozenset({"system"})),
    Layout("preference", (("user", "prompt"), ("assistant", "chosen")), frozenset({"rejected"})),
    Layout(
        "instruction",
        (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
        frozenset({"system", "input"}),
        join=True,
    ),
    Layout("question", (("user", "question"), ("user", "context"), ("assistant", "answer")), frozenset({"context"}), join=True),
    Layout("pairs", (("user", "history[].user"), ("assistant", "history[].assistant"))),
)
# Fields that say something about a record and never hold a turn.
ABOUT = frozenset({"id", "conv_id", "source", "lang", "category", "metadata", "rejected"})


def field_paths(record) -> frozenset[str]:
    """The paths of all fields; what lies below a list has ``[]`` in its path."""
    found: set[str] = set()

    def walk(value, path: str) -> None:
        if isinstance(value, dict):
            for key, below in value.items():
                if path or key not in ABOUT:
                    walk(below, f"{path}.{key}" if path else key)
            if value or not path:
                return
        elif isinstance(value, list):
            for below in value:
                walk(below, f"{path}[]")
            if value:
                return
            path += "[]"
        found.add(path)

    walk(record, "")
    return frozenset(found)


def fingerprint(paths: frozenset[str]) -> str:
    """Hash of the set of paths, whatever the order of the fields."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def declared(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[str, Layout]:
    """The layouts by fingerprint, one entry for each choice of optional fields."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        needed, optional = layout.needed(), sorted(layout.optional - ABOUT)
        for n in range(len(optional) + 1):
            for some in itertools.combinations(optional, n):
                found.setdefault(fingerprint(frozenset(needed | set(some))), layout)
        lists = {p.split("[]")[0] for p in needed if "[]" in p}
        for name in lists:  # a list without entries shows no paths below it
            found.setdefault(fingerprint(frozenset({p for p in needed if not p.startswith(f"{name}[]")} | {f"{name}[]"})), layout)
    return found


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _at(record, path: str):
    for key in path.split(".") if path else ():
        record = record.get(key) if isinstance(record, dict) else None
    return record


def turns_of(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of each turn of a record, by its layout."""
    entries = [record]
    first = layout.turns[0][1]
    inside = first.split("[].")[0] if "[]." in first else None
    if inside is not None:
        entries = _at(record, inside) or []
    out: list[tuple[str, str]] = []
    for entry in entries:
        for role, path in layout.turns:
            here = path.removeprefix(f"{inside}[].") if inside is not None else path
            if here in layout.optional and _at(entry, here) is None:
                continue
            if role.startswith("@"):
                at = role[1:].removeprefix(f"{inside}[].") if inside is not None else role[1:]
                role = _text(_at(entry, at))
                role = role if layout.name == "row" else ROLES.get(role, role)
            text = _text(_at(entry, here))
            if layout.join and out and out[-1][0] == role:
                out[-1] = (role, "\n\n".join(x for x in (out[-1][1], text) if x))
            else:
                out.append((role, text))
    return out


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text, fingerprint, layout, record) from (conv_id, record).

    ``record`` is JSON text.  It comes back only where no layout fits, with role and text
    null; a record of a known layout without turns gives no rows.
    """
    known = declared(layouts)
    schema = pa.schema(
        {
            "conv_id": pa.int64(),
            "turn": pa.int64(),
            "role": pa.string(),
            "text": pa.string(),
            "fingerprint": pa.string(),
            "layout": pa.string(),
            "record": pa.string(),
        }
    )

    def read(batches: Iterator[pa.RecordBatch]):
        names: dict[frozenset[str], str] = {}
        for batch in batches:
            rows: list[tuple] = []
            for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    record = json.loads(text or "")
                except ValueError:
                    record = None
                if not isinstance(record, dict):
                    rows.append((conv_id, None, None, None, None, None, text))
                    continue
                paths = field_paths(record)
                if paths not in names:
                    if len(names) > 10_000:  # as many layouts as records: no use in keeping them
                        names.clear()
                    names[paths] = fingerprint(paths)
                mark = names[paths]
                layout = known.get(mark)
                if layout is None:
                    rows.append((conv_id, None, None, None, mark, None, text))
                    continue
                base = _at(record, layout.number) if layout.number else 0
                for i, (role, said) in enumerate(turns_of(record, layout)):
                    number = base + i if isinstance(base, int) else None
                    rows.append((conv_id, number, role, said, mark, layout.name, None))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    out = "conv_id long, turn long, role string, text string, fingerprint string, layout string, record string"
    return records.select(F.col("conv_id").cast("long").alias("conv_id"), "record").mapInArrow(read, out)


def fingerprints(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(fingerprint, layout, rows, example): which layouts a table holds, and in how many
    turns, or records where the layout is not declared; such a one shows its smallest.
    """
    turns = canonical_turns(records, layouts)
    return turns.groupBy("fingerprint", "layout").agg(
        F.count(F.lit(1)).alias("rows"), F.min("record").alias("example")
    )


def rows_as_records(conversations: DataFrame) -> DataFrame:
    """A table with a message per row as records: all fields stay, nulls too."""
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return conversations.select("conv_id", F.to_json(message, {"ignoreNullFields": "false"}).alias("record"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, TO_ESCAPE, "$1~$2$3")


_ESCAPED = re.compile(ESCAPED)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def _header(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role(header: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(header))


def ordered_pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, head, body, masked): turns as escaped pieces of the formatted text.

    The rows of a conversation follow each other in one partition, in their order.
    Escaping happens before, where the rows are; rows move once.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    pieces = turns.select(
        "conv_id", "turn", role.alias("role"), _header(role).alias("head"), escaped(text).alias("body")
    )
    # Ties are broken by the escaped text, whose order is as good as that of the text.
    return (
        pieces.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "body")
        .select("conv_id", "head", "body", (F.col("role") == ASSISTANT).alias("masked"))
    )


def formatted(turns: DataFrame, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """(conv_id, sample, text, loss): conversations as marked text, cut between turns.

    Samples come out in the order of their conversation.
    """
    schema = "conv_id long, sample int, text string, loss array<struct<start:int,end:int>>"
    span = pa.struct({"start": pa.int32(), "end": pa.int32()})
    arrow = pa.schema({"conv_id": pa.int64(), "sample": pa.int32(), "text": pa.string(), "loss": pa.list_(span)})

    def write(batches: Iterator[pa.RecordBatch]):
        current, number, parts, size, loss, begun = None, 0, [], 0, [], False
        ready: list[tuple] = []
        held = 0

        def batch():
            columns = list(zip(*ready, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        def finish():
            nonlocal held
            ready.append((current, number, "".join(parts), [{"start": a, "end": b} for a, b in loss]))
            held += size

        for rows in batches:
            for conv_id, head, body, masked in zip(*(rows.column(i).to_pylist() for i in range(4)), strict=True):
                turn = f"{START}{head}\n"
                length = len(turn) + len(body) + len(END)
                if begun and (conv_id != current or size + length > sample_chars):
                    finish()
                    number = number + 1 if conv_id == current else 0
                    parts, size, loss = [], 0, []
                    if held > sample_chars:
                        yield batch()
                        ready, held = [], 0
                current, begun = conv_id, True
                if masked:
                    loss.append((size + len(turn), size + len(turn) + len(body)))
                parts += [turn, body, END]
                size += length
        if begun:
            finish()
            yield batch()

    return ordered_pieces(turns).mapInArrow(write, schema)


def read_turns(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a formatted sample, by its marks alone."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError("a sample does not begin with a turn")
        line = text.index("\n", at)
        end = text.index(END, line)
        out.append((_role(text[at + len(START) : line]), unescaped(text[line + 1 : end]), line + 1, end))
        at = end + len(END)
    return out


def read_back(samples: DataFrame, in_order: bool = False) -> DataFrame:
    """A digest per conversation, read from its formatted samples.

    ``in_order`` says that the samples of a conversation follow each other in one
    partition, as they do where ``formatted`` has just written them.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    arrow = pa.schema(
        {
            "conv_id": pa.int64(),
            "n_turns": pa.int64(),
            "turns_sha256": pa.string(),
            "loss_chars": pa.int64(),
            "loss_sha256": pa.string(),
            "formatted_chars": pa.int64(),
        }
    )

    def digest(batches: Iterator[pa.RecordBatch]):
        current, begun = None, False
        state: list = []
        done: list[tuple] = []

        def finish():
            n, turns, chars, loss, size = state
            done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        def batch():
            columns = list(zip(*done, strict=True)) if done else [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for rows in batches:
            names = rows.schema.get_field_index
            ids, texts, masks = (rows.column(names(c)).to_pylist() for c in ("conv_id", "text", "loss"))
            for conv_id, text, mask in zip(ids, texts, masks, strict=True):
                if not begun or conv_id != current:
                    if begun:
                        finish()
                    current, begun = conv_id, True
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in mask:
                    learnt = unescaped(text[span["start"] : span["end"]])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(text)
            yield batch()
            done = []
        if begun:
            finish()
            yield batch()

    if not in_order:
        samples = samples.repartition("conv_id").sortWithinPartitions("conv_id", "sample")
    return samples.mapInArrow(digest, schema)


def probe(conversations: DataFrame) -> DataFrame:
    """A conversation of id -1 in another layout, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    record = json.dumps({"messages": [{"role": r, "content": said} for r in ("user", ASSISTANT)]})
    return conversations.sparkSession.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(record).alias("record"))


def chat_digest(conversations: DataFrame) -> DataFrame:
    records = rows_as_records(conversations).unionByName(probe(conversations))
    turns = canonical_turns(records).filter(F.col("layout").isNotNull())
    return read_back(formatted(turns), in_order=True)
