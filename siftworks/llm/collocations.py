"""Phrase collocations by Toivonen mining.

A sample of the texts proposes the phrases that are likely to be frequent.  One full
pass then counts both these and their negative border: all phrases that were not proposed,
but whose first and last words but one (the two phrases that are one word shorter) were.
All single words are counted, as nothing is shorter.  A border phrase that turns out to be
frequent is a failure of the sample: phrases that contain it may have been missed.  Further
full passes count the failures and what they open, until there is none.  Failures that are
rare in the texts take one pass more: it takes all that they open for proposed, at every
length.  Other failures take a pass for each length.  The result is exact whatever the sample
said; the sample only decides how many passes it takes.

Proposed phrases are counted by language and text.  Border phrases, which are many and
nearly all rare, are counted by a 64-bit hash: two that share one can only look too
frequent, and then the next pass counts both by their text.  What was proposed travels to the
tasks as a bit table of fixed size (``FILTER_BITS``); a bit set by chance makes a task count a
phrase by its text that need not have been, and nothing proposed is ever missed.  Each task
combines its counts before they are shuffled, in memory of a fixed bound.

Defined cases: null text has no words; a null language is ``und``, together with rows that
say so; an empty text, a text of marks only and an empty table give nothing; repeated rows
count each time; ties of score and count go by the bytes of the phrase; phrases do not
cross marks or line ends, whatever the length of the text; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftworks.llm.frames import arrow_rows, stored
from siftworks.llm.words import hash_spans, mix64, padded, pieces, utf8

LONGEST = 4
MIN_COUNT = 30
SCALE = 2_000_000
ABSORBED_PERCENT = 80
TOP = 2000
# The sample: one stretch of text of so many, and the count there that proposes a phrase.
# Stretches and not documents, as a phrase may occur in one document or in copies only.
SAMPLE = 4
STRETCH = 1024
PROPOSED = 3
FILTER_BITS = 1 << 26
_FILTER_PARTS = 16
# Rows and bytes of text that are worked on at once, and entries of one kind that a task
# holds before it combines them, and before it sends them on.
ROWS = 2048
PIECE = 1 << 20
HELD = 1 << 17
PHRASE_BYTES = 1 << 18
# Failures are rare in the texts if so many times their occurrences are not more than the words.
RARE = 16

# A border phrase has no language, the number of words of a language has no phrase.
COUNTED = "h long, lang string, phrase string, part long"
_COUNTED = pa.schema({"h": pa.int64(), "lang": pa.string(), "phrase": pa.string(), "part": pa.int64()})

_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _MARK.copy()
_GAP[list(b" \t")] = True


def _spans(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of each word, and whether the next word follows it within
    the same piece of text."""
    size = int(offsets[-1])
    solid = np.zeros(size + 2, bool)  # shifted by one: a gap on both sides
    solid[1 : size + 1] = ~_GAP[buffer[:size]]
    # Texts lie end to end, so a word may not run on into the next text.
    inner = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < size)]
    begins = solid[1 : size + 1] & ~solid[:size]
    begins[inner] = solid[inner + 1]
    ends = solid[1 : size + 1] & ~solid[2:]
    ends[inner - 1] = solid[inner]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    row = np.searchsorted(offsets, start, "right") - 1
    marks = np.cumsum(_MARK[buffer[:size]], dtype=np.int64) if size else np.zeros(0, np.int64)
    place = marks[start]
    next_ = np.zeros(len(start), bool)
    next_[:-1] = (place[1:] == place[:-1]) & (row[1:] == row[:-1])
    return start, length, row, next_


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word."""
    return mix64(h * np.uint64(0x9E3779B97F4A7C15) ^ word)


def _place(h: np.ndarray, n_bits: int) -> np.ndarray:
    """The place of a hash in the bit table, whose size is a power of two."""
    return (h & np.uint64(n_bits - 1)).astype(np.int64)


def _within(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _place(h, len(table) * 8)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _sampled(buffer: np.ndarray, sample: int, rng: np.random.Generator) -> None:
    """Leave one stretch of ``sample`` in the buffer and write marks over the others."""
    size = len(buffer) - 8
    for at in np.flatnonzero(rng.random(-(-size // STRETCH)) * sample >= 1).tolist():
        buffer[at * STRETCH : min((at + 1) * STRETCH, size)] = ord(".")


def _opened(word, lang, follows, table, before, tested, ahead=False) -> Iterator[tuple]:
    """Per size: starts and hashes of the phrases that are opened (both shorter phrases are in
    the table), whether they are in the table, and whether they were counted already.

    Without a table all phrases are opened and none is in it; sizes that the table does not
    tell about count as in it once they are opened.  ``before`` is the table of the pass before.
    With ``ahead`` all that it had not opened counts as in the table once it is opened.
    """
    size = len(word)
    run, inside, inside_before = np.ones(size, bool), None, None
    hashes = lang
    for m in range(1, LONGEST + 1):
        n = size - m + 1
        if n <= 0:
            return
        if m > 1:
            run = run[:n] & follows[m - 2 : m - 2 + n]
        opened = run.copy()
        opened_before = run.copy() if before is not None else np.zeros(n, bool)
        if m > 1 and table is not None:
            opened &= inside[:n] & inside[1 : n + 1]
        if m > 1 and before is not None:
            opened_before &= inside_before[:n] & inside_before[1 : n + 1]
        at = np.flatnonzero(opened)
        h = _longer(hashes[at], word[at + m - 1])
        hashes = np.zeros(n, np.uint64)
        hashes[at] = h
        asked = table is not None and m in tested
        here = _within(table, h) if asked else np.full(len(at), table is not None)
        inside = np.zeros(n, bool)
        inside[at] = here
        was_open = opened_before[at]
        if ahead:
            here = here | ~was_open
            inside[at] = here
        was_in = was_open.copy()
        if before is not None:
            was_in[was_open] = _within(before, h[was_open])
            inside_before = np.zeros(n, bool)
            inside_before[at] = was_in
        yield m, at, h, here, was_open, was_in


def _phrases(buffer, start, length, at, m: int) -> Iterator[pa.Array]:
    """The texts of the phrases of ``m`` words that begin at the given words, a space between
    words, whatever blanks are there; in arrays of about ``PHRASE_BYTES``."""
    words = at[:, None] + np.arange(m)
    sizes = length[words] + 1
    sizes[:, -1] -= 1
    offsets = np.concatenate(([0], np.cumsum(sizes.sum(axis=1))))
    for a, b in pieces(offsets, PHRASE_BYTES):
        if b == a + 1:  # may be a phrase of any length
            said = b" ".join([buffer[start[i] : start[i] + length[i]].tobytes() for i in words[a].tolist()])
            yield pa.array([said], pa.large_binary())
            continue
        size = sizes[a:b].ravel()
        ends = np.cumsum(size)
        data = buffer[np.repeat(start[words[a:b].ravel()] - (ends - size), size) + np.arange(ends[-1])]
        data[ends.reshape(-1, m)[:, :-1].ravel() - 1] = ord(" ")
        bounds = pa.py_buffer(offsets[a : b + 1] - offsets[a])
        yield pa.Array.from_buffers(pa.large_binary(), b - a, [None, bounds, pa.py_buffer(data)])


class _Combined:
    """Counts of rows that are equal in their first columns, added up whenever there are many;
    other columns come from one of the rows."""

    def __init__(self, keys: int):
        self.keys, self.parts, self.held = keys, [], 0

    def add(self, columns: Sequence[np.ndarray], counts: np.ndarray | None = None) -> None:
        if len(columns[0]):
            self.parts.append((columns, counts))
            self.held += len(columns[0])

    def combine(self) -> tuple[list[np.ndarray], np.ndarray] | None:
        if not self.parts:
            return None
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in self.parts), strict=True)]
        if len(columns) == 1 and all(p[1] is None for p in self.parts):  # sorted without an order
            ordered = np.sort(columns[0])
            at = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            out = ([ordered[at]], np.diff(np.append(at, len(ordered))))
        else:
            counts = np.concatenate([np.ones(len(p[0][0]), np.int64) if p[1] is None else p[1] for p in self.parts])
            order, at = _groups(columns[: self.keys])
            first = order[at]
            out = ([c[first] for c in columns], np.add.reduceat(counts[order], at))
        self.parts, self.held = [out], len(at)
        return out


def _groups(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by the first column, and where a group of rows that are equal in
    all columns begins in it."""
    order = np.argsort(columns[0])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        there = column[order]
        new[1:] |= there[1:] != there[:-1]
    return order, np.flatnonzero(new)


def _language_hashes(names: list[str], seed: int) -> np.ndarray:
    """A 64-bit hash of each language name."""
    data, offsets = utf8(pa.array(names, pa.string()))
    return hash_spans(padded(data, 0, len(data)), offsets[:-1], np.diff(offsets), seed)


def _counted(
    docs: DataFrame,
    sizes: Sequence[int],
    table: Broadcast | None = None,
    before: Broadcast | None = None,
    tested: Sequence[int] = range(1, LONGEST + 1),
    exact: bool = False,
    sample: int = 1,
    ahead: bool = False,
) -> DataFrame:
    """Counts of the opened phrases of some sizes, combined by task, in all of the texts or in
    one stretch of ``sample``.

    Phrases in the table are counted by their text if ``exact`` is set, and once: not if the
    pass before has done so.  All others are counted by their hash, unless they were opened
    in the pass before.  The first pass with ``exact`` counts the words of each language as well.
    """

    def count(batches: Iterator[pa.RecordBatch]):
        now, old = (None if b is None else b.value for b in (table, before))
        codes: dict[str, int] = {}
        totals: dict[int, int] = {}
        by_hash, by_text = _Combined(1), _Combined(3)
        texts: list[pa.Array] = []  # the last column of ``by_text`` has places in these
        rng = np.random.default_rng(TaskContext.get().partitionId())

        def combined(kind: _Combined):
            out = kind.combine()
            if out is not None and kind is by_text:
                texts[:] = [pa.concat_arrays(texts).take(pa.array(out[0][3]))]
                out[0][3] = np.arange(kind.held)
            return out

        def sent(kind: _Combined):
            out = combined(kind)
            kind.parts, kind.held = [], 0
            if out is None:
                return
            columns, counts = out
            if kind is by_text:
                lang = pa.array(list(codes), pa.string()).take(pa.array(columns[2]))
                phrase = texts.pop().cast(pa.large_string()).cast(pa.string())
                h = pa.array(np.zeros(len(counts), np.int64))
            else:
                lang = phrase = pa.nulls(len(counts), pa.string())
                h = pa.array(columns[0].view(np.int64))
            whole = pa.RecordBatch.from_arrays([h, lang, phrase, pa.array(counts)], schema=_COUNTED)
            for at in range(0, len(counts), 1 << 16):
                yield whole.slice(at, 1 << 16)

        def texts_of(at, m, h, code, buffer, start, length, second):
            again = code.astype(np.uint64)
            for i in range(m):
                again = _longer(again, second[at + i])
            columns = [h, again, code]
            order, begin = _groups(columns)
            first = order[begin]
            place = sum(map(len, texts)) + np.arange(len(first))
            texts.extend(_phrases(buffer, start, length, at[first], m))
            by_text.add([*(c[first] for c in columns), place], np.diff(np.append(begin, len(h))))

        for batch in batches:
            for at_row in range(0, batch.num_rows, ROWS):
                part = batch.slice(at_row, ROWS)
                names = ["und" if x is None else x for x in part.column(1).to_pylist()]
                for x in names:
                    codes.setdefault(x, len(codes))
                row_codes = np.array([codes[x] for x in names], np.int64)
                lang_hash = _language_hashes(names, 1)
                data, offsets = utf8(part.column(0))
                for a, b in pieces(offsets, PIECE):
                    base = int(offsets[a])
                    buffer = padded(data, base, int(offsets[b]), lower=True)
                    if sample > 1:
                        _sampled(buffer, sample, rng)
                    start, length, row, follows = _spans(buffer, offsets[a : b + 1] - base)
                    if not len(start):
                        continue
                    word = hash_spans(buffer, start, length, 2)
                    code = row_codes[a:b][row]
                    if exact and old is None:
                        for c, n in enumerate(np.bincount(code).tolist()):
                            totals[c] = totals.get(c, 0) + n
                    second = None
                    for m, at, h, here, was_open, was_in in _opened(word, lang_hash[a:b][row], follows, now, old, tested, ahead):
                        if m not in sizes:
                            continue
                        if exact:
                            told = here & ~was_in
                            if told.any():
                                if second is None:
                                    second = hash_spans(buffer, start, length, 3)
                                places = at[told]
                                texts_of(places, m, h[told], code[places], buffer, start, length, second)
                            h = h[~here & ~was_open]
                        by_hash.add([h])
                    for kind in (by_hash, by_text):
                        if kind.held > HELD:
                            combined(kind)
                            if kind.held > HELD // 2:
                                yield from sent(kind)
        for kind in (by_hash, by_text):
            yield from sent(kind)
        known = list(codes)
        rows = [(0, known[c], None, n) for c, n in totals.items() if n]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _COUNTED, strict=True)], schema=_COUNTED
            )

    # The tasks have combined their counts: rows go straight to the shuffle.
    parts = docs.select("text", "lang").mapInArrow(count, COUNTED).repartition("h", "phrase")
    return parts.groupBy("h", "lang", "phrase").agg(F.sum("part").alias("n"))


def _filter(hashes: DataFrame, n_bits: int) -> np.ndarray:
    """The bit table of a column of hashes, built in parts of equal size by as many tasks."""
    part_bits = n_bits // _FILTER_PARTS

    def places(batches):
        for batch in batches:
            at = np.unique(_place(batch.column(0).to_numpy().view(np.uint64), n_bits))
            yield pa.RecordBatch.from_arrays([pa.array(at // part_bits), pa.array(at % part_bits)], names=["part", "at"])

    def table(batches):
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            part, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for p in np.unique(part).tolist():
                bits.setdefault(p, np.zeros(part_bits, bool))[at[part == p]] = True
        for p, here in bits.items():
            packed = np.packbits(here, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([packed], pa.binary())], names=["part", "bits"])

    built = (
        hashes.select("h")
        .mapInArrow(places, "part long, at long")
        .repartition(_FILTER_PARTS, "part")
        .mapInArrow(table, "part long, bits binary")
    )
    whole = np.zeros(n_bits // 8, np.uint8)
    # At most n_bits / 8 bytes, whatever the number of phrases.
    for r in built.collect():
        begin = r["part"] * part_bits // 8
        whole[begin : begin + part_bits // 8] |= np.frombuffer(r["bits"], np.uint8)
    return whole


def proposals(docs: DataFrame, sample: int, proposed: int, n_bits: int) -> np.ndarray:
    """The bit table of what is frequent in the sample: words and pairs first, then longer
    phrases of which all pairs are."""
    likely = lambda parts, name: stored(parts.filter(F.col("n") >= proposed).select("h"), name)
    short = _filter(likely(_counted(docs, (1, 2), sample=sample), "phrases-short"), n_bits)
    table = docs.sparkSession.sparkContext.broadcast(short)
    longer = _counted(docs, range(3, LONGEST + 1), table, tested=(1, 2), sample=sample)
    whole = short | _filter(likely(longer, "phrases-longer"), n_bits)
    table.unpersist()
    return whole


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    sample: int = SAMPLE,
    proposed: int = PROPOSED,
    n_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame, int]:
    """(lang, phrase, n) of all phrases that occur often enough, (lang, total) words of each
    language, and how many full passes it took."""
    spark = docs.sparkSession
    with arrow_rows(spark, ROWS):
        return _closed_counts(docs, min_count, sample, proposed, n_bits)


def _closed_counts(docs: DataFrame, min_count: int, sample: int, proposed: int, n_bits: int):
    context = docs.sparkSession.sparkContext
    table, before = context.broadcast(proposals(docs, sample, proposed, n_bits)), None
    known, totals, passes, ahead = None, None, 0, False
    while True:
        counts = _counted(docs, range(1, LONGEST + 1), table, before, exact=True, ahead=ahead)
        counts = stored(counts.filter((F.col("n") >= min_count) | F.col("phrase").isNull() & F.col("lang").isNotNull()), "phrases-counted")
        passes += 1
        found = counts.filter(F.col("phrase").isNotNull()).select("lang", "phrase", "n")
        known = found if known is None else known.unionByName(found)
        if totals is None:
            totals = counts.filter(F.col("lang").isNotNull() & F.col("phrase").isNull()).select("lang", F.col("n").alias("total"))
        failures = counts.filter(F.col("lang").isNull())
        occurrences = failures.agg(F.sum("n")).first()[0]
        if not occurrences:
            return known, totals, passes
        # Each opens at most nine phrases, so a pass ahead never counts many by their text.
        ahead = occurrences * RARE <= totals.agg(F.sum("total")).first()[0]
        opened = _filter(failures, n_bits)
        before, table = table, context.broadcast(table.value | opened)


def scored(known: DataFrame, absorbed_percent: int = ABSORBED_PERCENT) -> DataFrame:
    """Frequent phrases with l, r and score, without those that longer ones absorb."""
    words = F.split("phrase", " ")
    sized = known.select("lang", "phrase", "n", words.alias("words"), F.size(words).alias("size"))
    several = sized.filter(F.col("size") >= 2)
    counts = known.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias("_n"))

    def joined(start: Column | int, length: Column) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    cuts = (
        several.select("lang", "phrase", "n", "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
        .select(
            "lang",
            "phrase",
            "n",
            "cut",
            F.explode(
                F.array(
                    F.struct(F.lit(True).alias("left"), joined(1, F.col("cut")).alias("part")),
                    F.struct(F.lit(False).alias("left"), joined(F.col("cut") + 1, F.col("size")).alias("part")),
                )
            ).alias("x"),
        )
        .join(counts, (F.col("lang") == F.col("_lang")) & (F.col("x.part") == F.col("_phrase")))
        .groupBy("lang", "phrase", "n", "cut")
        .agg(F.max(F.when(F.col("x.left"), F.col("_n"))).alias("l"), F.max(F.when(~F.col("x.left"), F.col("_n"))).alias("r"))
    )
    # Decimals hold the products; the quotient is at most SCALE / 2.
    value = F.expr(
        f"cast(cast({SCALE} as decimal(10,0)) * cast(n as decimal(19,0))"
        " div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)"
    )
    lowest = (
        cuts.withColumn("score", value)
        .groupBy("lang", "phrase", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    )
    shorter = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    within = (
        sized.filter(F.col("size") > 2)
        .select("lang", "n", "words", "size", shorter.alias("length"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
        .select(F.col("lang").alias("_lang"), "n", joined(F.col("start"), F.col("length")).alias("_phrase"))
        .groupBy("_lang", "_phrase")
        .agg(F.max("n").alias("longer"))
    )
    absorbed = F.expr(f"cast(longer as decimal(19,0)) * 100 >= cast(n as decimal(19,0)) * {absorbed_percent}")
    return (
        lowest.join(within, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
        .filter(~F.coalesce(absorbed, F.lit(False)))
        .select("lang", "phrase", F.col("n").alias("a"), F.col("low.l").alias("l"), F.col("low.r").alias("r"), F.col("low.score").alias("score"))
    )


def collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The best phrases of each language."""
    known, totals, _ = frequent_phrases(docs, **options)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored(stored(known, "phrases-known"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
    )


def collocation_digest(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("text", "lang"))


ORACLE = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS p FROM documents))
  WHERE len(words) > 0
), places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), phrases AS (
  SELECT lang, words[i:i + m - 1] AS p, count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(words) GROUP BY ALL
), totals AS (SELECT lang, sum(f) AS n FROM phrases WHERE len(p) = 1 GROUP BY lang
), frequent AS (SELECT * FROM phrases WHERE f >= 30
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, x.f AS l, y.f AS r,
    (CAST(2000000 AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM frequent WHERE len(p) > 1) c
  JOIN frequent x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN frequent y ON y.lang = c.lang AND y.p = c.p[k + 1:]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), longer AS (
  SELECT lang, p[s:s + m - 1] AS p, max(f) AS f FROM (
    SELECT lang, p, f, m, unnest(range(1, len(p) - m + 2)) AS s
    FROM frequent, (SELECT unnest([2, 3]) AS m) WHERE len(p) > m) GROUP BY ALL
), kept AS (
  SELECT c.lang, array_to_string(c.p, ' ') AS phrase, a, l, r, score
  FROM lowest c LEFT JOIN longer b ON b.lang = c.lang AND b.p = c.p
  WHERE b.f IS NULL OR NOT CAST(100 AS HUGEINT) * b.f >= CAST(80 AS HUGEINT) * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) JOIN totals USING (lang) WHERE rank <= 2000
"""
