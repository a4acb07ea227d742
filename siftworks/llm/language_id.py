"""Language identification by character models with interpolated Kneser-Ney smoothing.

Each language has an n-gram model over the characters of its words, a blank before and
behind.  Counts come from Spark; the probabilities of all languages stand in one table
per order, found through sorted hash arrays.  A text goes to the language with the
lowest cross-entropy per character over all its words.  The score is the calibrated
probability that this is right, and a text far from every language is rejected: that
shows in ``rejected`` and a low score, while the nearest language is still named.

The models are fitted on at most ``PER_LANGUAGE`` documents of each language, those of
the smallest hashes; every fifth of them calibrates and teaches nothing else.
Predictions read all words of all texts and nothing but the text.

Defined cases: null text and text without a letter are ``und`` with score 0; training
rows without text, language or letters are not used; a null id counts as empty text for
the split; with no training rows all is ``und``; ties go to the first language by
name; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftworks.llm import words
from siftworks.llm.frames import remainder_of_id, stored

FOLDS = 3
HELD_OUT = 1
PER_LANGUAGE = 2000
CALIBRATES = 5
ORDER = 4
DISCOUNT = 0.75
UNKNOWN = "und"
PIECE_CHARS = 4 << 20
EDGE = " "
# Longest part of a word that is scored at once; a longer run of letters is cut.
LONGEST = 64
_K = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The distinct words of some texts as code points, and where they occur."""

    chars: np.ndarray  # all distinct words, one after the other, no blanks
    start: np.ndarray
    length: np.ndarray
    which: np.ndarray  # distinct word of each occurrence
    row: np.ndarray  # text of each occurrence


def distinct_words(texts: list[str]) -> Words:
    """Runs of letters in lower case, runs of over LONGEST letters in parts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, kind = np.unique(points, return_inverse=True) if len(points) else (points, points.astype(np.int64))
    letter = np.array([chr(k).isalpha() for k in kinds.tolist()], bool)
    lower = np.array([ord(low) if len(low := chr(k).lower()) == 1 else k for k in kinds.tolist()], np.uint32)
    if not len(points):
        letter, lower = np.zeros(1, bool), np.zeros(1, np.uint32)
    is_letter, c = letter[kind], lower[kind]
    ends = np.cumsum(sizes)
    begins = is_letter.copy()
    begins[1:] &= ~is_letter[:-1]
    first = (ends - sizes)[sizes > 0]
    begins[first] = is_letter[first]
    closes = is_letter.copy()
    closes[:-1] &= ~is_letter[1:]
    last = ends[sizes > 0] - 1
    closes[last] = is_letter[last]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(closes) + 1 - start
    parts = -(-length // LONGEST)
    if (parts > 1).any():
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        length = np.minimum(np.repeat(length, parts) - nth * LONGEST, LONGEST)
        start = np.repeat(start, parts) + nth * LONGEST
    row = np.searchsorted(ends, start, "right")
    h = words.mix64(length.astype(np.uint64) * _K)
    for j in range(int(length.max()) if len(length) else 0):
        on = np.flatnonzero(length > j)
        h[on] = words.mix64(h[on] * _K ^ c[start[on] + j])
    _, at, which = np.unique(h, return_index=True, return_inverse=True)
    size = length[at]
    total = int(size.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    chars = c[np.repeat(start[at], size) + inside]
    return Words(chars, np.cumsum(size) - size, size, which, row)


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), np.uint64(len(columns)))
    for column in columns:
        h = words.mix64(h * _K ^ column)
    return h


class Models:
    """The probabilities of all languages, order by order."""

    def __init__(self, languages: list[str], counts: dict[str, dict[str, int]]):
        """``counts``: for each language its ORDER-grams, as often as they occur."""
        self.languages = languages
        n = len(languages)
        grams: list[dict[str, np.ndarray]] = [defaultdict(lambda: np.zeros(n)) for _ in range(ORDER)]
        for i, language in enumerate(languages):
            for gram, c in counts[language].items():
                grams[ORDER - 1][gram][i] += c
        # Below the highest order: how many different characters come before.
        for k in range(ORDER - 1, 0, -1):
            for gram, c in grams[k].items():
                grams[k - 1][gram[1:]] += c > 0
        size = len(grams[0]) + 1
        probability: dict[str, np.ndarray] = {}
        self.tables = []
        for k, level in enumerate(grams):
            total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
            kinds: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n))
            for gram, c in level.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += c > 0
            left = {
                h: np.where(t > 0, DISCOUNT * kinds[h] / np.maximum(t, 1), 1.0) for h, t in total.items()
            }
            now = {}
            for gram, c in level.items():
                h = gram[:-1]
                lower = probability[gram[1:]] if k else np.full(n, 1.0 / size)
                t = total[h]
                now[gram] = np.where(t > 0, np.maximum(c - DISCOUNT, 0) / np.maximum(t, 1), 0.0) + left[h] * lower
            probability = now
            self.tables.append((*self._table(now, n), *self._table(left, n)))
        # A character that no language has seen.
        none = self.tables[0][3]
        self.floor = (none[0] if len(none) else np.zeros(n)) - np.log2(size)

    @staticmethod
    def _table(values: dict[str, np.ndarray], n: int) -> tuple[words.SortedHashes, np.ndarray]:
        keys = list(values)
        if not keys:
            return words.SortedHashes(np.zeros(0, np.uint64)), np.zeros((0, n))
        length = len(keys[0])
        points = np.array([[ord(c) for c in k] for k in keys], np.uint64).reshape(len(keys), length)
        h = gram_hash(list(points.T)) if length else np.zeros(len(keys), np.uint64)
        return words.SortedHashes(h), np.log2(np.array([values[k] for k in keys]))

    def bits(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each distinct word in each language, and its characters."""
        n = len(w.length)
        size = w.length + 1  # the blank behind it counts
        total = int(size.sum())
        owner = np.repeat(np.arange(n), size)
        place = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        edge = np.uint64(ord(EDGE))

        def char(back: int) -> np.ndarray:
            at = place - back
            inner = (at >= 0) & (at < w.length[owner])
            out = np.full(total, edge)
            out[inner] = w.chars[(w.start[owner] + at)[inner]]
            return out

        around = [char(b) for b in range(ORDER)]
        value = np.empty((total, len(self.languages)))
        live, weight = np.arange(total), np.zeros((total, len(self.languages)))
        for k in range(ORDER - 1, -1, -1):
            if not len(live):
                break
            index, p, lower, left = self.tables[k]
            found = index.find(gram_hash([around[b][live] for b in range(k, -1, -1)]))
            hit = found >= 0
            value[live[hit]] = weight[live[hit]] + p[found[hit]]
            live = live[~hit]
            if k and len(live):
                # Not seen after this context: what the context leaves, one order lower.
                c = lower.find(gram_hash([around[b][live] for b in range(k, 0, -1)]))
                seen = c >= 0
                weight[live[seen]] += left[c[seen]]
        value[live] = weight[live] + self.floor
        return -np.add.reduceat(value, np.cumsum(size) - size, axis=0) if n else np.zeros((0, len(self.languages))), size

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text in each language, and its characters."""
        w = distinct_words(texts)
        bits, size = self.bits(w)
        chars = np.bincount(w.row, size[w.which], minlength=len(texts))
        sums = np.stack(
            [np.bincount(w.row, bits[w.which, i], minlength=len(texts)) for i in range(len(self.languages))], axis=1
        )
        return sums / np.maximum(chars, 1)[:, None], chars


@dataclass
class Calibration:
    """Logistic curve of the margin, and the limits beyond which texts are rejected."""

    offset: float = 0.0
    slope: float = 1.0
    limit: np.ndarray | None = None

    @staticmethod
    def margin(bits: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """How much worse the second language is, in bits over the whole text."""
        if bits.shape[1] < 2:
            return np.sqrt(chars)
        two = np.partition(bits, 1, axis=1)
        return (two[:, 1] - two[:, 0]) * np.sqrt(chars)

    def fit(self, bits: np.ndarray, chars: np.ndarray, truth: np.ndarray) -> None:
        best = bits.argmin(axis=1)
        right, x = (best == truth).astype(float), self.margin(bits, chars)
        a, b = 0.0, 0.1
        for _ in range(50):  # Newton steps with a weak pull towards 0 and 1
            p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
            g = np.array([(right - p).sum() - 0.1 * a, ((right - p) * x).sum() - 0.1 * (b - 1)])
            s = p * (1 - p)
            m = np.array([[s.sum() + 0.1, (s * x).sum()], [(s * x).sum(), (s * x * x).sum() + 0.1]])
            step = np.linalg.solve(m, g)
            a, b = a + np.clip(step[0], -1, 1), max(1e-3, b + np.clip(step[1], -1, 1))
        self.offset, self.slope = float(a), float(b)
        least = bits.min(axis=1)
        self.limit = np.array(
            [
                np.quantile(least[(best == i) & (truth == i)], 0.999) + 1.0 if ((best == i) & (truth == i)).any() else np.inf
                for i in range(bits.shape[1])
            ]
        )

    def judge(self, bits: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and rejection of each text."""
        z = np.clip(self.offset + self.slope * self.margin(bits, chars), -30, 30)
        score = 1 / (1 + np.exp(-z))
        best = bits.argmin(axis=1)
        far = bits[np.arange(len(bits)), best] > self.limit[best] if self.limit is not None else np.zeros(len(bits), bool)
        return np.where(far, score / 2, score), far | (score < 0.5)


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """(text, lang, calibrates) of at most so many training documents a language.

    The smallest hashes are found on narrow rows, each task keeping only its first
    ones; then the texts below each language's limit are read.
    """
    fold = remainder_of_id("doc_id", FOLDS)
    usable = (fold != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    h = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    rows = docs.filter(usable)
    by_hash = Window.partitionBy("lang").orderBy("h")
    limits = (
        rows.select("lang", h.alias("h"))
        .withColumn("nth", F.row_number().over(by_hash))
        .filter(F.col("nth") <= per_language)
        .groupBy(F.col("lang").alias("_lang"))
        .agg(F.max("h").alias("_limit"), F.max("nth").alias("_n"))
    )
    # A row per language: from a table, whose size Spark sees, so that texts beyond the
    # limit are dropped where they are read and do not travel.
    limits = stored(limits, "language-limits")
    near = rows.select("text", "lang", h.alias("h")).join(
        limits, (F.col("lang") == F.col("_lang")) & (F.col("h") <= F.col("_limit"))
    )
    # Ties at the limit may be many rows of one id: keep to the stated number.
    return (
        near.withColumn("nth", F.row_number().over(by_hash))
        .filter(F.col("nth") <= F.col("_n"))
        .select("text", "lang", (F.col("nth") % CALIBRATES == 0).alias("calibrates"))
    )


def _count_grams(texts: DataFrame) -> DataFrame:
    """(lang, gram, n): the ORDER-grams of the words with their blanks."""

    def count(batches):
        for batch in batches:
            by_language = defaultdict(list)
            for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_language[language].append(text)
            out: dict[tuple[str, str], int] = defaultdict(int)
            for language, some in by_language.items():
                w = distinct_words(some)
                often = np.bincount(w.which, minlength=len(w.length))
                for s, n, c in zip(w.start.tolist(), w.length.tolist(), often.tolist(), strict=True):
                    word = EDGE * (ORDER - 1) + "".join(map(chr, w.chars[s : s + n].tolist())) + EDGE
                    for i in range(n + 1):
                        out[language, word[i : i + ORDER]] += c
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in out]), pa.array([k[1] for k in out]), pa.array(list(out.values()), pa.int64())],
                    names=["lang", "gram", "n"],
                )

    counted = texts.mapInArrow(count, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[Models, Calibration] | None:
    rows = stored(sample(docs, per_language), "language-sample")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    # Bounded by the sample, and in practice by the letters of a language.
    for r in _count_grams(rows.filter(~F.col("calibrates")).select("text", "lang")).toLocalIterator():
        counts[r["lang"]][r["gram"]] = r["n"]
    languages = sorted(counts)
    if not languages:
        return None
    models, calibration = Models(languages, counts), Calibration()
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def measure(batches):
        for batch in batches:
            for texts, part in _texts(batch, 0):
                bits, chars = shared.value.entropies(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(list(bits), pa.list_(pa.float64())), pa.array(chars)], names=["lang", "bits", "chars"]
                )

    found = (
        rows.filter(F.col("calibrates") & F.col("lang").isin(languages))
        .select("text", "lang")
        .mapInArrow(measure, "lang string, bits array<double>, chars double")
        .filter(F.col("chars") > 0)
        .toPandas()
    )
    if len(found):
        calibration.fit(
            np.array(found["bits"].tolist()), found["chars"].to_numpy(), np.searchsorted(languages, found["lang"].tolist())
        )
    return models, calibration


def _texts(batch: pa.RecordBatch, column: int):
    _, offsets = words.utf8(batch.column(column))
    for a, b in words.pieces(offsets, PIECE_CHARS):
        part = batch.slice(a, b - a)
        yield [t or "" for t in part.column(column).to_pylist()], part


def predict(docs: DataFrame, fitted: tuple[Models, Calibration] | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document."""
    rows = docs.select("doc_id", "text", (remainder_of_id("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    schema = rows.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def name(batches):
        fitted = shared.value
        for batch in batches:
            for texts, part in _texts(batch, 1):
                if fitted is None:
                    named, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                else:
                    models, calibration = fitted
                    bits, chars = models.entropies(texts)
                    score, rejected = calibration.judge(bits, chars)
                    empty = chars == 0
                    score[empty], rejected[empty] = 0.0, True
                    named = [
                        UNKNOWN if e else models.languages[i]
                        for e, i in zip(empty.tolist(), bits.argmin(axis=1).tolist(), strict=True)
                    ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(named, pa.string()), pa.array(score), pa.array(rejected)],
                    names=schema.names,
                )

    return rows.mapInArrow(name, schema)


def language_digest(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text", "lang")
    return predict(docs, fit(docs))
