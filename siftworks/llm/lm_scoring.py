"""Score texts with a hashed maximum-entropy language model.

A softmax over hashed n-gram and skip features gives a token's class from the tokens
before it, a second one the group within the class, a third one the leaf within the
group; all three look at the context.  A frequent token has a leaf of its own; rarer
tokens of a leaf share it by their corpus counts.

All training documents teach the model, in distributed rounds.  A hash of id and text
deals them into slices of about equal size, whatever the input's files are.  A round
takes its share of the slices; every slice takes gradient steps from the weights of the
round before, and rows of the weight tables are averaged by how often slices touched them.
Slices and rounds grow with the corpus, and each document is read in one round.

Outcomes are the training vocabulary and one more, any unknown token; probabilities add
up to one over them.  Classes are the most frequent tokens one by one, clusters of the
other tokens by the company that their endings keep, and the unknown token, for which
tokens seen once stand in while training.

Counts of all tokens live in a table.  The ``HEAD_WORDS`` most frequent go to every task,
so that is bounded; the tokens beyond them are counted by a join, and are in the last leaf
of their class.

Defined cases: null text counts as empty and has the one end token; a null id counts as
empty text for the split, so it is held out; repeated rows count each time; without
training tokens every score is that of the base, 0 known; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm import words
from siftworks.llm.frames import remainder_of_id, stored

HELD_OUT_OF = 10
HEAD_WORDS = 1 << 20
ENDINGS = 4096
ALONE = 40
CLUSTERS = 23
CLASSES = 1 + ALONE + CLUSTERS  # class 0 is the unknown token
GROUPS = 16  # of a class, and leaves of a group
LEAVES = GROUPS * GROUPS
ROWS = 1 << 15
INNER_ROWS = 64000  # with a row for each class or group still below 2^16
NAMED = 8192  # the most frequent tokens are features themselves, others their endings
BATCH = 8192
BLOCK = 1024  # rows whose logits stay in a core's cache
FAR = 60.0  # exponentials of numbers up to this size are summed as they are
LEAST = 1e-30  # powers below this or above its inverse are not used
RATE = 0.5
SLICE_TOKENS = 1 << 21
COMBINED = 1 << 20  # distinct tokens that a task keeps before it passes them on
DISCOUNT = 0.5
END = np.uint64(0x9E2C5BD14F1A7731)
_K = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.array([0, 0xFF0000, 0xFFFF00, 0xFFFFFF], np.uint32)  # of three bytes, those of a word so long


@dataclass
class Tokens:
    """Tokens of consecutive texts, an end after each; ``row`` says whose they are."""

    h: np.ndarray
    ending: np.ndarray
    row: np.ndarray
    rows: int


def _remainder(h: np.ndarray, n: int) -> np.ndarray:
    """h % n by a division, which numpy does several times as fast for one divisor."""
    return h - h // np.uint64(n) * np.uint64(n)


def tokens(buffer: np.ndarray, offsets: np.ndarray) -> Tokens:
    start, length, row = words.word_spans(buffer, offsets)
    rows = len(offsets) - 1
    n = len(start)
    at = np.arange(n) + row
    h = np.full(n + rows, END, np.uint64)
    h[at] = words.hash_spans(buffer, start, length)
    ending = np.zeros(n + rows, np.int64)
    fours = np.ndarray((len(buffer) - 3,), "<u4", buffer, strides=(1,))
    first = start + length - 3  # of the last three bytes
    tail = fours[np.maximum(first, 0)]
    tail[:2] <<= 8 * np.maximum(-first[:2], 0).astype(np.uint32)  # only the first two words can begin before the buffer
    tail = (tail & _LAST.take(np.minimum(length, 3))).astype(np.uint64)
    ending[at] = _remainder(words.mix64(tail + np.uint64(1)), ENDINGS - 1).astype(np.int64) + 1
    owner = np.repeat(np.arange(rows), np.bincount(row, minlength=rows) + 1)
    return Tokens(h, ending, owner, rows)


def _token_parts(column):
    data, offsets = words.utf8(column)
    for a, b in words.pieces(offsets):
        buffer = words.padded(data, offsets[a], offsets[b], lower=True)
        yield a, b, tokens(buffer, offsets[a : b + 1] - offsets[a])


def _count_rows(h: np.ndarray, ending: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ending), pa.array(c)], names=["h", "ending", "c"])


def vocabulary(texts: DataFrame) -> DataFrame:
    """(h, ending, c) of all tokens of a text column, stored."""

    def merged(parts):
        h, ending, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        code, kinds = pd.factorize(h)
        of_kind = np.empty(len(kinds), ending.dtype)
        of_kind[code] = ending
        return kinds, of_kind, np.bincount(code, c, len(kinds)).astype(np.int64)

    def count(batches):
        parts, held = [], 0
        for batch in batches:
            for _, _, t in _token_parts(batch.column(0)):
                parts.append(merged([(t.h, t.ending.astype(np.int32), np.ones(len(t.h), np.int64))]))
                held += len(parts[-1][0])
                if held > COMBINED:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > COMBINED // 2:
                        yield _count_rows(*parts[0])
                        parts, held = [], 0
        if parts:
            yield _count_rows(*merged(parts))

    counted = texts.select("text").mapInArrow(count, "h long, ending int, c long")
    return stored(
        counted.groupBy("h").agg(F.any_value("ending").alias("ending"), F.sum("c").alias("c")), "lm-vocabulary"
    )


@dataclass
class Model:
    """Counts of the head, classes of endings, and the weights."""

    n: int
    v: int
    index: words.SortedHashes | None
    count: np.ndarray  # of the head, by falling count
    class_of_ending: np.ndarray
    leaf: np.ndarray  # of the head's tokens within their class
    mass: np.ndarray  # of each class and leaf: discounted counts of its tokens
    once_in_tail: float  # share of tokens beyond the head that were seen once
    weights: list[np.ndarray]  # of classes, groups and leaves

    def find(self, t: Tokens) -> np.ndarray:
        return self.index.find(t.h) if self.index else np.full(len(t.h), -1, np.int64)

    def classes(self, t: Tokens, place: np.ndarray) -> np.ndarray:
        """The class of each token if it is known."""
        alone = (place >= 0) & (place < ALONE)
        return np.where(alone, 1 + place, self.class_of_ending[t.ending])

    def leaves(self, place: np.ndarray) -> np.ndarray:
        """The leaf of each token within its class."""
        if not len(self.leaf):
            return np.full(len(place), LEAVES - 1, np.int64)
        return np.where(place >= 0, self.leaf[np.maximum(place, 0)], LEAVES - 1).astype(np.int64)

    def features(self, t: Tokens, place: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Hashes of what the tokens before each token say about it."""
        name = np.where((place >= 0) & (place < NAMED), place, NAMED + t.ending).astype(np.uint64) + np.uint64(1)
        kind = classes.astype(np.uint64) + np.uint64(1)

        def before(values: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros(len(values), np.uint64)
            if len(values) > k:
                out[k:] = np.where(t.row[k:] == t.row[:-k], values[:-k], 0)
            return out

        p1, p2 = before(name, 1), before(name, 2)
        keys = (
            p1,  # the token before
            words.mix64(p1 * _K + p2) | np.uint64(1 << 62),  # the two before
            p2 | np.uint64(1 << 61),  # one skipped
            before(kind, 3) * np.uint64(CLASSES + 1) + before(kind, 4) | np.uint64(1 << 60),  # two skipped
        )
        return np.stack([words.mix64(k + _K) for k in keys]).T  # a feature's hashes lie together

    def powers(self) -> list[np.ndarray | None]:
        """Powers of the weights, for many calls of ``log_probabilities``."""
        return [_powers(w, *of) for w, of in zip(self.weights, ((ROWS, 4), (INNER_ROWS, 2), (INNER_ROWS, 2)), strict=True)]

    def log_probabilities(self, features, classes, leaves, powers=None) -> tuple[np.ndarray, np.ndarray]:
        """Of each token's class and leaf, and of the unknown token, natural logarithms."""
        of_token, of_unknown = np.empty(len(classes)), np.empty(len(classes))
        powers = powers or self.powers()
        for a in range(0, len(classes), BLOCK):
            rows, bias = _class_rows(features[a : a + BLOCK])
            y = classes[a : a + BLOCK]
            of_token[a : a + BLOCK], of_unknown[a : a + BLOCK] = _log_softmax(self.weights[0], powers[0], rows, bias, y, 0)
        inner = np.flatnonzero(classes > ALONE)
        part_of = _block(self.weights[1])
        for a in range(0, len(inner), part_of):
            on = inner[a : a + part_of]
            nodes = _inner_rows(features[on], classes[on], leaves[on])
            for w, power, (rows, y) in zip(self.weights[1:], powers[1:], nodes, strict=True):
                of_token[on] += _log_softmax(w, power, rows, None, y)[0]
        return of_token, of_unknown


def _class_rows(features: np.ndarray) -> tuple[np.ndarray, int]:
    """Rows of the first weight table, and the bias row of all tokens."""
    return features.astype(np.uint16) & np.uint16(ROWS - 1), ROWS


def _inner_rows(features: np.ndarray, classes: np.ndarray, leaves: np.ndarray):
    """Rows, bias rows and outcomes in the tables of groups and leaves.

    A class or group has its own bias.  Its features are the token before and the one
    before that.
    """
    group, leaf = np.divmod(leaves, GROUPS)
    for node, bias, y in (
        (classes, classes, group),
        (CLASSES + classes * GROUPS + group, classes * GROUPS + group, leaf),
    ):
        of_node = node.astype(np.uint64) * _K
        rows = np.empty((3, len(node)), np.uint16)
        for k, feature in enumerate((0, 2)):
            rows[k] = _remainder(words.mix64(features[:, feature] + of_node), INNER_ROWS)
        rows[2] = INNER_ROWS + bias
        yield rows.T, y


def _logits(rows: np.ndarray, weights: np.ndarray, bias: int | None = None, put=np.add) -> np.ndarray:
    at = rows.T.astype(np.intp)
    z = weights.take(at[0], axis=0)
    other = np.empty_like(z)
    for k in range(1, len(at)):
        put(z, weights.take(at[k], axis=0, out=other, mode="clip"), out=z)
    if bias is not None:
        put(z, weights[bias], out=z)
    return z


def _within_range(z: np.ndarray) -> np.ndarray:
    """Logits whose exponentials neither overflow nor all vanish: less the largest of their
    row, which is only looked for where some are far from zero."""
    if len(z) and not (z.max() < FAR and z.min() > -FAR):
        z -= z.max(axis=1, keepdims=True)
    return z


def _powers(weights: np.ndarray, features: int, together: int) -> np.ndarray | None:
    """Powers of all weights, unless a product of ``together`` rows of features could leave the
    limits of the type before the bias is put to it."""
    if np.abs(weights[:features]).max() * together > 80 or np.abs(weights[features:]).max() > FAR:
        return None
    return np.exp(weights)


def _log_softmax(weights, powers: np.ndarray | None, rows, bias: int | None, *outcomes: np.ndarray | int) -> list[np.ndarray]:
    """The logarithm of each outcome's probability.

    Powers of sums are products of the weights' powers; where these come near the limits of
    their type the sums are taken.
    """
    nth = np.arange(len(rows))
    ones = np.ones(weights.shape[1], weights.dtype)
    if powers is not None:
        with np.errstate(over="ignore", under="ignore"):
            z = _logits(rows, powers, bias, np.multiply)
            whole = z @ ones
        picked = [z[nth, y] for y in outcomes]
        if whole.max() < 1 / LEAST and all((x > LEAST).all() for x in (whole, *picked)):
            whole = np.log(whole)
            return [np.log(x) - whole for x in picked]
    z = _logits(rows, weights, bias)
    z -= z.max(axis=1, keepdims=True)
    whole = np.log(np.exp(z) @ ones)
    return [z[nth, y] - whole for y in outcomes]


def _sums_by_row(z: np.ndarray, rows: np.ndarray, most: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row that occurs, how often, and the sum of z over the tokens that have it."""
    flat = rows.T.ravel()
    order = np.argsort(flat, kind="stable")  # a radix sort, as rows have 16 bits
    ordered = flat[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    times = np.diff(np.append(starts, len(order)))
    seldom = (0xFFFF - times).astype(np.uint16) if len(order) <= 0xFFFF else -times  # short keys by a radix sort
    by_times = np.argsort(seldom, kind="stable")
    starts, times = starts[by_times], times[by_times]
    token = np.tile(np.arange(len(z)), rows.shape[1]).take(order)
    sums = np.empty((len(starts), z.shape[1]), z.dtype)
    above = np.searchsorted(-times, -np.arange(most + 1), "left")  # rows that occur more than 0, 1, ... times
    often, part_of = int(above[most]), _block(z)
    other = np.empty((max(part_of, int(times[0])), z.shape[1]), z.dtype)
    for k, (start, n) in enumerate(zip(starts[:often].tolist(), times[:often].tolist(), strict=True)):
        np.add.reduce(z.take(token[start : start + n], axis=0, out=other[:n], mode="clip"), axis=0, out=sums[k])
    for a in range(often, len(starts), part_of):
        part, begin = sums[a : a + part_of], starts[a : a + part_of]
        z.take(token.take(begin), axis=0, out=part, mode="clip")
        for nth in range(1, int(times[a])):
            to = min(int(above[nth]) - a, len(part))
            part[:to] += z.take(token.take(begin[:to] + nth), axis=0, out=other[:to], mode="clip")
    return ordered[starts], times, sums


def _block(table: np.ndarray) -> int:
    """Rows of a table that are worked on together, more of a narrow one."""
    return max(1, BLOCK * CLASSES // table.shape[1])


def _whole_rows(table: np.ndarray) -> np.ndarray:
    """Rows as single values, which numpy copies at once."""
    return table.view(np.dtype((np.void, table.shape[1] * table.itemsize)))[:, 0]


def _move(w: np.ndarray, spread: np.ndarray, touched: np.ndarray, at, times, step: np.ndarray) -> None:
    """Steps, which are written over, are smaller in rows that have moved much."""
    to, part_of = _whole_rows(w), _block(w)
    moved = spread.take(at)
    for a in range(0, len(at), part_of):
        on, part, far = at[a : a + part_of], step[a : a + part_of], moved[a : a + part_of]
        far += np.einsum("ij,ij->i", part, part) / part.shape[1]
        part *= (RATE / np.sqrt(far))[:, None]
        part += w.take(on, axis=0)
        to.put(on, _whole_rows(part))
    spread.put(at, moved)
    touched[at] += times


def _step(w, spread, touched, rows: np.ndarray, bias: int | None, *targets) -> None:
    """One gradient step towards (outcome, share) for each token; shares need not add up to one."""
    z = np.empty((len(rows), w.shape[1]), np.float32)
    total = -sum(share for _, share in targets)
    ones = np.ones(w.shape[1], np.float32)
    part_of = _block(w)
    for a in range(0, len(rows), part_of):
        part = _within_range(_logits(rows[a : a + part_of], w, bias))
        np.exp(part, out=part)
        np.multiply(part, (total[a : a + part_of] / (part @ ones))[:, None], out=z[a : a + part_of])
    flat, begin = z.reshape(-1), np.arange(0, z.size, z.shape[1])
    for outcome, share in targets:
        flat[begin + outcome] += share
    at, times, step = _sums_by_row(z, rows)
    _move(w, spread, touched, at.astype(np.intp), times, step)
    if bias is not None:
        _move(w, spread, touched, np.array([bias]), len(z), z.sum(axis=0, keepdims=True))


def company(texts: DataFrame, frequent) -> np.ndarray:
    """How often each ending stands within three tokens of each frequent token, given as the
    hashes of at most ``ALONE`` tokens."""

    def count(batches):
        index = words.SortedHashes(frequent)
        table = np.zeros(ENDINGS * ALONE, np.int64)
        for batch in batches:
            for _, _, t in _token_parts(batch.column(0)):
                place = index.find(t.h)
                at = np.flatnonzero(place >= 0)
                for k in (-3, -2, -1, 1, 2, 3):
                    far = at[(at + k >= 0) & (at + k < len(place))]
                    far = far[t.row[far] == t.row[far + k]]
                    table += np.bincount(t.ending[far + k] * ALONE + place[far], minlength=len(table))
        table = table.reshape(ENDINGS, ALONE)
        rows = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(list(table[rows]), pa.list_(pa.int64()))], names=["ending", "near"]
        )

    sums = (
        texts.select("text").mapInArrow(count, "ending int, near array<long>")
        .groupBy("ending")
        .agg(*[F.sum(F.get("near", F.lit(i))).alias(f"n{i}") for i in range(ALONE)])
    )
    out = np.zeros((ENDINGS, ALONE))
    found = sums.toPandas()  # at most ENDINGS rows
    out[found["ending"].to_numpy()] = found[[f"n{i}" for i in range(ALONE)]].to_numpy()
    return out


def clusters(near: np.ndarray, weight: np.ndarray, k: int, rounds: int = 25) -> np.ndarray:
    """k-means of the rows as directions of square roots; always the same result."""
    x = np.sqrt(near)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    centres = [x[weight.argmax()]]
    nearest = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        centres.append(x[(nearest * weight).argmax()])
        nearest = np.minimum(nearest, ((x - centres[-1]) ** 2).sum(axis=1))
    c = np.array(centres)
    for _ in range(rounds):
        of = (x @ c.T * 2 - (c**2).sum(axis=1)).argmax(axis=1)
        for j in range(k):
            mine = of == j
            if weight[mine].sum() > 0:
                c[j] = (x[mine] * weight[mine, None]).sum(axis=0) / weight[mine].sum()
    return of


def _head(vocab: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, endings and counts of at most HEAD_WORDS tokens, by falling count.

    The least count that lets so many in comes from a histogram of counts, so no task
    sorts the vocabulary.
    """
    octave = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    steps = vocab.groupBy(octave.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect()
    least, total = None, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["n"]
        if total > HEAD_WORDS:
            break
        least = r["c"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    found = vocab.filter(F.col("c") >= least).select("h", "ending", "c").toArrow()
    h, ending, c = (found.column(i).to_numpy() for i in range(3))
    order = np.lexsort((h, -c))
    return h[order].view(np.uint64), ending[order], c[order]


def _leaves(classes: np.ndarray, count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the head's tokens, given by falling count, and the mass of each leaf.

    Tokens of a class lie one behind the other on a line as long as its mass, and leaves
    are equal parts of it; what the head lacks of a class is in its last leaf.
    """
    own = count - DISCOUNT
    order = np.argsort(classes, kind="stable")
    ends = np.cumsum(own[order])
    first = np.searchsorted(classes[order], classes[order], "left")
    before = np.concatenate(([0.0], ends))[first]
    middle = np.empty(len(own))
    middle[order] = ends - before - own[order] / 2
    leaf = np.minimum(middle * LEAVES / np.maximum(total[classes], DISCOUNT), LEAVES - 1).astype(np.uint8)
    mass = np.bincount(classes * LEAVES + leaf, own, CLASSES * LEAVES).astype(float).reshape(CLASSES, LEAVES)
    mass[:, -1] += np.maximum(total - np.bincount(classes, own, CLASSES), 0.0)
    return leaf, mass


def _packed(table: np.ndarray) -> np.ndarray:
    """Rows of a weight table, several of a narrow one together, so that all tables are as wide."""
    per = CLASSES // table.shape[1]
    return np.pad(table, ((0, -len(table) % per), (0, 0))).reshape(-1, CLASSES)


def train_round(texts: DataFrame, shared) -> list[np.ndarray]:
    """Gradient steps over all tokens, each partition by itself; the averaged weights."""
    per_row = CLASSES // GROUPS

    def learn(batches):
        model = shared.value
        w = [x.copy() for x in model.weights]
        spread = [np.full(len(x), 1e-2, np.float32) for x in w]
        touched = [np.zeros(len(x), np.int64) for x in w]
        for batch in batches:
            for _, _, t in _token_parts(batch.column(0)):
                place = model.find(t)
                classes, leaves = model.classes(t, place), model.leaves(place)
                features = model.features(t, place, classes)
                once = np.where(place >= 0, model.count[np.maximum(place, 0)] == 1, 0.0) if len(model.count) else np.zeros(len(t.h))
                unknown = np.where(place >= 0, once, model.once_in_tail).astype(np.float32)
                unknown[t.h == END] = 0
                for a in range(0, len(t.h), BATCH):
                    f, y, u = features[a : a + BATCH], classes[a : a + BATCH], unknown[a : a + BATCH]
                    _step(w[0], spread[0], touched[0], *_class_rows(f), (y, 1 - u), (0, u))
                    on = np.flatnonzero((y > ALONE) & (u < 1))
                    if len(on):
                        inner = _inner_rows(f[on], y[on], leaves[a : a + BATCH][on])
                        for k, (rows, outcome) in enumerate(inner, 1):
                            _step(w[k], spread[k], touched[k], rows, None, (outcome, 1 - u[on]))
        for k, (table, times) in enumerate(zip(w, touched, strict=True)):
            sums = _packed(table * times[:, None].astype(np.float32))
            per = CLASSES // table.shape[1]
            times = np.pad(times, (0, -len(times) % per)).reshape(-1, per)
            times = np.pad(times, ((0, 0), (0, per_row - per)))
            rows = np.flatnonzero(times.any(axis=1))
            lists = (
                pa.FixedSizeListArray.from_arrays(pa.array(x[rows].ravel()), x.shape[1]) for x in (times, sums)
            )
            n, values = (x.cast(pa.list_(x.type.value_type)) for x in lists)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), k, np.int32)), pa.array(rows.astype(np.int32)), n, values],
                names=["k", "r", "n", "w"],
            )

    sums = (
        texts.mapInArrow(learn, "k int, r int, n array<long>, w array<float>")
        .repartition("k", "r")  # a task has each row once, so there is nothing to add up before
        .groupBy("k", "r")
        .agg(
            F.array(*[F.sum(F.get("n", F.lit(i))) for i in range(per_row)]).alias("n"),
            F.array(*[F.sum(F.get("w", F.lit(i))).cast("float") for i in range(CLASSES)]).alias("w"),
        )
    )
    packed = [_packed(old) for old in shared.value.weights]
    for batch in sums.toArrow().to_batches():  # at most as many rows as the packed tables have
        k, r = (batch.column(i).to_numpy() for i in range(2))
        n, w = (batch.column(i).flatten().to_numpy().reshape(len(k), -1) for i in (2, 3))
        for layer, table in enumerate(packed):
            on = k == layer
            times = n[on, : 1 if layer == 0 else per_row, None]
            mean = w[on].reshape(*times.shape[:2], CLASSES // times.shape[1]) / np.maximum(times, 1)
            was = table[r[on]].reshape(mean.shape)
            table[r[on]] = np.where(times > 0, mean, was).reshape(-1, CLASSES)
    return [
        table.reshape(-1, old.shape[1])[: len(old)] for table, old in zip(packed, shared.value.weights, strict=True)
    ]


def _log_shares(mass: np.ndarray) -> np.ndarray:
    """Logarithms of the shares in each row; what has no mass keeps next to nothing."""
    share = mass / np.maximum(mass.sum(axis=1, keepdims=True), 1e-9)
    return np.log(np.maximum(share, 1e-13))


def fit(texts: DataFrame, vocab: DataFrame) -> Model | None:
    """The model of the texts, given with a hash that deals them into slices, ``part``."""
    spark = texts.sparkSession
    n, v = (int(x or 0) for x in vocab.agg(F.sum("c"), F.count(F.lit(1))).first())
    if not n:
        return None
    h, ending, count = _head(vocab)
    index = words.SortedHashes(h) if len(h) else None
    by_ending = vocab.groupBy("ending").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("c") == 1).alias("once")
    ).toPandas()
    words_in, kinds_in = np.zeros(ENDINGS), np.zeros(ENDINGS)
    words_in[by_ending["ending"]], kinds_in[by_ending["ending"]] = by_ending["n"], by_ending["v"]
    alone = vocab.filter(F.col("h").isin([int(x) for x in h[:ALONE].view(np.int64)])).toPandas()
    np.subtract.at(words_in, alone["ending"].to_numpy(), alone["c"].to_numpy())
    np.subtract.at(kinds_in, alone["ending"].to_numpy(), 1)
    near = company(texts, h[:ALONE]) if index else np.zeros((ENDINGS, ALONE))
    of = 1 + ALONE + clusters(near, words_in, CLUSTERS)
    total = np.bincount(of, words_in - DISCOUNT * kinds_in, minlength=CLASSES)
    classes = np.where(np.arange(len(h)) < ALONE, 1 + np.arange(len(h)), of[ending])
    total[1 : 1 + min(ALONE, len(h))] = count[:ALONE] - DISCOUNT
    leaf, mass = _leaves(classes, count, total)
    in_tail = n - int(count.sum())
    once = int(by_ending["once"].sum()) - int((count == 1).sum())
    by_group = mass.reshape(CLASSES, GROUPS, GROUPS)
    weights = [
        np.zeros((ROWS + 1, CLASSES), np.float32),
        np.zeros((INNER_ROWS + CLASSES, GROUPS), np.float32),
        np.zeros((INNER_ROWS + CLASSES * GROUPS, GROUPS), np.float32),
    ]
    weights[1][INNER_ROWS:] = _log_shares(by_group.sum(axis=2))
    weights[2][INNER_ROWS:] = _log_shares(by_group.reshape(-1, GROUPS))
    prior = np.bincount(of, words_in, minlength=CLASSES)
    prior[1 : 1 + min(ALONE, len(count))] = count[:ALONE]
    prior[0] = by_ending["once"].sum()
    weights[0][ROWS] = np.log((prior + 0.5) / (prior.sum() + 0.5 * CLASSES))
    model = Model(n, v, index, count, of, leaf, mass, once / in_tail if in_tail else 0.0, weights)
    # A slice grows with the root of the corpus, from 10 MB of text to some hundreds at 100 TB.
    slices = max(1, round(n / max(SLICE_TOKENS, 32 * math.isqrt(n))))
    rounds = max(1, slices.bit_length() - 1)
    a_round = -(-slices // rounds)
    for nth in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        # The slice is the partition's number, so there are no more of them in more partitions.
        dealt_to = F.pmod("part", F.lit(rounds * a_round))
        mine = texts.filter(F.pmod(dealt_to, F.lit(rounds)) == nth)
        to = F.floor(dealt_to / rounds).cast("int")
        dealt = mine.repartitionById(a_round, to).sortWithinPartitions("part")
        model.weights = train_round(dealt.select("text"), shared)
        shared.destroy()
    return model


def score(docs: DataFrame) -> DataFrame:
    """Every document with its counts, its base score and the model's."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", (remainder_of_id("doc_id", HELD_OUT_OF) == 0).alias("held_out"))
    texts = rows.filter(~F.col("held_out")).select("text", F.xxhash64("doc_id", "text").alias("part"))
    vocab = vocabulary(texts)
    model = fit(texts, vocab)
    n, v = (model.n, model.v) if model else (0, 0)
    whole = np.log10(n + 0.1 * (v + 1))
    shared = spark.sparkContext.broadcast(model)
    # Sums per row, and its tokens beyond the head as (hash, scores if known or not).
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "tail array<struct<h:long,known:float,unknown:float>>"
    )

    def head_scores(batches):
        model = shared.value
        if model:
            powers = model.powers()
            c = model.count if len(model.count) else np.ones(1)
            log_mass = np.log10(np.maximum(model.mass, 1e-9)).ravel()
            log_own, log_base = np.log10(np.maximum(c - DISCOUNT, 1e-9)), np.log10(c + 0.1) - whole
        for batch in batches:
            for a, b, t in _token_parts(batch.column(1)):
                place = model.find(t) if model else np.full(len(t.h), -1, np.int64)
                known = place >= 0
                if model:
                    classes, leaves = model.classes(t, place), model.leaves(place)
                    features = model.features(t, place, classes)
                    of_leaf, of_unknown = (
                        x / np.log(10) for x in model.log_probabilities(features, classes, leaves, powers)
                    )
                    # What the leaf gives to a token seen c times is c - DISCOUNT of its mass.
                    given = of_leaf - np.where(classes > ALONE, log_mass.take(classes * LEAVES + leaves), 0.0)
                    at = np.maximum(place, 0)
                    inside = np.where(classes > ALONE, log_own.take(at), 0.0)
                    base = log_base.take(at)
                else:
                    given = of_unknown = inside = base = np.full(len(t.h), np.log10(0.1) - whole)
                sums = lambda x, on: np.bincount(t.row[on], x[on], minlength=t.rows).astype(float)  # noqa: E731, B023
                if model:
                    out = np.flatnonzero(~known)
                    score = sums(given + inside, known)
                else:  # no model: all tokens are unknown
                    out = np.zeros(0, np.int64)
                    base_all = np.bincount(t.row, base, minlength=t.rows)
                    score = base_all
                ends = np.concatenate(([0], np.cumsum(np.bincount(t.row[out], minlength=t.rows)))).astype(np.int32)
                tail = pa.StructArray.from_arrays(
                    [
                        pa.array(t.h[out].view(np.int64)),
                        pa.array(given[out].astype(np.float32)),
                        pa.array(of_unknown[out].astype(np.float32)),
                    ],
                    names=["h", "known", "unknown"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).cast(pa.int64()),
                        batch.column(2).slice(a, b - a),
                        pa.array(np.bincount(t.row, minlength=t.rows)),
                        pa.array(np.bincount(t.row[known], minlength=t.rows)),
                        pa.array(sums(base, known) if model else base_all),
                        pa.array(score),
                        pa.ListArray.from_arrays(pa.array(ends), tail),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail"],
                )

    parts = rows.mapInArrow(head_scores, schema)
    return joined_scores(stored(parts, "lm-parts"), vocab, whole, n)


def joined_scores(parts: DataFrame, vocab: DataFrame, whole: float, n: int) -> DataFrame:
    """Add what the tokens beyond the head score, by a join with their counts."""
    # A row is known by its file and its place in it, the same on every read.
    numbered = parts.withColumns(
        {"file": F.xxhash64("_metadata.file_name"), "place": F.col("_metadata.row_index")}
    )
    tail = numbered.select("file", "place", F.explode("tail").alias("t")).select(
        "file", "place", F.col("t.h").alias("h"), F.col("t.known").alias("known"), F.col("t.unknown").alias("unknown")
    )
    seen = F.col("c").isNotNull()
    sums = (
        tail.join(vocab.select("h", "c"), "h", "left")
        .groupBy("file", "place")
        .agg(
            F.count("c").alias("k"),
            F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.1) - F.lit(float(whole))).alias("b"),
            F.sum(
                F.when(seen, F.col("known") + F.log10(F.col("c") - DISCOUNT)).otherwise(F.col("unknown")).cast("double")
            ).alias("s"),
        )
    )
    return (
        numbered.drop("tail")
        .join(sums, ["file", "place"], "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"),
        )
    )


def lm_digest(docs: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"))
