"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Shingles of five words, weighted by 1 + ln(occurrences), are elements of a Poisson
process each: arrivals come at exponential gaps divided by the weight and fall on random
components; a component keeps the element of its first arrival.  An element stops when
its next arrival is later than all that its document still waits for.  Components agree
with the probability Jaccard of two documents.  Links are pairs whose sets of shingles
have a Jaccard similarity of at least 0.8, counted exactly; repeats would keep some of
them apart, so documents with repeated shingles also have the bands of equal weights.
Documents that agree on a band of either kind are candidates.

Texts with the same words (blanks and A-Z case aside) are one node.  Within a bucket all
nodes are first compared with one hub, the node of most bucket mates.  In buckets that
then still hold several groups, the nodes outside the largest one are compared with all
others, pair by pair where they are few, else in blocks of bounded size from which only
links return.  No link between groups that share a bucket is lost, and a group of copies
of one text costs one comparison per copy.

Defined cases: null text counts as empty; texts without words are copies of each other;
texts of fewer than five words have one shingle, all their words; class_id is the
smallest doc_id of the class, null only if all are; rows with repeated or null ids are
rows of their own; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftworks.llm import words
from siftworks.llm.frames import fresh, stored

SHINGLE = 5
THRESHOLD = 0.8
# A pair of similarity 0.8 misses all bands of equal weights with probability
# (1 - 0.8^6)^40 = 5e-6.
BANDS = 40
ROWS = 6
# Buckets of up to FEW nodes are compared pair by pair, others in blocks.
FEW = 16
BLOCK_NODES = 256


def _numbered_words(buffer: np.ndarray, offsets: np.ndarray):
    """(row, hash, place in its row) of each word, and the words of each row."""
    start, length, row = words.word_spans(buffer, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    nth = np.arange(len(start)) - (np.cumsum(n) - n)[row]
    return row, words.hash_spans(buffer, start, length), nth, n


def fingerprints(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """16 bytes for the sequence of words of each row."""
    return _fingerprints(*_numbered_words(buffer, offsets))


def _fingerprints(row: np.ndarray, w: np.ndarray, nth: np.ndarray, n: np.ndarray) -> np.ndarray:
    first = np.cumsum(n) - n
    prints = np.zeros((len(n), 2), np.uint64)
    place = nth.astype(np.uint64)
    for k, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        placed = words.mix64(w + words.mix64(place * np.uint64(salt) + np.uint64(k + 1)))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(placed, dtype=np.uint64)))
        prints[:, k] = words.mix64(sums[first + n] - sums[first] + n.astype(np.uint64))
    return prints


def shingles(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, occurrences) of the distinct shingles, and the rows' fingerprints.

    Sorted by row, then hash.
    """
    row, w, nth, n = _numbered_words(buffer, offsets)
    prints = _fingerprints(row, w, nth, n)
    # A shingle begins at every word with four behind it, or at the first of a short text.
    begins = np.flatnonzero((n[row] - nth >= SHINGLE) | ((n[row] < SHINGLE) & (nth == 0)))
    h = np.zeros(len(begins), np.uint64)
    left = np.minimum(n[row[begins]] - nth[begins], SHINGLE)
    for j in range(SHINGLE):
        on = left > j
        h[on] = words.mix64(h[on] * np.uint64(0x9E3779B97F4A7C15) + w[begins[on] + j])
    of = row[begins]
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return of[at], h[at], np.diff(np.append(at, len(h))), prints


def prob_min_hash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """The winning element of each of ``m`` components for each row.

    Rows without elements get zeros.  ``row`` is sorted.
    """
    earliest = np.full(rows * m, np.inf)
    winner = np.zeros(rows * m, np.uint64)
    n = np.bincount(row, minlength=rows)
    at_once = np.maximum(1, np.minimum(64, m // np.maximum(n, 1)))
    times = np.zeros(len(row))
    nth = np.zeros(len(row), np.int64)
    live = np.arange(len(row))
    waits = np.full(rows, np.inf)
    while len(live):
        # A few arrivals of each live element: more where a row has few elements.
        reps = at_once[row[live]]
        e = np.repeat(live, reps)
        starts = np.cumsum(reps) - reps
        step = np.arange(len(e)) - np.repeat(starts, reps)
        r = words.mix64(element[e] + words.mix64((nth[e] + step + 1).astype(np.uint64)))
        gaps = -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[e]
        sums = np.cumsum(gaps)
        x = times[e] + sums - np.repeat(sums[starts] - gaps[starts], reps)
        cell = row[e] * m + (words.mix64(r ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(earliest, cell, x)
        won = x == earliest[cell]
        winner[cell[won]] = element[e[won]]
        times[live] = x[starts + reps - 1]
        nth[live] += reps
        touched = np.unique(row[live])
        waits[touched] = earliest.reshape(rows, m)[touched].max(axis=1)
        live = live[times[live] < waits[row[live]]]
    return winner.reshape(rows, m)


def band_hashes(signatures: np.ndarray, bands: int, per_band: int) -> np.ndarray:
    h = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(signatures), axis=0)
    cut = signatures.reshape(len(signatures), bands, per_band)
    for j in range(per_band):
        h = words.mix64(h * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, j])
    return h.view(np.int64)


def all_bands(row: np.ndarray, h: np.ndarray, tf: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Bands of equal weights, then those of weights by occurrences, and which of them
    count: a row has none without shingles, and none twice."""
    plain = band_hashes(prob_min_hash(row, h, np.ones(len(h)), rows, BANDS * ROWS), BANDS, ROWS)
    weighted = plain.copy()
    again = np.unique(row[tf > 1])
    on = np.isin(row, again)
    if len(again):
        signatures = prob_min_hash(
            np.searchsorted(again, row[on]), h[on], 1.0 + np.log(tf[on]), len(again), BANDS * ROWS
        )
        weighted[again] = band_hashes(signatures, BANDS, ROWS)
    has = np.bincount(row, minlength=rows) > 0
    keep = np.concatenate([np.repeat(has[:, None], BANDS, axis=1), weighted != plain], axis=1)
    return np.concatenate([plain, weighted], axis=1), keep


def _prints(prints: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(prints).tobytes()
    ends = np.arange(0, len(raw) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(prints), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def _parts(column):
    """Pieces of a text column: row range, padded bytes in lower case, offsets."""
    data, offsets = words.utf8(column)
    for a, b in words.pieces(offsets):
        yield a, b, words.padded(data, offsets[a], offsets[b], lower=True), offsets[a : b + 1] - offsets[a]


def with_node(docs: DataFrame, text: str, node: str) -> DataFrame:
    """Add the fingerprint of the text's words."""
    schema = docs.withColumn(node, F.lit(b"")).schema
    place = docs.columns.index(text)

    def add(batches):
        for batch in batches:
            for a, b, buffer, offsets in _parts(batch.column(place)):
                found = _prints(fingerprints(buffer, offsets))
                columns = [c.slice(a, b - a) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, found], names=schema.names)

    return docs.mapInArrow(add, schema)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, node, bands) of every document."""
    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id", F.lit(b"").alias("node"), F.array(F.lit(0).cast("long")).alias("bands")).schema

    def sketch(batches):
        for batch in batches:
            for a, b, buffer, offsets in _parts(batch.column(1)):
                row, h, tf, prints = shingles(buffer, offsets)
                hashes, keep = all_bands(row, h, tf, b - a)
                ends = np.concatenate(([0], np.cumsum(keep.sum(axis=1)))).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[keep]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), _prints(prints), bands], names=schema.names
                )

    return rows.mapInArrow(sketch, schema)


def jaccard_counts(left, right) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of intersection and union of the shingle sets, row by row."""
    rows, hashes = [], []
    for column in (left, right):
        data, offsets = words.utf8(column)
        buffer = words.padded(data, offsets[0], offsets[-1], lower=True)
        row, h, _, _ = shingles(buffer, offsets - offsets[0])
        rows.append(row)
        hashes.append(h)
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    twice = (row[1:] == row[:-1]) & (h[1:] == h[:-1])
    both = np.bincount(row[1:][twice], minlength=len(left))
    return both, np.bincount(row, minlength=len(left)) - both


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, ...) of nodes that are similar; joins are plain, for adaptive
    execution to split where a node has many candidates."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select(*pairs.columns, "text_a", "text_b")
    kept = len(pairs.columns)

    def check(batches):
        for batch in batches:
            _, of_a = words.utf8(batch.column(kept))
            _, of_b = words.utf8(batch.column(kept + 1))
            for i, j in words.pieces(of_a + of_b):
                part = batch.slice(i, j - i)
                both, either = jaccard_counts(part.column(kept), part.column(kept + 1))
                alike = pa.array(both >= threshold * either - 1e-9)
                yield part.select(list(range(kept))).filter(alike)

    return joined.mapInArrow(check, pairs.schema)


def block_links(
    entries: DataFrame, texts: DataFrame, threshold: float, block: int = BLOCK_NODES
) -> DataFrame:
    """Links (a, b) between nodes of different groups that share a bucket.

    ``entries``: (bucket, node, label).  The nodes outside a bucket's largest group are
    compared with all nodes of the bucket, in blocks against blocks: a task holds two
    blocks of bounded size, and no pair is a row unless it is a link.  Of the links of
    two blocks only those are returned that join groups.
    """
    groups = entries.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
    shape = groups.groupBy("bucket").agg(
        F.sum("k").alias("n"), F.max(F.struct("k", "label")).alias("main")
    )
    parts = lambda n: F.ceil(n / F.lit(block)).cast("int")
    placed = (
        entries.join(shape, "bucket")
        .withColumns(
            {"of_all": parts(F.col("n")), "of_rest": parts(F.col("n") - F.col("main.k")), "h": F.xxhash64("node")}
        )
        .withColumn("rest", F.col("label") != F.col("main.label"))
        .select("bucket", "node", "label", "rest", "of_all", "of_rest", "h")
        .join(texts, "node")
    )
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    everyone = placed.select(
        "bucket", F.pmod("h", "of_all").cast("int").alias("x"), each("of_rest").alias("y"), "node", "label", "text"
    )
    others = placed.filter("rest").select(
        "bucket", each("of_all").alias("x"), F.pmod("h", "of_rest").cast("int").alias("y"), "node", "label", "text"
    )
    keys = ["bucket", "x", "y"]
    others = others.toDF(*others.columns)  # columns of their own, as both sides have one source

    def compare(left, right):
        found = []
        if len(left) and len(right):
            found = _links_between(left, right, threshold)
        return pd.DataFrame(found, columns=["a", "b"])

    return everyone.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInPandas(compare, "a binary, b binary")


def _links_between(left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> list[tuple[bytes, bytes]]:
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    sides = []
    for frame in (left, right):
        data, offsets = words.utf8(pa.array(frame["text"], pa.large_string()))
        row, h, _, _ = shingles(words.padded(data, offsets[0], offsets[-1], lower=True), offsets - offsets[0])
        sides.append((row, h, np.bincount(row, minlength=len(frame))))
    (row_a, h_a, size_a), (row_b, h_b, size_b) = sides
    order = np.argsort(h_a, kind="stable")
    row_a, h_a = row_a[order], h_a[order]
    links = []
    ends = np.searchsorted(row_b, np.arange(len(right) + 1))
    for j in range(len(right)):
        own = h_b[ends[j] : ends[j + 1]]
        lo, hi = np.searchsorted(h_a, own, "left"), np.searchsorted(h_a, own, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(row_a[at], minlength=len(left))
        alike = both >= threshold * (size_a + size_b[j] - both) - 1e-9
        for i in np.flatnonzero(alike & (both > 0)).tolist():
            a, b = root(left["label"].iloc[i]), root(right["label"].iloc[j])
            if a != b:
                parent[b] = a
                links.append((left["node"].iloc[i], right["node"].iloc[j]))
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with an edge; the root is the smallest node.

    Alternating large-star and small-star steps, each a minimum per node and a join,
    until the stars stay the same; every round is a stored table.
    """

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())

    def lowest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))

    e = stored(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct(),
        "components",
    )
    before = None
    while (now := state(e)) != before:
        before = now
        one = e.select(F.col("node").alias("u"), F.col("root").alias("v"))
        both = one.union(e.select(F.col("root").alias("u"), F.col("node").alias("v")))
        # Large star: larger neighbours go to the smallest one.
        large = (
            both.join(lowest(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        # Small star: a node and its smaller neighbours go to the smallest one.
        small = large.join(lowest(large), "u")
        again = (
            small.select(F.col("v").alias("node"), F.col("m").alias("root"))
            .union(small.select(F.col("u").alias("node"), F.col("m").alias("root")))
            .filter(F.col("node") != F.col("root"))
            .distinct()
        )
        e = stored(again, "components")
    return e


def node_classes(docs: DataFrame, sketched: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root) of the nodes that are linked to others."""
    nodes = sketched.groupBy("node").agg(F.any_value("bands").alias("bands"))
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    mates = stored(entries.join(shared, "bucket"), "near-buckets")
    ranked = mates.join(
        mates.groupBy("node").agg(F.sum(F.col("n") - 1).alias("degree")), "node"
    )
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node")).alias("hub"))
    hub_pairs = (
        mates.join(hubs, "bucket")
        .filter(F.col("node") != F.col("hub.node"))
        .select(F.col("node").alias("a"), F.col("hub.node").alias("b"), F.col("hub.degree").alias("degree"))
        .distinct()
    )
    wanted = mates.select("node").distinct()
    texts = stored(
        with_node(docs.select("text"), "text", "node")
        .join(wanted, "node", "left_semi")
        .groupBy("node")
        .agg(F.any_value("text").alias("text")),
        "near-texts",
    )
    links = stored(verified(hub_pairs, texts, threshold), "near-links")
    # Known so far: a node belongs with the greatest hub that it is linked to.
    sides = F.explode(F.array("a", "b"))
    labels = (
        links.select(sides.alias("node"), "degree", F.col("b").alias("hub"))
        .groupBy("node")
        .agg(F.max(F.struct("degree", "hub")).alias("hub"))
        .select("node", F.col("hub.hub").alias("label"))
    )
    labelled = mates.join(labels, "node", "left").select(
        "bucket", "node", F.coalesce("label", "node").alias("label"), "n"
    )
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    open_ = stored(
        labelled.join(mixed.filter(F.col("lo") != F.col("hi")).select("bucket"), "bucket", "left_semi"),
        "near-open",
    )
    # Few mates: pair by pair, at most FEW / 2 pairs for each entry.  More: in blocks.
    few = open_.filter(F.col("n") <= FEW)
    other = few.select("bucket", F.col("node").alias("b"), F.col("label").alias("label_b"))
    rest = (
        few.join(other, "bucket")
        .filter((F.col("node") < F.col("b")) & (F.col("label") != F.col("label_b")))
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )
    many = open_.filter(F.col("n") > FEW).select("bucket", "node", "label")
    more = verified(rest, texts, threshold).union(block_links(many, texts, threshold))
    return components(links.select("a", "b").union(more))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, node, class_id) of every row of the documents."""
    sketched = stored(sketches(docs), "near-sketches")
    stars = node_classes(docs, sketched, threshold)
    rooted = sketched.select("doc_id", "node").join(stars, "node", "left").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root")
    )
    # Stored, so that the join stands between two plain exchanges and the rows of a
    # large class can be split.
    smallest = stored(rooted.groupBy("root").agg(F.min("doc_id").alias("class_id")), "near-classes")
    return rooted.join(smallest, "root").select("doc_id", "node", "class_id", "root")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one of the smallest id, as it is."""
    found = classes(docs, threshold)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    chosen = found.groupBy("root").agg(F.min(order).alias("c")).select(F.col("c.node").alias("_chosen"))
    node, nth = fresh(docs, "_node", "_nth")
    first = Window.partitionBy(node).orderBy(F.asc_nulls_last("doc_id"))
    return (
        with_node(docs, "text", node)
        .withColumn(nth, F.row_number().over(first))
        .filter(F.col(nth) == 1)
        .join(chosen, F.col(node) == F.col("_chosen"), "left_semi")
        .select(*docs.columns)
    )


def near_dedup_digest(docs: DataFrame) -> DataFrame:
    return classes(docs.select("doc_id", "text")).select("doc_id", "class_id")
