"""Byte-level BPE by ranks: encoding and decoding.

Tier one is a minimal perfect hash over the vocabulary: a pre-token that is itself an
entry is one id.  Tier two merges the others by lowest rank, with a heap of pairs over
linked bytes.

Defined cases: null text counts as empty and has no tokens; every pre-token is
encoded separately, whole texts always; ids do not depend on how rows are batched;
other columns are left out of the digest and kept by ``encoded_documents``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm import words
from siftworks.llm.frames import fresh

RANKS = "byte_bpe_50k.tiktoken"
# Code points that are cut into pre-tokens at once, and merges kept for reuse.
BLOCK_CHARS = 1 << 20
CACHED = 1 << 18


class MinimalPerfectHash:
    """n keys to n slots without gaps: hash, displace, and check the key.

    Keys are put into buckets; each bucket of several keys gets a displacement that
    sends its keys to free slots, largest bucket first, and buckets of one key are
    pointed at the slots that are left.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        data = np.frombuffer(b"".join(keys), np.uint8)
        length = np.array([len(k) for k in keys], np.int64)
        start = np.cumsum(length) - length
        buffer = words.padded(data, 0, len(data))
        h = words.hash_spans(buffer, start, length)
        self.n, self.buckets = n, max(1, n // 4)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        self.displacement = np.zeros(self.buckets, np.int64)
        self.entry = np.full(n, -1, np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(counts)
        free = np.ones(n, bool)
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] < 2:
                break
            members = by_bucket[ends[b] - counts[b] : ends[b]]
            d, slots = 1, None
            while slots is None:  # many displacements at a time
                tried = np.arange(d, d + 256)
                many = self._slots(h[members][None, :], tried[:, None])
                ordered = np.sort(many, axis=1)
                fits = free[many].all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if fits.any():
                    d, slots = int(tried[fits.argmax()]), many[fits.argmax()]
                else:
                    d += 256
            free[slots] = False
            self.entry[slots] = members
            self.displacement[b] = d
        singles = np.flatnonzero(counts == 1)
        left = np.flatnonzero(free)
        self.displacement[singles] = -1 - left
        self.entry[left] = by_bucket[ends[singles] - 1]
        # The key of each slot, for the check: bytes, start and length.
        self.bytes, self.start, self.length = buffer, start[self.entry], length[self.entry]
        self.hash = h[self.entry]

    def _slots(self, h: np.ndarray, d) -> np.ndarray:
        moved = words.mix64(h + np.asarray(d).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (moved % np.uint64(self.n)).astype(np.int64)

    def find(self, buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The key that each span equals, or -1, and the spans' hashes."""
        h = words.hash_spans(buffer, start, length)
        d = self.displacement[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(d < 0, -1 - d, self._slots(h, np.maximum(d, 0)))
        hit = np.flatnonzero((self.hash[slot] == h) & (self.length[slot] == length))
        same = np.ones(len(hit), bool)
        # Equal hash and length: compare the bytes themselves.
        mine = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
        theirs = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))
        size, done = length[hit], 0
        at, to = start[hit], self.start[slot[hit]]
        while done < (size.max() if len(size) else 0):
            on = size > done
            mask = words._MASKS[np.clip(size[on] - done, 0, 8)]
            same[on] &= (mine[at[on] + done] & mask) == (theirs[to[on] + done] & mask)
            done += 8
        found = np.full(len(start), -1, np.int64)
        found[hit[same]] = self.entry[slot[hit[same]]]
        return found, h


class Codec:
    """A vocabulary of byte strings with ranks, as read from a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        keys = sorted(ranks, key=ranks.__getitem__)
        self.ids = np.array([ranks[k] for k in keys], np.int64)
        self.whole = MinimalPerfectHash(keys)
        self.of_byte = [ranks[bytes([b])] for b in range(256)]
        if max(ranks.values()) >= 1 << 17:
            raise ValueError("ranks from 2^17 on are not supported")
        # Two neighbours merge when their bytes together are an entry.
        self.merged = {
            ranks[k[:i]] << 17 | ranks[k[i:]]: r
            for k, r in ranks.items()
            for i in range(1, len(k))
            if k[:i] in ranks and k[i:] in ranks
        }
        self.token = [b""] * (max(ranks.values()) + 1)
        for k, r in ranks.items():
            self.token[r] = k

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: lowest rank first, leftmost on ties."""
        rank_of = self.merged.get
        ids = [self.of_byte[b] for b in piece]
        n = len(ids)
        # rank[i]: of the pair that starts at i, as it is now.
        rank = [rank_of(a << 17 | b) for a, b in zip(ids, ids[1:])]  # noqa: B905
        bits = n.bit_length()
        heap = [r << bits | i for i, r in enumerate(rank) if r is not None]
        if not heap:
            return ids
        rank.append(None)
        heapq.heapify(heap)
        pop, push, mask = heapq.heappop, heapq.heappush, (1 << bits) - 1
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            x = pop(heap)
            r, i = x >> bits, x & mask
            if rank[i] != r:  # stale
                continue
            j = after[i]
            ids[i], ids[j], rank[j] = r, -1, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                x = rank[i] = rank_of(r << 17 | ids[k])
                if x is not None:
                    push(heap, x << bits | i)
            else:
                rank[i] = None
            k = before[i]
            if k >= 0:
                x = rank[k] = rank_of(ids[k] << 17 | r)
                if x is not None:
                    push(heap, x << bits | k)
        return [x for x in ids if x >= 0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class Encoder:
    """Encodes blocks of text; keeps merges of frequent misses."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.find = regex.compile(codec.pattern).findall
        self.iterate = regex.compile(codec.pattern).finditer
        self.cache: dict[bytes, list[int]] = {}

    def _block(self, tokens: list[str], row_tokens: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive pre-tokens, and how many of them each row has."""
        if not tokens:
            return np.zeros(0, np.int64), np.zeros(len(row_tokens), np.int64)
        data = "".join(tokens).encode()
        buffer = words.padded(np.frombuffer(data, np.uint8), 0, len(data))
        chars = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(chars)
        if len(data) != (ends[-1] if len(ends) else 0):  # some take several bytes
            firsts = np.flatnonzero((buffer[: len(data)] & 0xC0) != 0x80)
            ends = np.append(firsts, len(data))[ends]
        start = np.concatenate(([0], ends[:-1]))
        length = ends - start
        key, h = self.codec.whole.find(buffer, start, length)
        missed = np.flatnonzero(key < 0)
        _, first, which = np.unique(h[missed], return_index=True, return_inverse=True)
        lists = []
        for s, n in zip(start[missed[first]].tolist(), length[missed[first]].tolist(), strict=True):
            piece = data[s : s + n]
            ids = self.cache.get(piece)
            if ids is None:
                if len(self.cache) >= CACHED:
                    self.cache.clear()
                ids = self.cache[piece] = self.codec.merge(piece)
            lists.append(ids)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        counts = np.ones(len(tokens), np.int64)
        counts[missed] = sizes[which]
        places = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        hit = key >= 0
        out[places[hit]] = self.codec.ids[key[hit]]
        n = counts[missed]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(places[missed], n) + inside] = flat[np.repeat((np.cumsum(sizes) - sizes)[which], n) + inside]
        row_ends = np.concatenate(([0], np.cumsum(row_tokens)))
        return out, np.diff(np.append(places, len(out))[row_ends])

    def rows(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        """For each text the arrays whose concatenation is its ids."""
        at = 0
        while at < len(texts):
            if len(texts[at]) > BLOCK_CHARS:
                yield list(self._long(texts[at]))
                at += 1
                continue
            tokens, counts, chars = [], [], 0
            while at < len(texts) and chars + len(texts[at]) <= BLOCK_CHARS:
                found = self.find(texts[at])
                tokens += found
                counts.append(len(found))
                chars += len(texts[at])
                at += 1
            ids, n = self._block(tokens, counts)
            yield from ([part] for part in np.split(ids, np.cumsum(n)[:-1]))

    def _long(self, text: str) -> Iterator[np.ndarray]:
        tokens, chars = [], 0
        for match in self.iterate(text):
            tokens.append(match.group())
            chars += len(tokens[-1])
            if chars >= BLOCK_CHARS:
                yield self._block(tokens, [len(tokens)])[0]
                tokens, chars = [], 0
        if tokens:
            yield self._block(tokens, [len(tokens)])[0]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def codec(path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Codec:
    return Codec(read_ranks(path or public_tokenizers.path(RANKS)), pattern)


def encoded(docs: DataFrame, text: str, path: str | None, with_ids: bool) -> DataFrame:
    """All columns but the text, and ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256``, with ``with_ids`` the ids themselves."""
    # The vocabulary has a fixed size, some 20 MB with its tables.
    shared = docs.sparkSession.sparkContext.broadcast(codec(path))
    others = [c for c in docs.columns if c != text]
    frame = docs.select(*others, text)
    extra = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    schema = docs.select(*others).schema
    for field in docs.sparkSession.createDataFrame([], extra).schema:
        schema = schema.add(field)

    def encode(batches):
        encoder = Encoder(shared.value)
        decode = shared.value.decode
        for batch in batches:
            column = batch.column(len(others))
            _, offsets = words.utf8(column)
            for a, b in words.pieces(offsets):
                n_tokens, ids_digests, text_digests, ids = [], [], [], []
                texts = [t or "" for t in column.slice(a, b - a).to_pylist()]
                for parts in encoder.rows(texts):
                    of_ids, of_bytes = hashlib.sha256(), hashlib.sha256()
                    for part in parts:
                        of_ids.update(part.astype("<u4").tobytes())
                        of_bytes.update(decode(part.tolist()))
                    n_tokens.append(sum(map(len, parts)))
                    ids_digests.append(of_ids.hexdigest())
                    text_digests.append(of_bytes.hexdigest())
                    if with_ids:
                        ids.append(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32))
                columns = [c.slice(a, b - a) for c in batch.columns[: len(others)]]
                columns += [pa.array(n_tokens, pa.int64()), pa.array(ids_digests), pa.array(text_digests)]
                if with_ids:
                    ends = np.cumsum([0, *n_tokens]).astype(np.int32)
                    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return frame.mapInArrow(encode, schema)


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Documents as token ids: their columns without the text, and the ids."""
    clashing = [c for c in docs.columns if c.lower() in ("n_tokens", "ids_sha256", "decoded_sha256", "ids")]
    renamed = {c: fresh(docs, c)[0] for c in clashing}
    return encoded(docs.withColumnsRenamed(renamed), "text", path, with_ids=True)


def bpe_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    return encoded(docs.select(F.col("doc_id"), F.col("text")), "text", path, with_ids=False)
