"""Words and bytes of Arrow text columns as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20

_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def mix64(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    h = (h ^ (h >> np.uint64(32))) * _M2
    h = (h ^ (h >> np.uint64(29))) * _M3
    return h ^ (h >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each starts and ends; null is empty."""
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, at least one row each."""
    rows = len(offsets) - 1
    at = 0
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(rows, max(to, at + 1))
        yield at, to
        at = to


def padded(data: np.ndarray, start: int, end: int, lower: bool = False) -> np.ndarray:
    """A copy of the bytes with eight zeros behind, in lower case if wanted."""
    out = np.zeros(end - start + 8, np.uint8)
    text = out[: end - start]
    text[:] = data[start:end]
    if lower:
        upper = (text - np.uint8(ord("A")) < 26).view(np.uint8)  # bytes below A wrap to large ones
        upper <<= 5
        text += upper
    return out


def hash_spans(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of a padded buffer, eight bytes a step."""
    eights = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    h = mix64(length.astype(np.uint64) * _M1 + np.uint64(seed))
    live = np.flatnonzero(length > 0)
    if 0 < len(live) == len(h):  # most spans are short, so the first step is most of the work
        h = mix64(h * _M1 ^ eights[start] & _MASKS.take(np.minimum(length, 8)))
        live = np.flatnonzero(length > 8)
        start, rest = start[live] + 8, length[live] - 8
    else:
        start, rest = start[live], length[live]
    while len(live):
        h[live] = mix64(h[live] * _M1 ^ eights[start] & _MASKS.take(np.minimum(rest, 8)))
        on = np.flatnonzero(rest > 8)
        live, start, rest = live[on], start[on] + 8, rest[on] - 8
    return h


def word_spans(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of the words ``[^\\x20\\x09-\\x0D]+`` of consecutive texts.

    ``offsets`` are those of the texts within the padded buffer, from 0.
    """
    size = int(offsets[-1])
    solid = np.zeros(size + 1, bool)
    text = buffer[:size]
    np.logical_and(text != 0x20, text - np.uint8(0x09) > 4, out=solid[:size])
    begins = solid[:size].copy()
    begins[1:] &= ~solid[: size - 1]
    ends = solid[:size] & ~solid[1:]
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]  # starts of texts that are not empty
    begins[inner] = solid[inner]
    after = inner[inner > 0] - 1
    ends[after] = solid[after]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    return start, length, row


class SortedHashes:
    """Sorted 64-bit hashes with a directory on their leading bits, for lookups."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = np.ascontiguousarray(hashes[self.order])
        bits = max(1, int(len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        starts = np.searchsorted(self.hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.starts = starts.astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each hash among those given to the constructor, or -1."""
        if not len(self.hashes):
            return np.full(len(wanted), -1, np.int64)
        bucket = (wanted >> self.shift).astype(np.int64)
        at, end = self.starts.take(bucket), self.starts.take(bucket + 1)
        # Most buckets have one hash or none; the place past the last hash is never in a bucket.
        hit = (self.hashes.take(at, mode="clip") == wanted) & (at < end)
        found = np.where(hit, self.order.take(at, mode="clip"), -1)
        live = np.flatnonzero(~hit & (at + 1 < end))
        at, end, wanted = at[live] + 1, end[live], wanted[live]
        while len(live):
            hit = self.hashes[at] == wanted
            found[live[hit]] = self.order[at[hit]]
            on = np.flatnonzero(~hit & (at + 1 < end))
            live, at, end, wanted = live[on], at[on] + 1, end[on], wanted[on]
        return found
