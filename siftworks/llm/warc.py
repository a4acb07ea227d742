"""WARC archives: one gzip stream per file to one gzip member per record.

``write_archives`` stores pages as a crawler would, each archive one gzip stream.
``normalise`` inflates a stream once and rewrites every record as a member of its own,
records with a payload seen elsewhere as revisits, next to a sidecar index of offsets.
``read_back`` reads records by that index.

Defined cases: null html is an empty payload; of equal payloads the smallest page_id
is the response, a null page_id comes last, and the first in archive order decides
among equal ids; an empty table gives no archives; null urls have no target header;
line breaks in urls are escaped; an archive holds at most ``ARCHIVE_BYTES`` of payload
(or one larger record) and ``ARCHIVE_RECORDS`` records, so no task needs more.
Ids are any 64-bit integers: rows travel as Arrow columns, which hold them exactly
beside nulls.  Files are written under another name and then renamed: a task that runs twice leaves
one complete file.  The folder has to be one that all executors reach by its URI.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.frames import stored
from siftworks.sources.work_dir import new_folder

ARCHIVE_BYTES = 32 << 20
ARCHIVE_RECORDS = 20_000
CHUNK = 1 << 20
LEVEL = 3
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


class _Renamed:
    """A file that gets its name when it is complete."""

    def __init__(self, folder: str, name: str):
        self.fs, root = _open(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.at_work = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.at_work)
        self.write = self.out.write

    def done(self) -> None:
        self.out.close()
        self.fs.move(self.at_work, self.path)


def record(kind: str, page_id, url, digest: str, payload: bytes | None, n: int, refers_to=None) -> bytes:
    """A WARC record; a revisit has the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        safe = "".join(f"%{ord(c):02X}" if c < " " else c for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    head += [f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:] if ": " in line)


def _page(urn: str | None) -> int | None:
    return None if urn is None else int(urn.removeprefix("<urn:page:").removesuffix(">"))


def inflated(read, members: bool = False) -> Iterator[bytes]:
    """The content of a gzip stream, chunk by chunk, never whole."""
    inflate = zlib.decompressobj(wbits=31)
    while chunk := read(CHUNK):
        while chunk:
            out = inflate.decompress(chunk, CHUNK)
            if out:
                yield out
            chunk = inflate.unconsumed_tail
            if inflate.eof:
                chunk = inflate.unused_data
                inflate = zlib.decompressobj(wbits=31)
    rest = inflate.flush()
    if rest:
        yield rest


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record; one record is in memory at a time."""
    buffer, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        chunk = next(chunks, None)
        if chunk is None:
            return False
        if at > CHUNK:
            del buffer[:at]
            at = 0
        buffer.extend(chunk)
        return True

    while True:
        searched = at
        while (end := buffer.find(END, searched)) < 0:
            behind = len(buffer) - at
            if not more():
                if bytes(buffer[at:]).strip():
                    raise ValueError("the archive ends within a record")
                return
            searched = max(at, at + behind - 3)
        headers = parse_headers(bytes(buffer[at:end]))
        size, at = int(headers["Content-Length"]), end + 4
        while len(buffer) < at + size + 4:
            if not more():
                raise ValueError("the archive ends within a record")
        yield headers, bytes(buffer[at : at + size])
        at += size + 4


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows of Python values as Arrow, column by column."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives of one gzip stream each; returns a row per record.

    The rows are stored before they are used, so archives are written once.
    """
    rows = pages.select("page_id", "url", "html")
    schema = "archive string, nth int, page_id long, payload_bytes long, digest string"
    arrow = pa.schema(
        {"archive": pa.string(), "nth": pa.int32(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "digest": pa.string()}
    )

    def write(batches):
        task = TaskContext.get().partitionId()
        number, out, gz, size, listed = 0, None, None, 0, []

        def finish():
            out.write(gz.flush())
            out.done()
            return _batch(listed, arrow)

        for batch in batches:
            for at in range(batch.num_rows):
                page_id, url, html = (batch.column(c)[at].as_py() for c in range(3))
                payload = (html or "").encode()
                if out is not None and (size + len(payload) > ARCHIVE_BYTES or len(listed) >= ARCHIVE_RECORDS):
                    yield finish()
                    out = None
                if out is None:
                    name = f"part-{task:06d}-{number:04d}"
                    out, gz, size, listed = _Renamed(folder, f"{name}.warc.gz"), zlib.compressobj(LEVEL, wbits=31), 0, []
                    number += 1
                digest = payload_digest(payload)
                out.write(gz.compress(record("response", page_id, url, digest, payload, len(payload))))
                size += len(payload)
                listed.append((name, len(listed), page_id, len(payload), digest))
        if out is not None:
            yield finish()

    return stored(rows.mapInArrow(write, schema), "warc-records")


def with_revisits(listed: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``revisit`` and ``refers_to`` to the rows of the records.

    The first record of a payload is found by a minimum per digest, combined before
    the shuffle; only digests that occur twice are joined back.
    """
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "archive", "nth")
    firsts = (
        listed.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
    )
    other = (F.col("_first.archive") != F.col("archive")) | (F.col("_first.nth") != F.col("nth"))
    matched = (F.col("digest") == F.col("_digest")) & (F.col("payload_bytes") >= min_bytes)
    return listed.join(firsts, matched, "left").select(
        *listed.columns,
        F.coalesce(other, F.lit(False)).alias("revisit"),
        F.when(other, F.col("_first.page_id")).alias("refers_to"),
    )


def normalise(marked: DataFrame, folder: str, target: str) -> DataFrame:
    """Rewrite each archive with a member per record; returns the stored index.

    A group is the records of one archive, whose number is bounded.
    """
    schema = "archive string, nth int, offset long, length long"
    arrow = pa.schema({"archive": pa.string(), "nth": pa.int32(), "offset": pa.int64(), "length": pa.int64()})

    def rewrite(group: pa.Table) -> pa.Table:
        name = group["archive"][0].as_py()
        marks = zip(*(group[c].to_pylist() for c in ("nth", "revisit", "refers_to")), strict=True)
        revisits = {nth: refers_to for nth, revisit, refers_to in marks if revisit}
        fs, root = _open(folder)
        out, index, offset = _Renamed(target, f"{name}.warc.gz"), [], 0
        with fs.open_input_stream(f"{root}/{name}.warc.gz", compression=None) as stream:
            for nth, (headers, block) in enumerate(records(inflated(stream.read))):
                page_id, url = _page(headers.get("WARC-Record-ID")), headers.get("WARC-Target-URI")
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                payload = block[block.index(END) + 4 :]
                kind = "revisit" if nth in revisits else "response"
                raw = record(kind, page_id, url, digest, payload, len(payload), revisits.get(nth))
                gz = zlib.compressobj(LEVEL, wbits=31)
                member = gz.compress(raw) + gz.flush()
                out.write(member)
                index.append((name, nth, offset, len(member)))
                offset += len(member)
        out.done()
        if len(index) != group.num_rows:
            raise ValueError(f"{name} holds {len(index)} records, {group.num_rows} were written")
        sidecar = _Renamed(target, f"{name}.index.jsonl")
        for _, nth, start, length in index:
            sidecar.write((json.dumps({"nth": nth, "offset": start, "length": length}) + "\n").encode())
        sidecar.done()
        return pa.Table.from_batches([_batch(index, arrow)])

    slim = marked.select("archive", "nth", "revisit", "refers_to")
    return stored(slim.groupBy("archive").applyInArrow(rewrite, schema), "warc-index")


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the normalised archives, each found by its offset."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    arrow = pa.schema(
        {
            "page_id": pa.int64(),
            "payload_bytes": pa.int64(),
            "payload_digest": pa.string(),
            "record_type": pa.string(),
            "refers_to": pa.int64(),
        }
    )

    def read(group: pa.Table) -> pa.Table:
        fs, root = _open(folder)
        name, rows = group["archive"][0].as_py(), []
        with fs.open_input_file(f"{root}/{name}.warc.gz") as file:
            for offset, length in sorted(zip(group["offset"].to_pylist(), group["length"].to_pylist(), strict=True)):
                raw = zlib.decompress(file.read_at(length, offset), wbits=31)
                head = raw.index(END)
                headers = parse_headers(raw[:head])
                block = raw[head + 4 : head + 4 + int(headers["Content-Length"])]
                http = block.index(END)
                payload, digest = block[http + 4 :], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(parse_headers(block[:http])["Content-Length"])
                kind = headers["WARC-Type"]
                if kind == "response" and (payload_digest(payload) != digest or len(payload) != size):
                    raise ValueError(f"a payload of {name} is damaged")
                rows.append((_page(headers.get("WARC-Record-ID")), size, digest, kind, _page(headers.get("WARC-Refers-To"))))
        return pa.Table.from_batches([_batch(rows, arrow)])

    return index.groupBy("archive").applyInArrow(read, schema)


def archived(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write, normalise and read back; archives stay below ``folder``."""
    listed = write_archives(pages, f"{folder}/streams")
    index = normalise(with_revisits(listed, min_bytes), f"{folder}/streams", f"{folder}/records")
    return read_back(index, f"{folder}/records")


def warc_digest(pages: DataFrame) -> DataFrame:
    return archived(pages, new_folder(pages.sparkSession, "warc"))
