"""Tables that are replaced whole and never seen half-written.

A table is a folder of versions.  A load writes its rows to a new data folder, whose name
nobody else uses, and then publishes it by one small manifest that is renamed into place
as the last step:

    table/data/<unique name>/part-*.parquet
    table/manifests/00000000000000000007.json

Readers take the manifest of the highest number and open its data folder only.  A load
that dies leaves a data folder without a manifest, which no reader looks at; the version
before stays readable while another load runs and after it.  Two loads that finish at the
same time get two numbers, the later one wins, and neither mixes with the other.

The manifest holds the schema, the number of rows and the rows of every file, taken from
the footers of what was committed, so counts are those of the data whatever was retried.
All file operations go through Hadoop's file system, so any store that Spark writes to
will do; it must not replace the target of a rename, or else loads must not overlap.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_DIGITS = 20
_TRIES = 100


@dataclass(frozen=True)
class Version:
    """What one manifest says."""

    version: int
    folder: str
    rows: int
    files: dict[str, int]
    schema: str
    loaded_at: float
    note: str = ""


class NoVersion(LookupError):
    """The table has no such version."""


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its class."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _fs(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    size = fs.getFileStatus(where).getLen()
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode()
    finally:
        stream.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def numbers(spark: SparkSession, table: str) -> list[int]:
    """The published versions, in order."""
    names = _names(spark, f"{table}/manifests")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]


def version(spark: SparkSession, table: str, number: int | None = None) -> Version:
    """A published version, the newest if none is named."""
    known = numbers(spark, table)
    wanted = number if number is not None else max(known, default=None)
    if wanted not in known:
        raise NoVersion(f"{table} has no version{'' if number is None else f' {number}'}")
    return Version(**json.loads(_read_text(spark, f"{table}/manifests/{wanted:0{_DIGITS}d}.json")))


def file_rows(spark: SparkSession, folder: str, schema: StructType | None = None) -> dict[str, int]:
    """Rows of every file below a folder; no column is read, so footers answer it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    counts = reader.parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    begin = folder.rstrip("/").rsplit("/", 1)[1]
    return {r["file"].split(f"/{begin}/", 1)[1]: r["n"] for r in counts.collect()}


def load(df: DataFrame, table: str, partition_by: tuple[str, ...] = (), note: str = "") -> Version:
    """Replace the whole table by the rows, and say what is in it now."""
    spark = df.sparkSession
    folder = f"{table}/data/{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    files = file_rows(spark, folder, df.schema)
    return _publish(spark, table, folder, files, df.schema.json(), note)


def _publish(spark: SparkSession, table: str, folder: str, files: dict[str, int], schema: str, note: str) -> Version:
    fs, where = _fs(spark, f"{table}/manifests")
    fs.mkdirs(where)
    at_work = f"{table}/manifests/.{uuid.uuid4().hex}"
    for _ in range(_TRIES):
        number = max(numbers(spark, table), default=0) + 1
        made = Version(number, folder.rsplit("/", 1)[1], sum(files.values()), files, schema, time.time(), note)
        _write_text(spark, at_work, json.dumps(asdict(made)))
        name = f"{table}/manifests/{number:0{_DIGITS}d}.json"
        _, target = _fs(spark, name)
        _, source = _fs(spark, at_work)
        # Renaming onto a file that exists fails: another load has taken the number.
        if not fs.exists(target) and fs.rename(source, target):
            return made
        fs.delete(source, False)
    raise RuntimeError(f"no free version number for {table} after {_TRIES} tries")


def read(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The rows of a version, the newest if none is named.

    The frame stays with the version it was made of, whatever is loaded later.
    """
    found = version(spark, table, number)
    return spark.read.schema(StructType.fromJson(json.loads(found.schema))).parquet(f"{table}/data/{found.folder}")


def history(spark: SparkSession, table: str) -> DataFrame:
    """(version, rows, files, note), one row for every published version."""
    known = [version(spark, table, n) for n in numbers(spark, table)]
    return spark.createDataFrame(
        [(v.version, v.rows, len(v.files), v.note) for v in known], "version long, rows long, files long, note string"
    )


def roll_back(spark: SparkSession, table: str, number: int) -> Version:
    """Publish an earlier version again, as the newest."""
    old = version(spark, table, number)
    return _publish(spark, table, f"{table}/data/{old.folder}", old.files, old.schema, f"version {number} again")


def clear(spark: SparkSession, table: str, keep: int = 2, older_than_seconds: float = 86_400.0) -> list[str]:
    """Delete data folders that neither the last ``keep`` versions use nor a load may
    still be writing; return their names.  Manifests of deleted data go first, so no
    reader finds one without its files."""
    known = numbers(spark, table)
    kept = {version(spark, table, n).folder for n in known[-keep:]}
    dropped = [n for n in known[:-keep] if version(spark, table, n).folder not in kept]
    for n in dropped:
        fs, where = _fs(spark, f"{table}/manifests/{n:0{_DIGITS}d}.json")
        fs.delete(where, False)
    gone = []
    before = (time.time() - older_than_seconds) * 1000
    for name in _names(spark, f"{table}/data"):
        fs, where = _fs(spark, f"{table}/data/{name}")
        if name not in kept and fs.getFileStatus(where).getModificationTime() <= before:
            fs.delete(where, True)
            gone.append(name)
    return gone
