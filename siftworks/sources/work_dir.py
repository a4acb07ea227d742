"""Where jobs store tables: the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session uses the machine's temporary folder; a
    cluster gets an error, as its machines do not share theirs.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.gettempdir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/siftworks/{purpose}-{uuid.uuid4().hex}"
