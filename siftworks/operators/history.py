"""Deduplication of a feed against everything that was stored before.

The history keeps the keys of each period (a day, a month) in a folder of its own, and
beside them a Bloom filter of each period.  A new feed is first probed against the filters;
only keys that may have been there, and only in periods that may hold them, meet the stored
keys in an exact join.  So a daily feed of new keys reads filters, not the history, and the
result is the one that deduplicating old and new rows together would give.

A filter is cut into blocks of 32,768 bits, the unit of Spark's bitmap functions.  All bits
of a key lie in one block, so a probe is one equi-join on the block number, filters are built
by a plain aggregate with map-side combine, and nothing is collected or broadcast by hand.
The number of blocks is fixed when a history begins; ``fill`` shows when it gets too small,
upon which ``rebuilt`` makes larger filters from the stored keys.  A full filter costs time,
never a wrong result.

Periods are added by ``add``; adding one again replaces it, so a failed load is just run
again.  Rows without a key repeat nothing and are not stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.operators.dedupe import keep_first

BLOCK_BITS = 32_768
# Bits per key; with ten of them per key in a block some 1 % of new keys look known.
HASHES = 7

KEYS = "period string, key string"
BLOCKS = "period string, block bigint, bits binary"


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _places(key: Column) -> Column:
    """The places of a key within its block."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)).cast("int") for i in range(1, HASHES + 1)])


def filters(keys: DataFrame, blocks: int) -> DataFrame:
    """(period, block, bits) of (period, key): one bitmap per period and block in use."""
    return (
        keys.select("period", _block(F.col("key"), blocks).alias("block"), F.explode(_places(F.col("key"))).alias("at"))
        .groupBy("period", "block")
        .agg(F.expr("bitmap_construct_agg(at)").alias("bits"))
    )


def merged(found: DataFrame) -> DataFrame:
    """(block, bits) of several periods together."""
    return found.groupBy("block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))


def _all_set(bits: Column, places: Column) -> Column:
    """Does the bitmap have all of the places set?"""

    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, at % 8) == 1

    return F.forall(places, is_set)


def probe(keys: DataFrame, found: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` (with a column ``key``) that a filter may hold, joined to its
    other columns, such as the period."""
    others = [c for c in found.columns if c not in ("block", "bits")]
    probed = keys.withColumns({"_block": _block(F.col("key"), blocks), "_places": _places(F.col("key"))})
    return (
        probed.join(found, F.col("_block") == F.col("block"))
        .filter(_all_set(F.col("bits"), F.col("_places")))
        .select(*keys.columns, *others)
    )


@dataclass(frozen=True)
class History:
    """Stored keys and filters below a folder."""

    spark: SparkSession
    folder: str
    blocks: int

    def keys(self) -> DataFrame:
        return self.spark.read.schema(KEYS).parquet(f"{self.folder}/keys")

    def filters(self) -> DataFrame:
        return self.spark.read.schema(BLOCKS).parquet(f"{self.folder}/filters-{self.blocks}")

    def add(self, rows: DataFrame, key: Column, period: Column) -> None:
        """Store the keys of the rows' periods, replacing periods that are there already.

        Keys first: a period without its filter is not probed, so an end between the two
        writes must be mended by adding the period again, as after any failed load.
        """
        keys = (
            rows.select(period.cast("string").alias("period"), key.cast("string").alias("key"))
            .filter(F.col("key").isNotNull() & F.col("period").isNotNull())
            .distinct()
        )
        self._replace(keys, "keys")
        added = self.keys().join(keys.select("period").distinct(), "period", "left_semi")
        self._replace(filters(added, self.blocks), f"filters-{self.blocks}")

    def _replace(self, rows: DataFrame, name: str) -> None:
        """Write whole periods; others stay as they are."""
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("period")
            .parquet(f"{self.folder}/{name}")
        )

    def known(self, keys: DataFrame) -> DataFrame:
        """The distinct values of ``key`` that are stored.

        All periods together are probed first; what passes is probed period by period, and
        only what passes again is looked up.  The lookup names its periods, so those of no
        candidate are not opened.
        """
        distinct = keys.select("key").filter(F.col("key").isNotNull()).distinct()
        maybe = probe(distinct, merged(self.filters()), self.blocks)
        by_period = probe(maybe, self.filters(), self.blocks)
        stored = self.keys().select("period", "key")
        return by_period.join(stored, ["period", "key"], "left_semi").select("key").distinct()

    def new_rows(self, feed: DataFrame, key: Sequence[str], order_by: Sequence[str], row_id: str) -> DataFrame:
        """The first row of each key of the feed that is in no stored period.

        Rows without a key are all kept.  Known keys are one row each, so a key with a third
        of the feed is no hot key of the join: the feed is deduplicated before.
        """
        firsts = keep_first(feed, key, order_by, row_id)
        as_text = joined_key(key)
        return (
            firsts.withColumn("_key", as_text)
            .join(self.known(feed.select(as_text.alias("key"))).withColumnRenamed("key", "_key"), "_key", "left_anti")
            .drop("_key")
        )

    def fill(self) -> DataFrame:
        """(period, keys, bits_set, share) of each filter; ``share`` counts all blocks."""
        bits = self.filters().groupBy("period").agg(F.sum(F.expr("bitmap_count(bits)")).alias("bits_set"))
        keys = self.keys().groupBy("period").agg(F.count(F.lit(1)).alias("keys"))
        share = F.col("bits_set") / F.lit(float(self.blocks * BLOCK_BITS))
        return keys.join(bits, "period").withColumn("share", share)

    def rebuilt(self, blocks: int) -> History:
        """The same history with filters of another size, beside the old ones."""
        other = History(self.spark, self.folder, blocks)
        other._replace(filters(self.keys(), blocks), f"filters-{blocks}")
        return other


def joined_key(key: Sequence[str]) -> Column:
    """The key columns as one text, NULL if one of them is; lengths keep parts apart."""
    if len(key) == 1:
        return F.col(key[0]).cast("string")
    parts = []
    for c in key:
        part = F.col(c).cast("string")
        parts += [F.length(part).cast("string"), F.lit(":"), part]
    return F.concat(*parts)


def blocks_for(keys: int, bits_per_key: int = 10) -> int:
    """Blocks that hold so many keys, over all periods, in a filter that works well."""
    return max(1, -(-keys * bits_per_key // BLOCK_BITS))
