"""Mix sources to target weights by Sainte-Lague apportionment of blocks.

Each source is cut into shards, and the words of a shard, its documents in the
order of a seeded hash, into blocks of equally many words.  Blocks are seats:
sources get them by the highest quotients target / (2k + 1), then the shards of a
source in the same way by their number of blocks.  A shard takes its quota of
blocks from a seeded start on, round and round, so no block is taken more often
than ``max_repeats`` times and documents are whole but for the two ends.

Defined cases: null text has size 0 and takes nothing; a null source is a source of
its own, last in order; rows with equal id and text are interchangeable; an empty
table gives no rows.  Only sums per source and per shard are ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftworks.llm.frames import fresh, stored, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18
SEED = "mix"


def apportion(
    items: DataFrame, group: Sequence[str], item: str, weight: str, seats: str, quota: str
) -> DataFrame:
    """Add each item's seats of its group's ``seats``, by highest quotients.

    All quotients above a safe divisor are granted by rounding; only the few around
    the last seat, about three per item, are sorted.  Ties go to the smaller item.
    """
    whole = Window.partitionBy(*group)
    total, n = F.sum(weight).over(whole), F.count(F.lit(1)).over(whole)
    slack = F.col("_n") / 2 + 1
    share = F.when(F.col("_total") > 0, F.col(weight) / F.col("_total")).otherwise(F.lit(0.0))
    bounded = (
        items.withColumns({"_total": total, "_n": n})
        .withColumns(
            {
                "_low": F.greatest(
                    F.lit(0), F.floor(share * (F.col(seats) - slack) + 0.5) - 1
                ).cast("long"),
                "_high": (F.floor(share * (F.col(seats) + slack) + 0.5) + 1).cast("long"),
            }
        )
        .withColumn("_rest", F.col(seats) - F.sum("_low").over(whole))
    )
    ranked = (
        bounded.filter(F.col(weight) > 0)
        .withColumn("_k", F.explode(F.sequence(F.col("_low"), F.col("_high"))))
        .withColumn("_quotient", F.col(weight) / (2 * F.col("_k") + 1))
        .withColumn(
            "_rank",
            F.row_number().over(whole.orderBy(F.desc("_quotient"), F.asc_nulls_last(item), "_k")),
        )
    )
    won = ranked.groupBy(*group, item).agg(
        F.count_if(F.col("_rank") <= F.col("_rest")).alias("_more")
    )
    keys = [*group, item]
    renamed = won.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "_more")
    same = [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys]
    matched = same[0]
    for s in same[1:]:
        matched = matched & s
    return (
        bounded.join(renamed, matched, "left")
        .withColumn(quota, F.col("_low") + F.coalesce(F.col("_more"), F.lit(0)))
        .drop("_total", "_n", "_low", "_high", "_rest", "_more", *[f"_w_{k}" for k in keys])
    )


def source_targets(
    sources: DataFrame, weights: Sequence[int], share: float, max_repeats: int
) -> DataFrame:
    """Add weight and target: shares by weight, stopped at the cap, the excess
    reshared.  That ends at one level ``l`` with target = least(cap, l * weight)."""
    nth = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    filling = Window.partitionBy(F.lit(0)).orderBy(F.col("_cap") / F.col("weight"), F.asc_nulls_last("source"))
    whole = Window.partitionBy(F.lit(0))
    listed = F.array(*[F.lit(w) for w in weights])
    ranked = (
        sources.withColumn(
            "weight", F.get(listed, ((F.row_number().over(nth) - 1) % len(weights)).cast("int"))
        )
        .withColumn("_cap", max_repeats * F.col("source_size"))
        .withColumns(
            {
                "_before": F.coalesce(
                    F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "_left": F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)),
                "_want": share * F.sum("source_size").over(whole),
            }
        )
        .withColumn("_level", (F.col("_want") - F.col("_before")) / F.col("_left"))
    )
    fits = F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level"))
    # Levels fall or stay from the first source that is not stopped on.
    level = F.max(fits).over(whole)
    return ranked.withColumn(
        "target",
        F.coalesce(F.least(F.col("_cap").cast("double"), level * F.col("weight")), F.col("_cap").cast("double")),
    ).select("source", "source_size", "weight", "target")


def _number(text: Column) -> Column:
    """The first 32 bits of an md5 in hex."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("long")


def _overlap(a: Column, b: Column, x: Column, y: Column) -> Column:
    return F.greatest(F.lit(0), F.least(b, y) - F.greatest(a, x))


def _key(seed: str) -> Column:
    parts = [F.col("doc_id").cast("string"), F.col("source"), F.md5("text")]
    return F.md5(
        F.concat(F.lit(seed), *[F.concat(F.lit(":"), F.coalesce(p, F.lit(""))) for p in parts])
    )


def sized_documents(docs: DataFrame, seed: str) -> DataFrame:
    """(doc_id, source, size, key) per row; the key fixes the order of the draw."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("key")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """Per document: size, its source's size and target, and what the mix takes.

    ``taken`` = ``full`` whole rounds plus the words [first, last) and, where the
    round starts anew, [0, wrapped), as positions in the document.  Documents are
    read once for their sizes; all that follows works on narrow rows.
    """
    sized = stored(sized_documents(docs, seed), "mix-sizes")
    sources = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeats
    )
    seats = F.floor(F.sum("target").over(Window.partitionBy("_all")) / block_words + 0.5).cast("long")
    sources = (
        apportion(
            sources.withColumn("_all", F.lit(0)).withColumn("_seats", seats),
            ["_all"], "source", "target", "_seats", "source_quota",
        )
        .withColumn(
            "shards",
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"),
        )
        .select("source", "source_size", "target", "source_quota", "shards")
    )
    sources = stored(sources, "mix-sources")
    placed = (
        sized.join(
            sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
        )
        .withColumn("shard", F.shiftright(_number(F.col("key")) * F.col("shards"), 32))
        .drop("_s")
    )
    shards = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("words"), F.max("source_quota").alias("source_quota")
    ).withColumn("blocks", F.ceil(F.col("words") / block_words).cast("long"))
    quotas = apportion(shards, ["source"], "shard", "blocks", "source_quota", "quota").select(
        F.col("source").alias("_s"),
        F.col("shard").alias("_d"),
        "words",
        "blocks",
        F.least(F.col("quota"), max_repeats * F.col("blocks")).alias("quota"),
        F.when(
            F.col("blocks") > 0,
            _number(
                F.md5(
                    F.concat(
                        F.lit(seed + ":start:"),
                        F.coalesce(F.col("source"), F.lit("")),
                        F.lit(":"),
                        F.col("shard").cast("string"),
                    )
                )
            )
            % F.col("blocks"),
        ).otherwise(F.lit(0)).alias("start"),
    )
    in_shard = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "size")
    upto = F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0))
    a, b, n = F.col("_a"), F.col("_b"), F.col("blocks")
    more = F.when(n > 0, F.col("quota") % n).otherwise(F.lit(0))
    end = F.col("start") + F.col("_more")
    return (
        placed.withColumn("_b", upto)
        .withColumn("_a", F.col("_b") - F.col("size"))
        .join(
            quotas,
            F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_d")),
        )
        .withColumn("_more", more)
        .withColumns(
            {
                "full": F.when(n > 0, F.floor(F.col("quota") / n)).otherwise(F.lit(0)).cast("long"),
                "first": F.greatest(F.lit(0), F.least(F.col("size"), F.col("start") * block_words - a)),
                "last": F.greatest(F.lit(0), F.least(F.col("size"), end * block_words - a)),
                "wrapped": _overlap(a, b, F.lit(0), (end - n) * block_words),
            }
        )
        .withColumn(
            "taken",
            F.col("full") * F.col("size") + F.col("last") - F.col("first") + F.col("wrapped"),
        )
        .select(
            "doc_id", "key", "size", "source_size", "target", "taken", "full", "first", "last", "wrapped"
        )
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself, with the columns of the documents.

    A row for each time a document, or a part of it, is taken; parts hold whole
    words.  Documents of which nothing is taken go.
    """
    seed = settings.get("seed", SEED)
    key, nth, piece = fresh(docs, "_key", "_nth", "_piece")
    nought = F.lit(0).cast("long")
    span = lambda start, end: F.struct(start.alias("from"), end.alias("to"))
    pieces = F.concat(
        F.array_repeat(span(nought, F.col("size")), F.col("full").cast("int")),
        F.filter(
            F.array(span(F.col("first"), F.col("last")), span(nought, F.col("wrapped"))),
            lambda p: p["to"] > p["from"],
        ),
    )
    # Rows with equal key are interchangeable: one of them gives the text, and the
    # pieces of all of them are cut from it.
    plan = (
        mix(docs, **settings)
        .filter(F.col("taken") > 0)
        .groupBy(F.col("key").alias("_plan_key"))
        .agg(F.max("size").alias("_size"), F.flatten(F.collect_list(pieces)).alias("_pieces"))
    )
    first = Window.partitionBy(key).orderBy(F.lit(0))
    keyed = (
        docs.withColumn(key, _key(seed))
        .withColumn(nth, F.row_number().over(first))
        .filter(F.col(nth) == 1)
    )
    whole = F.col("_size")
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.rtrim(
        F.array_join(
            F.slice(words, (F.col(piece)["from"] + 1).cast("int"), (F.col(piece)["to"] - F.col(piece)["from"]).cast("int")),
            "",
        )
    )
    complete = (F.col(piece)["from"] == 0) & (F.col(piece)["to"] == whole)
    joined = (
        keyed.join(plan, F.col(key) == F.col("_plan_key"))
        .withColumn(piece, F.explode("_pieces"))
        .withColumn("text", F.when(complete, F.col("text")).otherwise(cut))
    )
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast("long"))
    return joined.select(*docs.columns)


def mixing_digest(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':'
             || coalesce(md5(text), '')) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size) AS source_size,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, 2 * source_size AS cap,
         coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE) AS want
  FROM sources
), levels AS (
  SELECT *, (want - CAST(before AS DOUBLE)) / CAST(rest AS DOUBLE) AS level FROM ranked
), targets AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         least(CAST(cap AS DOUBLE), max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight) AS target
  FROM levels
), seats AS (
  SELECT CAST(floor(sum(target) / 16 + 0.5) AS BIGINT) AS n FROM targets
), source_quotas AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS nth
    FROM (SELECT source, target, unnest(range(CAST(target / 16 + 1000 AS BIGINT))) AS k FROM targets)
  ), seats WHERE nth <= n GROUP BY source
), placed AS (
  SELECT s.*, t.source_size AS whole, t.target, q.quota AS source_quota,
         (CAST('0x' || substr(s.key, 1, 8) AS BIGINT)
           * greatest(1, CAST(ceil(t.source_size / 262144.0) AS BIGINT))) >> 32 AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  LEFT JOIN source_quotas q ON s.source IS NOT DISTINCT FROM q.source
), shards AS (
  SELECT source, shard, CAST(ceil(sum(size) / 16.0) AS BIGINT) AS blocks, max(source_quota) AS source_quota
  FROM placed GROUP BY source, shard
), shard_quotas AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, source_quota,
           row_number() OVER (PARTITION BY source ORDER BY blocks / (2 * k + 1) DESC, shard, k) AS nth
    FROM (SELECT *, unnest(range(2 * blocks + 1000)) AS k FROM shards)
  ) WHERE nth <= source_quota GROUP BY source, shard
), starts AS (
  SELECT s.source, s.shard, s.blocks, least(q.quota, 2 * s.blocks) AS quota,
         CASE WHEN s.blocks > 0 THEN CAST('0x' || substr(md5('mix:start:' || coalesce(s.source, '') || ':'
           || s.shard), 1, 8) AS BIGINT) % s.blocks END AS first
  FROM shards s LEFT JOIN shard_quotas q
    ON s.source IS NOT DISTINCT FROM q.source AND s.shard = q.shard
), ranges AS (
  SELECT p.*, s.blocks, s.quota, s.first,
         CAST(sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS b
  FROM placed p JOIN starts s ON p.source IS NOT DISTINCT FROM s.source AND p.shard = s.shard
)
SELECT doc_id, size, whole AS source_size, target,
       CASE WHEN blocks = 0 THEN 0 ELSE
         CAST((quota // blocks) * size
         + greatest(0, least(b, (first + quota % blocks) * 16) - greatest(b - size, first * 16))
         + greatest(0, least(b, (first + quota % blocks - blocks) * 16) - (b - size)) AS BIGINT) END AS taken
FROM ranges
"""
