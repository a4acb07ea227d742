"""Drop lines that many documents share.

Lines are exploded, normalised and hashed; documents are counted per hash; lines
over the threshold go, and what is left is put together again by position.

Defined cases: null text counts as empty, which is one empty line; keys shorter
than ``min_chars`` never go, so blank lines stay; a line counts once for each row
of the table that holds it, repeated rows and ids count as documents of their own;
an empty table gives no rows; all other columns pass through under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.frames import BLANKS, ascii_lower, fresh, stored


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _ids(value: Column) -> list[Column]:
    """96 bits from two unrelated hashes."""
    return [F.xxhash64(value), F.hash(value)]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed_lines(text: Column, min_chars: int) -> Column:
    """Structs (pos, h1, h2) of the lines that may go."""
    keys = F.transform(_lines(text), lambda line, i: F.struct(i.alias("pos"), line_key(line).alias("key")))
    long_enough = F.filter(keys, lambda k: F.length(k["key"]) >= min_chars)
    return F.transform(
        long_enough,
        lambda k: F.struct(
            k["pos"].alias("pos"), F.xxhash64(k["key"]).alias("h1"), F.hash(k["key"]).alias("h2")
        ),
    )


def frequent_lines(docs: DataFrame, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(h1, h2) of the line keys in at least ``min_docs`` documents.

    Each document sends a key once, and tasks add up before the shuffle: a line
    that a third of all documents share is one row per task.
    """
    keys = F.transform(
        _hashed_lines(F.col(text), min_chars), lambda k: F.struct(k["h1"].alias("h1"), k["h2"].alias("h2"))
    )
    return (
        docs.select(F.explode(F.array_distinct(keys)).alias("k"))
        .groupBy("k.h1", "k.h2")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_docs)
        .select("h1", "h2")
    )


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """The documents without their frequent lines, and two counts.

    Dropped positions are found per distinct text, so copies and missing ids need
    no care: rows of the same text lose the same lines.  Both joins are plain, for
    adaptive execution to split where a line or a text is hot.
    """
    f1, f2, g1, g2, lines, gone, kept = fresh(docs, "_f1", "_f2", "_g1", "_g2", "_lines", "_gone", "_kept")
    content = F.coalesce(F.col(text), F.lit(""))
    a, b = _ids(content)
    # The text is hashed before its lines are exploded, once and not for each line.
    hashed = (
        docs.select(a.alias("f1"), b.alias("f2"), _hashed_lines(F.col(text), min_chars).alias("ks"))
        .select("f1", "f2", F.explode("ks").alias("k"))
        .select("f1", "f2", "k.pos", "k.h1", "k.h2")
    )
    # From a table, so that the join stands between two plain exchanges and the lines of
    # a hot key can be split.
    frequent = stored(frequent_lines(docs, text, min_docs, min_chars), "frequent-lines")
    dropped = (
        hashed.join(frequent, ["h1", "h2"], "left_semi")
        .groupBy(F.col("f1").alias(g1), F.col("f2").alias(g2))
        .agg(F.collect_set("pos").alias(gone))
    )
    rows = docs.withColumns({f1: a, f2: b})
    joined = rows.join(
        dropped, (F.col(f1) == F.col(g1)) & (F.col(f2) == F.col(g2)), "left"
    ).withColumn(lines, _lines(F.col(text)))
    nothing = F.array().cast("array<int>")
    # array_except works through a hash set and keeps the order of positions.
    left = F.array_except(
        F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(F.col(gone), nothing)
    )
    rebuilt = F.array_join(F.transform(F.col(kept), lambda i: F.get(F.col(lines), i)), "\n")
    return (
        joined.withColumn(kept, left)
        .withColumns(
            {
                text: F.when(F.col(gone).isNull(), content).otherwise(rebuilt),
                n_lines: F.size(lines).cast("long"),
                n_dropped: F.size(F.coalesce(F.col(gone), nothing)).cast("long"),
            }
        )
        .drop(f1, f2, g1, g2, lines, gone, kept)
    )


def without_repeated_lines(docs: DataFrame, **settings) -> DataFrame:
    """All documents with the columns they had; ``n_chars`` follows the text."""
    n_lines, n_dropped = fresh(docs, "_n_lines", "_n_dropped")
    out = drop_repeated_lines(docs, n_lines=n_lines, n_dropped=n_dropped, **settings)
    if "n_chars" in docs.columns:
        out = out.withColumn(
            "n_chars", F.when(F.col(n_dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return out.select(*docs.columns)


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    out = drop_repeated_lines(docs.select("doc_id", "text"))
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


# DuckDB: split, strip and lower-case as above.
ORACLE = """
WITH lines AS (
  SELECT d.rowid_ AS r, d.doc_id, u.i AS pos, d.parts[u.i] AS line,
         translate(trim(d.parts[u.i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row_number() OVER () AS rowid_, doc_id,
               string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
       unnest(range(1, len(d.parts) + 1)) AS u(i)
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT l.*, f.key IS NOT NULL AS gone FROM lines l LEFT JOIN frequent f ON l.key = f.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
