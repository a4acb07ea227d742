"""Unmatched spellings: the value of a reference list that a text was meant to be.

Two texts within edit distance ``k`` share a text that is left when at most ``k``
characters are deleted from each.  So the deletions of both sides are joined, which finds
every pair that can qualify and no all-pairs comparison, and the exact distance decides.
Deletions are joined as 64-bit hashes, as a hash that is shared by chance is sorted out
by the distance too.  Long texts are cut into ``k + 1`` pieces first, of which one has to
be left whole by ``k`` edits: their deletions would be too many.

A text that many rows have is looked up once: callers pass distinct values and join the
answer back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts up to this length are indexed by deletions, longer ones by pieces.
SHORT = 40


def _without(text: Column, at: Column) -> Column:
    """The text without its character ``at`` (from 1)."""
    return F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.length(text)))


def _less_one(texts: Column) -> Column:
    """All texts with one character less, and the texts themselves, each once."""
    shorter = F.flatten(
        F.transform(
            texts,
            lambda t: F.when(
                F.length(t) > 0, F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: _without(t, i))
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    return F.array_distinct(F.concat(texts, shorter))


def _pieces(text: Column, k: int) -> Column:
    """``k + 1`` pieces of a text, each with its number, and with every place it may have
    moved to: the texts it is compared with are shorter or longer by up to ``k``."""
    size = F.length(text)
    found = []
    for i in range(k + 1):
        begin = F.floor(size * i / (k + 1)).cast("int")
        end = F.floor(size * (i + 1) / (k + 1)).cast("int")
        found.append(F.struct(F.lit(i).alias("i"), size.alias("size"), F.substring(text, begin + 1, end - begin).alias("piece")))
    return F.array(*found)


def _windows(text: Column, k: int) -> Column:
    """What the pieces of texts of each length in reach would be in this text, wherever up
    to ``k`` edits before them have moved them."""
    size = F.length(text)
    found = []
    for longer in range(-k, k + 1):
        of = size + longer
        for i in range(k + 1):
            begin = F.floor(of * i / (k + 1)).cast("int")
            end = F.floor(of * (i + 1) / (k + 1)).cast("int")
            for shift in range(-k, k + 1):
                at = begin + shift
                inside = (at >= 0) & (at + (end - begin) <= size)
                found.append(
                    F.when(
                        inside,
                        F.struct(F.lit(i).alias("i"), of.alias("size"), F.substring(text, at + 1, end - begin).alias("piece")),
                    )
                )
    return F.array_distinct(F.array_compact(F.array(*found)))


def _deletions(text: Column, k: int) -> Column:
    texts = F.array(text)
    for _ in range(k):
        texts = _less_one(texts)
    return F.transform(texts, lambda t: F.xxhash64(t))


def _keys(text: Column, k: int, asked: bool) -> Column:
    """The hashes under which a text is found, or asked for.

    A short text may be within reach of a long one, so around the limit it has both kinds.
    """
    pieces = _windows(text, k) if asked else _pieces(text, k)
    by_piece = F.transform(pieces, lambda p: F.xxhash64(p["i"], p["size"], p["piece"]))
    none = F.array().cast("array<bigint>")
    short = F.length(text) <= SHORT
    # Pairs with a side up to SHORT - k have both sides short; all others are found by pieces.
    return F.array_distinct(
        F.concat(
            F.when(short, _deletions(text, k)).otherwise(none),
            F.when(F.length(text) > SHORT - k, by_piece).otherwise(none),
        )
    )


def neighbours(
    values: DataFrame, value: str, reference: DataFrame, known: str, within: int = 2, fold_case: bool = True
) -> DataFrame:
    """(value, known, distance) of all pairs of a value and a reference text within an edit
    distance, each once.

    Both sides are taken as distinct texts; NULL is in no pair.  With ``fold_case`` texts
    are compared in lower case and without spaces at either end, and returned as they are.
    Common deletions (those of very short texts) are hot keys of a plain join, which Spark
    splits at run time.  The join is merged: a text has dozens of hashes, which Spark's
    estimate of a side does not know of, so it would broadcast sides far too large for that.
    """
    form = (lambda c: F.lower(F.trim(c))) if fold_case else (lambda c: c)
    left = (
        values.select(F.col(value).alias("value")).filter(F.col("value").isNotNull()).distinct().withColumn("_v", form(F.col("value")))
    )
    right = (
        reference.select(F.col(known).alias("known")).filter(F.col("known").isNotNull()).distinct().withColumn("_k", form(F.col("known")))
    )
    asked = left.select("value", "_v", F.explode(_keys(F.col("_v"), within, True)).alias("_h"))
    held = right.select("known", "_k", F.explode(_keys(F.col("_k"), within, False)).alias("_h"))
    distance = F.levenshtein("_v", "_k", within)
    return (
        asked.join(held.hint("merge"), "_h")
        .filter(F.abs(F.length("_v") - F.length("_k")) <= within)
        .withColumn("distance", distance)
        .filter(F.col("distance") >= 0)
        .select("value", "known", "distance")
        .distinct()
    )


def meant(
    values: DataFrame, value: str, reference: DataFrame, known: str, within: int = 2, fold_case: bool = True
) -> DataFrame:
    """(value, known, distance, candidates): the nearest reference text of each value.

    ``candidates`` counts the texts at that distance; only where there is one is ``known``
    filled, as a guess between several would be no better than chance.  Values without
    a neighbour are left out.
    """
    near = neighbours(values, value, reference, known, within, fold_case)
    by_distance = near.groupBy("value", "distance").agg(F.count(F.lit(1)).alias("candidates"), F.min("known").alias("known"))
    return (
        by_distance.groupBy("value")
        .agg(F.min(F.struct("distance", "candidates", "known")).alias("best"))
        .select(
            "value",
            F.when(F.col("best.candidates") == 1, F.col("best.known")).alias("known"),
            F.col("best.distance").alias("distance"),
            F.col("best.candidates").alias("candidates"),
        )
    )
