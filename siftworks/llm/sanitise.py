"""Personal data: base spans by pattern, and terms that give protected values away.

Every e-mail address, IP address, card and phone number found is a protected entity.
The corpus tells how much a term of its documents reveals: with document frequencies as
probabilities, PMI(term; entity) / IC(entity) is the share of the entity's information
that the term discloses, 1 if it occurs nowhere else and often.  P(entity | term) is
estimated with ``PRIOR`` documents' worth of P(entity) beside the ones seen, so a term
seen once counts for less than one seen ten times, yet a name that stands beside an address
in a single document is judged like all others.  Terms from ``GENERALISE`` on are replaced
by a general word where the entity occurs, from ``REMOVE`` on they go.  Terms are the
distinct words of a whole text, apart from its e-mail addresses: letters, digits and
underscores that begin with a letter or underscore, two at least.

Entities that occur in the same documents disclose and are disclosed alike, so they are
counted as one class: a page of very many addresses is one class, not one per address.

Built-in expressions only.  Texts are scanned once; a table of the findings, with text
only where something was found, carries the rest.

Defined cases: null text counts as empty and has no spans; matches that fail their check
are passed over whole; spans of different kinds may overlap; repeated rows count each
time, in all frequencies alike; rows without or with repeated ids are rows of their own;
an empty table gives no rows; other columns pass through ``sanitised``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftworks.llm.frames import stored

GENERALISE = 0.85
REMOVE = 0.95
# Documents that P(entity) is worth in the estimate of P(entity | term).
PRIOR = 0.5
_INNER = r"\p{L}\p{M}\p{N}_"
TERM = rf"(?<![{_INNER}])[\p{{L}}_][{_INNER}]++"
TERM_KIND = "term"

# The matches are those of the plain patterns of the contract.  Possessive loops, and
# starts only where a run starts or a match has ended, keep the search linear.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, TERM_KIND]
# A text without it has no match.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    values = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(values, F.lit(0), lambda acc, x: acc + F.when(x > 9, x - 9).otherwise(x))
    return total % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return text.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    digits = _digits(text)
    n = F.length(digits)
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), _luhn(digits)).otherwise(F.lit(False))


# Lengths that are added up one by one.
_BLOCK = 64


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, x: acc + x)


def _with_matches(rows: DataFrame, name: str, pattern: Column, gate: Column) -> DataFrame:
    """Add (start, end, value) of each match of the column ``text``, in code points.

    A match ends where the lengths of all gaps and matches up to it end.  Lengths are added
    up in blocks: a match adds those of its block to the sum before the block, so no
    array grows element by element and a text of very many matches takes time in
    proportion.  Each step is a column of its own, so it is computed once.
    """
    text, n = F.col("text"), F.size(f"_{name}_m")
    numbers = F.array().cast("array<int>")
    lengths, sums, begins = (f"_{name}_{part}" for part in ("l", "s", "b"))
    steps = {
        f"_{name}_m": F.when(gate, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>")),
        lengths: F.when(
            n > 0,
            F.zip_with(
                F.col(f"_{name}_m"),
                F.split(text, pattern, -1),
                lambda m, gap: F.coalesce(F.length(m), F.lit(0)) + F.length(gap),
            ),
        ).otherwise(numbers),
        sums: F.when(
            n > 0,
            F.transform(F.sequence(F.lit(1), n, F.lit(_BLOCK)), lambda at: _sum(F.slice(lengths, at, F.lit(_BLOCK)))),
        ).otherwise(numbers),
        begins: F.transform(sums, lambda _, i: _sum(F.slice(sums, F.lit(1), i))),
    }
    for column, value in steps.items():
        rows = rows.withColumn(column, value)

    def end(i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        return F.get(begins, block) + _sum(F.slice(lengths, block * _BLOCK + 1, i - block * _BLOCK + 1))

    ends = F.transform(f"_{name}_m", lambda m, i: F.struct(end(i).alias("end"), m.alias("value")))
    spans = F.transform(
        ends, lambda x: F.struct((x["end"] - F.length(x["value"])).alias("start"), x["end"].alias("end"), x["value"].alias("value"))
    )
    return rows.withColumn(name, spans).drop(*steps)


def _entity(kind: str, value: Column) -> Column:
    same = {"email": F.lower(value), "ip": value}.get(kind, _digits(value))
    return F.concat(F.lit(f"{kind}:"), same)


def _words(text: Column) -> Column:
    """The distinct words of a text, without those of its e-mail addresses."""
    bare = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(bare), F.lit(TERM), F.lit(0)))


def _checked(kind: str) -> Column:
    return F.filter(f"raw_{kind}", lambda m: _valid(kind, m["value"]))


def _spans(matches: str, kind: str) -> Column:
    """Spans with the share that a term discloses, which patterns do not have."""
    rank = KINDS.index(kind)
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.lit(None).cast("double").alias("ratio"),
        ),
    )


def _entities(kind: str) -> Column:
    return F.transform(f"is_{kind}", lambda m: _entity(kind, m["value"]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, entities, text): spans of the patterns, the distinct entities, and
    the text of the rows that have any."""
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", content.alias("text"))
    for kind, pattern in PATTERNS.items():
        hint = HINTS.get(kind)
        gate = F.contains("text", F.lit(hint)) if hint else F.col("text").rlike("[0-9]")
        rows = _with_matches(rows, f"raw_{kind}", F.lit(pattern), gate)
    for kind in PATTERNS:
        rows = rows.withColumn(f"is_{kind}", _checked(kind))
    spans = [_spans(f"is_{kind}", kind) for kind in PATTERNS]
    entities = [_entities(kind) for kind in PATTERNS]
    return (
        rows.select(
            "doc_id",
            "text",
            F.array_sort(F.concat(*spans)).alias("base"),
            F.array_distinct(F.concat(*entities)).alias("entities"),
        )
        .select("doc_id", "base", "entities", F.when(F.size("base") > 0, F.col("text")).alias("text"))
    )


# A row of the scan is known by its file and its place in it, the same on every read.
ROW = ("file", "place")


def _rows(found: DataFrame) -> DataFrame:
    return found.withColumns({"file": F.xxhash64("_metadata.file_name"), "place": F.col("_metadata.row_index")})


def entity_classes(found: DataFrame) -> DataFrame:
    """(entity, class, df_e): entities of the same rows have one class.

    The class is the number of rows and two sums of parts of a 64-bit hash over them.
    """
    h = F.xxhash64(*ROW)
    sums = [F.sum(F.shiftrightunsigned(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    n = F.count(F.lit(1))
    return (
        _rows(found)
        .select(*ROW, F.explode("entities").alias("entity"))
        .groupBy("entity")
        .agg(F.concat_ws(":", n, *sums).alias("class"), n.alias("df_e"))
    )


def class_mentions(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(file, place, class, df_e), one row for each row and class of its entities."""
    seen = _rows(found).select(*ROW, F.explode("entities").alias("entity"))
    return seen.join(classes, "entity").select(*ROW, "class", "df_e").distinct()


def terms_of_classes(docs: DataFrame, found: DataFrame, mentions: DataFrame) -> DataFrame:
    """(class, term, ratio) of the terms that reveal the entities of a class.

    A ratio of ``GENERALISE`` bounds a term's document frequency by the entity's, as a pair
    is in no more documents than its entity.  Only words that pass this for some class of
    their row are paired; pairs are combined before they are shuffled.
    """
    n = float(max(docs.count(), 1))
    p = F.col("df_e") / F.lit(n)
    at_most = ((F.col("df_e") + PRIOR * p) / F.pow(p, F.lit(1 - GENERALISE)) - PRIOR) * (1 + 1e-9)
    bounded = mentions.withColumn("at_most", at_most)
    # Counted before the join: a frequent word is one row per task.
    hashes = F.transform(_words(F.coalesce("text", F.lit(""))), lambda w: F.xxhash64(w))
    df = docs.select(F.explode(hashes).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df_t"))
    most = bounded.agg(F.max("at_most")).first()[0] or 0.0
    df = df.filter(F.col("df_t") <= most)
    terms = (
        _rows(found)
        .filter(F.size("entities") > 0)
        .select(*ROW, F.explode(_words(F.col("text"))).alias("term"))
        .withColumn("h", F.xxhash64("term"))
        .join(df, "h")
        .groupBy(*ROW)
        .agg(F.collect_list(F.struct("term", "df_t")).alias("terms"))
    )
    pairs = (
        bounded.join(terms, [*ROW])
        .select("class", "df_e", F.explode(F.filter("terms", lambda t: t["df_t"] <= F.col("at_most"))).alias("t"))
        .groupBy("class", "t.term")
        .agg(F.count(F.lit(1)).alias("df_et"), F.any_value("df_e").alias("df_e"), F.any_value("t.df_t").alias("df_t"))
    )
    given = (F.col("df_et") + PRIOR * p) / (F.col("df_t") + PRIOR)
    return (
        pairs.withColumn("ratio", F.when(p < 1, F.log2(given / p) / F.log2(1 / p)))
        .filter(F.col("ratio") >= GENERALISE)
        .select("class", "term", "ratio")
    )


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term, ratio) of the terms that reveal an entity; ``found`` is a stored scan."""
    classes = stored(entity_classes(found), "pii-entities")
    flagged = terms_of_classes(docs, found, class_mentions(found, classes))
    return classes.join(flagged, "class").select("entity", "term", "ratio")


def all_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans, text): the spans of the method added, each term with the
    greatest share that it discloses of an entity of its row."""
    found = stored(scan(docs), "pii-scan")
    classes = stored(entity_classes(found), "pii-entities")
    mentions = stored(class_mentions(found, classes), "pii-mentions")
    of_row = (
        mentions.join(terms_of_classes(docs, found, mentions), "class")
        .groupBy(*ROW, "term")
        .agg(F.max("ratio").alias("ratio"))
    )
    of_row = stored(of_row, "pii-terms")
    # Words are looked up by a join, and their places are running sums of lengths: time
    # follows the words, however many are hidden.
    rows = _rows(found)
    texts = rows.select(*ROW, "text").join(of_row.select(*ROW).distinct(), [*ROW], "left_semi")
    pieces = F.arrays_zip(
        F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("m"), F.split("text", F.lit(TERM), -1).alias("gap")
    )
    so_far = Window.partitionBy(*ROW).orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.coalesce(F.length("value"), F.lit(0))
    located = (
        texts.select(*ROW, F.posexplode_outer(pieces).alias("nth", "piece"))
        .select(*ROW, "nth", F.col("piece.m").alias("value"), F.length("piece.gap").alias("gap"))
        .withColumn("end", F.sum(F.col("gap") + length).over(so_far).cast("int"))
        .select(*ROW, F.lower("value").alias("term"), (F.col("end") - length).alias("start"), "end")
        .join(of_row, [*ROW, "term"])
        .select(
            *ROW,
            F.struct(
                "start",
                F.lit(KINDS.index(TERM_KIND)).alias("rank"),
                "end",
                F.lit(TERM_KIND).alias("kind"),
                "ratio",
            ).alias("span"),
        )
        .groupBy(*ROW)
        .agg(F.collect_list("span").alias("located"))
    )
    spans = F.when(F.col("located").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "located")))
    return rows.join(located, [*ROW], "left").select("doc_id", "base", spans.alias("spans"), "text")


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row that had something to hide, with it hidden.

    Where spans overlap the first one stands for all.
    """
    text = F.col("text")

    def tag(s: Column) -> Column:
        out = F.when(s["ratio"] >= REMOVE, F.lit("")).otherwise(F.lit("[TERM]"))
        for kind, name in TAGS.items():
            out = F.when(s["kind"] == kind, F.lit(name)).otherwise(out)
        return out

    hidden = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), tag(s)).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    rows = all_spans(docs).filter(F.size("spans") > 0)
    return rows.select("doc_id", hidden.alias("text"))


def sanitise_digest(docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return all_spans(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )
