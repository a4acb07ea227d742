"""Quality rules learned as an ordered decision list.

Sequential covering: on labelled documents a rule is grown condition by condition
(FOIL gain), pruned on rows kept aside, and what it covers is taken out before the
next rule.  The list becomes one conditional Spark expression.  Everything is
built-in expressions; learning asks for counts per (feature, bin) and sees nothing
else of the rows.

The list is fitted on at most ``MAX_LABELLED`` labelled documents, the ones with the
smallest hashes; features and verdicts cover every document.

Defined cases: null text has no words and fails the base rule; a null feature (a
share of nothing) meets no condition; labels without document, or with null id or
value, are not used; an id labelled twice counts for both; without labels of both
kinds there are no rules and only the base rule rejects; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.frames import BLANKS, WORD, fresh, stored

MAX_LABELLED = 20_000
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 3
# A rule must be right about this share of the documents that it rejects.
MIN_PRECISION = 0.97
# and reject so many of the rows kept aside.
MIN_COVERED = 3
# Windows are hashed by doubling, so this is fixed.
WINDOW_WORDS = 8

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_distinct",
]


def with_measures(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """Add the measures of each whole text, and say under which names.

    Repeats are found within the row: windows are hashed to 64 bits, and only texts
    in which a hash occurs twice are looked at closely.  Nothing is shuffled.
    """
    names = dict(zip(MEASURES, fresh(docs, *[f"_q_{m}" for m in MEASURES]), strict=True))
    tmp = fresh(docs, "_words", "_hashes", "_pairs", "_fours", "_windows", "_lines")
    words, hashes, pairs, fours, windows, lines = tmp
    content = F.coalesce(F.col(text), F.lit(""))

    def count_of(chars: str) -> Column:
        return F.regexp_count(content, F.lit(f"[{chars}]")).cast("long")

    def with_next(array: str, step: int) -> Column:
        """Each element hashed with the one ``step`` later: 2, 4, then 8 words."""
        later = F.slice(F.col(array), step + 1, F.size(array))
        return F.zip_with(F.col(array), later, lambda a, b: F.xxhash64(a, b))

    with_word = F.filter(F.split(content, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    n_windows = F.greatest(F.lit(0), F.size(words) - (WINDOW_WORDS - 1))
    # Windows by hash, then position: neighbours of equal hash are the repeats.
    by_hash = F.array_sort(F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.array_sort(
        F.transform(
            F.filter(
                F.zip_with(
                    by_hash,
                    F.zip_with(
                        F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(by_hash, 1, F.size(windows) - 1)),
                        F.concat(F.slice(by_hash, 2, F.size(windows)), F.array(F.lit(None).cast("struct<h:bigint,i:int>"))),
                        lambda a, b: F.struct(a["h"].alias("a"), b["h"].alias("b")),
                    ),
                    lambda x, y: F.struct(
                        x["i"].alias("i"),
                        (F.coalesce(x["h"] == y["a"], F.lit(False)) | F.coalesce(x["h"] == y["b"], F.lit(False))).alias("twice"),
                    ),
                ),
                lambda z: z["twice"],
            ),
            lambda z: z["i"],
        )
    )
    # Each repeated window adds the words that the one before has not covered.
    covered = F.aggregate(
        repeated,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + WINDOW_WORDS - F.greatest(F.lit(0), acc["end"] - i)).cast("long").alias("n"),
            (i + WINDOW_WORDS).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    out = (
        docs.withColumns(
            {words: F.regexp_extract_all(content, F.lit(WORD), F.lit(0)), lines: with_word}
        )
        .withColumn(hashes, F.transform(F.col(words), lambda w: F.xxhash64(w)))
        .withColumn(pairs, with_next(hashes, 1))
        .withColumn(fours, with_next(pairs, 2))
        .withColumn(windows, F.slice(with_next(fours, 4), F.lit(1), n_windows))
        .withColumns(
            {
                names["n_words"]: F.size(words).cast("long"),
                names["word_chars"]: (F.length(content) - count_of(r"\x20\x09-\x0D")).cast("long"),
                names["n_symbols"]: count_of("#*$%&|<>"),
                names["n_lines"]: F.size(lines).cast("long"),
                names["n_dup_lines"]: (F.size(lines) - F.size(F.array_distinct(F.col(lines)))).cast("long"),
                names["n_repeat_words"]: F.when(
                    F.size(F.array_distinct(F.col(windows))) < F.size(windows), covered
                ).otherwise(F.lit(0).cast("long")),
                names["n_upper"]: count_of("A-Z"),
                names["n_digits"]: count_of("0-9"),
                names["n_marks"]: count_of("!?.,;:"),
                names["n_distinct"]: F.size(F.array_distinct(F.col(hashes))).cast("long"),
            }
        )
        .drop(*tmp)
    )
    return out, names


def features(names: dict[str, str]) -> dict[str, Column]:
    """What conditions compare: the measures as shares, whatever the length."""
    c = {m: F.col(n) for m, n in names.items()}

    def share(part: str, of: str) -> Column:
        return F.when(c[of] > 0, c[part] / c[of])

    return {
        "words": c["n_words"].cast("double"),
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_char": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
        # Distinct words grow slower than words; their logarithms do not.
        "distinct_share": F.when(c["n_words"] > 1, F.log(c["n_distinct"]) / F.log(c["n_words"])),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def on(self, value: Column) -> Column:
        met = value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)
        return F.coalesce(met, F.lit(False))


Rule = tuple[Condition, ...]


def _met(rule: Rule, value) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.on(value(condition.feature))
    return out


def _foil_gain(p: float, n: float, before: float) -> float:
    return p * (math.log2(p / (p + n)) - before) if p else 0.0


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cuts the value has reached."""
    return F.size(F.filter(F.array(*[F.lit(t) for t in cuts]), lambda t: t <= value))


def _met_by_bins(rule: Rule, cuts: dict[str, list[float]]) -> Column:
    """``_met`` for rows whose features are bins: the same conditions, as numbers."""
    out = F.lit(True)
    for c in rule:
        nth = cuts[c.feature].index(c.threshold) + 1
        met = F.col(c.feature) >= nth if c.at_least else F.col(c.feature) < nth
        out = out & F.coalesce(met, F.lit(False))
    return out


def _best_condition(rows: DataFrame, names: list[str], cuts: dict[str, list[float]], had: Rule):
    """The condition of most gain, from counts per feature and bin."""
    bins = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in names])
    counts = (
        rows.select("bad", F.explode(bins).alias("b"))
        .groupBy("b.f", "b.bin")
        .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
        .collect()
    )
    total_p = sum(r["p"] for r in counts if r["f"] == names[0])
    total_n = sum(r["n"] for r in counts if r["f"] == names[0])
    if not total_p or not total_n:
        return None
    before = math.log2(total_p / (total_p + total_n))
    best = None
    for f in sorted(names):
        by_bin = {r["bin"]: (r["p"], r["n"]) for r in counts if r["f"] == f and r["bin"] is not None}
        for j, t in enumerate(cuts[f], start=1):
            low = [sum(v[k] for b, v in by_bin.items() if b < j) for k in (0, 1)]
            high = [sum(v[k] for b, v in by_bin.items() if b >= j) for k in (0, 1)]
            for at_least, (p, n) in ((True, high), (False, low)):
                condition = Condition(f, at_least, t)
                gain = _foil_gain(p, n, before)
                if condition not in had and gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, condition, n)
    return best


def learn_rules(labelled: DataFrame, max_rules: int = MAX_RULES) -> list[Rule]:
    """Rules that reject, in order, from rows with ``bad``, ``aside`` and features.

    Features are cut into bins once; every step then reads a narrow stored table.
    """
    names = [c for c in labelled.columns if c not in ("bad", "aside")]
    steps = [i / BINS for i in range(1, BINS)] + [0.99, 0.995, 0.999]
    found = labelled.agg(
        *[F.percentile(F.when(F.col("bad") == kind, F.col(f)), F.array(*[F.lit(s) for s in steps])).alias(f"{f}:{kind}")
          for f in names for kind in (True, False)]
    ).first()
    cuts = {f: sorted({v for k in (True, False) for v in (found[f"{f}:{k}"] or []) if v is not None}) for f in names}
    names = [f for f in names if cuts[f]]
    if not names:
        return []
    binned = [F.when(F.col(f).isNotNull(), _bin(F.col(f), cuts[f])).alias(f) for f in names]
    rest = stored(labelled.select("bad", "aside", *binned), "quality-bins")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule: Rule = ()
        grown = rest.filter(~F.col("aside"))
        while len(rule) < MAX_CONDITIONS:
            best = _best_condition(grown.filter(_met_by_bins(rule, cuts)), names, cuts, rule)
            if best is None:
                break
            rule = (*rule, best[1])
            if best[2] == 0:
                break
        if not rule:
            break
        shorter = [rule[:k] for k in range(1, len(rule) + 1)]
        # All prunings are judged in one pass over the rows kept aside.
        said = (
            rest.filter("aside")
            .agg(
                *[F.count_if(_met_by_bins(r, cuts) & F.col("bad")).alias(f"p{k}") for k, r in enumerate(shorter)],
                *[F.count_if(_met_by_bins(r, cuts) & ~F.col("bad")).alias(f"n{k}") for k, r in enumerate(shorter)],
            )
            .first()
        )
        scored = [
            ((said[f"p{k}"] - said[f"n{k}"]) / max(1, said[f"p{k}"] + said[f"n{k}"]), said[f"p{k}"], -k)
            for k in range(len(shorter))
        ]
        worth, right, k = max(scored)
        rule = shorter[-k]
        if (worth + 1) / 2 < MIN_PRECISION or right < MIN_COVERED:
            break
        rules.append(rule)
        rest = rest.filter(~_met_by_bins(rule, cuts))
    return rules


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """The rules for rejecting documents of quality 0."""
    wanted = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .select(F.col("doc_id").alias("_id"), (F.col("quality") == 0).alias("bad"))
        .orderBy(F.xxhash64("_id"), "_id", "bad")
        .limit(max_labelled)
    )
    # At most max_labelled narrow rows, so this broadcast has a bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("_id"))
    measured, names = with_measures(rows.select("doc_id", "text", "bad"))
    parts = features(names)
    return learn_rules(
        stored(
            measured.select(
                "bad",
                (F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(3)) == 0).alias("aside"),
                *[v.alias(f) for f, v in parts.items()],
            ),
            "quality-labelled",
        )
    )


def verdict(rules: list[Rule], names: dict[str, str]) -> Column:
    """The decision list: the first rule that holds rejects, else the row is kept."""
    parts = features(names)
    out = None
    for rule in rules:
        met = _met(rule, parts.__getitem__)
        out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed(names: dict[str, str]) -> Column:
    words, repeats = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (words < 20) | (100 * repeats > 30 * words)


def judged(docs: DataFrame, rules: list[Rule]) -> tuple[DataFrame, dict[str, str], Column, Column]:
    out, names = with_measures(docs)
    failed = base_failed(names)
    return out, names, failed, ~failed & verdict(rules, names)


def with_verdict(docs: DataFrame, rules: list[Rule]) -> tuple[DataFrame, str]:
    """The documents with one boolean column more, and its name."""
    out, _, _, kept = judged(docs, rules)
    (passes,) = fresh(docs, "_passes")
    return out.select(*docs.columns, kept.alias(passes)), passes


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they are.

    Verdicts are written with the rows and the filter reads them there.  A filter in
    the same plan would be pushed below the measures and compute each of them again
    for every condition that mentions it.
    """
    judged_rows, passes = with_verdict(docs, fit(docs, labels))
    return stored(judged_rows, "quality-verdicts").filter(F.col(passes)).select(*docs.columns)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out, names, failed, kept = judged(docs.select("doc_id", "text"), fit(docs, labels))
    base = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(
        "doc_id",
        F.col(names["n_words"]).alias("n_words"),
        *[F.col(names[b]).alias(b) for b in base],
        failed.alias("base_failed"),
        kept.alias("kept"),
    )
