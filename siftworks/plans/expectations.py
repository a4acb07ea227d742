"""The self-check of a cleaning run: expected against actual counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.functions.text import has_decimal_suffix, is_padded
from siftworks.operators.rules import Rule, any_violated
from siftworks.plans.cleaning import (
    blanks_to_null,
    deduplicated,
    fixed_codes,
    parsed_times,
    standard_text,
)


def _lines(df: DataFrame, measures: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """All measures in one aggregate, as (check, expected, actual) lines."""
    wanted = [(check, side, m) for check, sides in measures.items() for side, m in sides.items()]
    row = df.agg(*[m.cast("bigint").alias(f"m{i}") for i, (_, _, m) in enumerate(wanted)])
    found = {(check, side): f"m{i}" for i, (check, side, _) in enumerate(wanted)}

    def value(check: str, side: str) -> Column:
        name = found.get((check, side))
        return (F.col(name) if name else F.lit(None).cast("bigint")).alias(side)

    lines = [
        F.struct(F.lit(check).alias("check"), value(check, "expected"), value(check, "actual"))
        for check in measures
    ]
    return row.select(F.inline(F.array(*lines)))


def _values(column: str) -> Column:
    return F.count_distinct(column) + F.coalesce(
        F.max(F.col(column).isNull().cast("int")), F.lit(0)
    )


def expectation_report(
    raw: DataFrame,
    order_by: Sequence[str],
    row_id: str,
    rules: Sequence[Rule],
    key: DataFrame,
    expected_rows: DataFrame | None = None,
) -> DataFrame:
    """Per check: the count that the answer key calls for, the count that cleaning
    arrives at, and whether they agree.

    ``raw`` is the raw feed and ``key`` its answer key, as they are read from files;
    ``expected_rows`` has the number of rows that the feed ought to have, where it is
    known.  What one check expects may be made up of several counts, such as the rows
    read less the duplicates in the key: they are added.
    """
    names = [r.name for r in rules]
    error = F.col("error_type")
    entries = lambda kind: F.count_if(error == kind)
    n, none = F.count(F.lit(1)), F.lit(0)
    deduplicated_rows = [
        "rows after deduplication",
        "distinct attendances after deduplication",
        "clean rows",
    ]
    from_key = {
        "arrivals missing after parsing": entries("missing_arrival_time"),
        "departures missing after parsing": entries("missing_departure_time"),
        "codes flagged missing": entries("missing_gp_code"),
        "codes flagged malformed": entries("malformed_gp_code"),
        **{check: -entries("duplicate_row") for check in deduplicated_rows},
    }
    from_rejects = {
        "clean rows": -n,
        "quarantined rows": n,
        **{f"rows failing {r}": F.count_if(F.array_contains("kinds", r)) for r in names},
    }
    from_rows = {
        "padded complaints after trimming": none,
        "complaint values, missing included": F.lit(len(a.COMPLAINTS) + 1),
        "disposition values, missing included": F.lit(len(a.DISPOSITIONS) + 1),
        "complaints outside the list": none,
        "triage codes ending in .0": none,
        "complaints missing after filling": none,
        "dispositions missing after filling": none,
        **{check: n for check in deduplicated_rows},
    }
    complaint = F.col("presenting_complaint")
    cased = F.col("_complaint")
    before_dedupe = {
        "padded complaints after trimming": F.count_if(is_padded(cased)),
        "complaint values, missing included": _values("_complaint"),
        "disposition values, missing included": _values("_disposition"),
        "complaints outside the list": F.count_if(~cased.isin(*a.COMPLAINTS)),
        "arrivals missing after parsing": F.count_if(F.col("arrival_time").isNull()),
        "departures missing after parsing": F.count_if(F.col("departure_time").isNull()),
        "triage codes ending in .0": F.count_if(has_decimal_suffix(F.col("triage_category"))),
        "codes flagged missing": F.count_if(F.col("gp_code_flag") == "missing"),
        "codes flagged malformed": F.count_if(F.col("gp_code_flag") == "malformed"),
        "complaints missing after filling": F.count_if(complaint.isNull()),
        "dispositions missing after filling": F.count_if(F.col("disposition").isNull()),
    }
    after_dedupe = {
        "rows after deduplication": n,
        "distinct attendances after deduplication": F.count_distinct(a.KEY),
        "clean rows": F.count_if(~any_violated(rules)),
        "quarantined rows": F.count_if(any_violated(rules)),
        **{f"rows failing {r.name}": F.count_if(r.violated()) for r in rules},
    }
    if expected_rows is not None:
        before_dedupe["rows read"] = n
    cleaned = (
        raw.transform(blanks_to_null)
        .transform(standard_text)
        .withColumns({"_complaint": complaint, "_disposition": F.col("disposition")})
        .transform(parsed_times)
        .transform(fixed_codes)
    )
    kept = deduplicated(cleaned, order_by, row_id)
    rejects = key.filter(error.isin(*names)).groupBy(a.KEY).agg(F.collect_set(error).alias("kinds"))

    def side(name: str, measures: Mapping[str, Column]) -> dict[str, dict[str, Column]]:
        return {check: {name: m} for check, m in measures.items()}

    both = {
        check: {
            **({"expected": from_rows[check]} if check in from_rows else {}),
            **({"actual": before_dedupe[check]} if check in before_dedupe else {}),
        }
        for check in {**from_rows, **before_dedupe}
    }
    lines = [
        _lines(cleaned, both),
        _lines(kept, side("actual", after_dedupe)),
        _lines(key, side("expected", from_key)),
        _lines(rejects, side("expected", from_rejects)),
    ]
    if expected_rows is not None:
        only = expected_rows.columns[0]
        lines.append(_lines(expected_rows, side("expected", {"rows read": F.max(only)})))
    return (
        reduce(DataFrame.unionByName, lines)
        .groupBy("check")
        .agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
        .withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))
    )
