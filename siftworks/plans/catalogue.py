"""Every registered query: a name and a function of (session, data folder).

All of them read the given tables; the attendance queries read ``events`` and
derive the messy feed from all of its rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import attendance as a
from siftworks.functions import moments, text
from siftworks.operators import (
    dedupe,
    faults,
    history,
    kpi,
    lookup,
    normalise,
    numbering,
    profile,
    reconcile,
    report,
    rollup,
    rules,
    spelling,
)
from siftworks.plans import cleaning, expectations, run
from siftworks.sources import attendance_feed as feed
from siftworks.sources import tables, text_csv, versions
from siftworks.sources.answer_key import read_answer_key, write_answer_key
from siftworks.sources.work_dir import new_folder
from siftworks.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- Shared inputs ----------------------------------------------------------


def _rules(**options) -> list[rules.Rule]:
    return a.reject_rules(year=feed.FEED_YEAR, **options)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.read_feed(spark, sf_dir)


def _good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.good_attendances(feed.read_events(spark, f"{sf_dir}/events.parquet"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.checked_rows(_raw(spark, sf_dir), feed.FEED_ORDER, feed.ROW_ID)


def _tagged(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _checked(spark, sf_dir).transform(rules.tag_failures, _rules(**options))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_rows(_raw(spark, sf_dir), feed.FEED_ORDER, feed.ROW_ID, _rules())


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _reasons_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn(rules.REASONS, F.array_join(rules.REASONS, ","))


# --- Sources and sinks ------------------------------------------------------


@query
def scan_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as CSV and scanned back as text."""
    folder = new_folder(spark, "scan_csv_text")
    text_csv.write_text_csv(_raw(spark, sf_dir).select(*a.RAW_COLUMNS), folder)
    return text_csv.read_text_csv(spark, folder, a.RAW_COLUMNS)


@query
def scan_answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer key written as CSV and scanned back as text."""
    folder = new_folder(spark, "scan_answer_key")
    write_answer_key(feed.planted_faults(_raw(spark, sf_dir)), folder)
    return read_answer_key(spark, folder)


@query
def load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table, replaced whole and read back."""
    folder = new_folder(spark, "load_roundtrip")
    tables.load_table(_clean(spark, sf_dir), folder)
    return tables.read_table(spark, folder)


@query
def versioned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is replaced whole twice: what a reader of each version finds, by triage
    category, beside the rows that its manifest states."""
    folder = new_folder(spark, "versioned_load")
    checked = _checked(spark, sf_dir).select(*a.CLEAN_COLUMNS)
    versions.load(checked, folder, note="judged")
    versions.load(_clean(spark, sf_dir), folder, note="clean")
    stated = versions.history(spark, folder)
    found = [
        versions.read(spark, folder, n)
        .groupBy("triage_category")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("version", F.lit(n).cast("bigint"))
        for n in versions.numbers(spark, folder)
    ]
    return (
        reduce(DataFrame.unionByName, found)
        .join(F.broadcast(stated), "version")  # one row for each of two versions
        .select("version", "note", "triage_category", "row_count", F.col("rows").alias("table_rows"))
    )


@query
def rows_read_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full job on a feed in five folders of CSV files: the rows of each folder, as the
    one pass that cleaned them has counted and stored them."""
    folder = new_folder(spark, "rows_read_by_file")
    parts = _raw(spark, sf_dir).withColumn("part", F.pmod(F.col(feed.EVENT), F.lit(5)))
    (
        parts.select(*a.RAW_COLUMNS, "part")
        .write.partitionBy("part")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{folder}/in")
    )
    scanned = text_csv.read_text_csv(
        spark, f"{folder}/in/part=*", a.RAW_COLUMNS, corrupt_column=True, with_position=True
    )
    done = run.full_run(
        scanned,
        text_csv.SOURCE_ORDER,
        text_csv.SOURCE_ROW,
        _rules(malformed_line=text_csv.CORRUPT),
        f"{folder}/out",
    )
    part = F.regexp_extract(F.col("read_from"), "part=([0-9]+)", 1).cast("int").alias("part")
    return done.files_read().groupBy(part).agg(F.sum("rows_read").alias("rows_read"))


@query
def orders_new_against_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who order for the first time in 1998 or later: the feed of those years
    against the stored keys and Bloom filters of every month before."""
    orders = _table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp")
    month = F.date_format("o_orderdate", "yyyy-MM")
    old, new = orders.filter(F.col("o_orderdate") < cut), orders.filter(F.col("o_orderdate") >= cut)
    blocks = history.blocks_for(old.count())
    store = history.History(spark, new_folder(spark, "orders_history"), blocks)
    store.add(old, F.col("o_custkey").cast("string"), month)
    return store.new_rows(new, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


@query
def attendances_day_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in two loads: what the second holds beyond the first, whose keys are stored
    by their last two digits."""
    raw = _raw(spark, sf_dir).select(a.KEY, *dict.fromkeys([*feed.FEED_ORDER, feed.ROW_ID]), "copy")
    first, second = raw.filter(F.col("copy") == 0), raw.filter(F.col("copy") > 0)
    later = second.unionByName(first.filter(F.col(feed.ROW_ID) % 3 == 0))
    blocks = history.blocks_for(first.count())
    store = history.History(spark, new_folder(spark, "attendance_history"), blocks)
    before = first.filter(F.col(feed.ROW_ID) % 3 != 0)
    store.add(before, F.col(a.KEY), F.substring(a.KEY, -2, 2))
    kept = store.new_rows(later, [a.KEY], feed.FEED_ORDER, feed.ROW_ID)
    return kept.select(a.KEY, feed.ROW_ID)


@query
def report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as a CSV file, read back with its types."""
    folder = new_folder(spark, "report_sink")
    text_csv.write_report_csv(dq_report(spark, sf_dir), folder)
    return spark.read.csv(
        folder, header=True, schema="reason string, count bigint, pct_of_input double"
    )


# --- Projections ------------------------------------------------------------


@query
def trim_and_nullify(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, *a.RAW_COLUMNS)
    return cleaning.blanks_to_null(raw)


@query
def canonicalise_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, F.trim("disposition").alias("disposition"))
    return normalise.canonicalise(raw, {"disposition": a.DISPOSITIONS})


@query
def canonicalise_case_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result as a lookup in a dimension table."""
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, F.trim("disposition").alias("disposition"))
    spellings = spark.createDataFrame(
        [(v.lower(), v) for v in a.DISPOSITIONS], "key string, spelling string"
    )
    return lookup.lookup(
        raw, F.lower("disposition"), spellings, "key", "spelling", "spelling"
    ).select(feed.ROW_ID, F.coalesce("spelling", "disposition").alias("disposition"))


@query
def standardise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, *a.RAW_COLUMNS)
    return (
        raw.transform(cleaning.blanks_to_null)
        .transform(cleaning.standard_text)
        .select(feed.ROW_ID, "presenting_complaint", "disposition")
    )


@query
def parse_mixed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, "arrival_time", "departure_time")
    return cleaning.parsed_times(raw)


@query
def strip_decimal_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        feed.ROW_ID,
        text.strip_decimal_suffix(F.col("triage_category")).alias("triage_category"),
    )


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, "gp_practice_code")
    return normalise.markers_to_null(raw, ["gp_practice_code"], a.MISSING_MARKERS)


@query
def code_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = text.code_flag(F.col("gp_practice_code"), a.GP_CODE_PATTERN)
    return _codes(spark, sf_dir).select(feed.ROW_ID, flag.alias("gp_code_flag"))


@query
def normalise_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = text.normalised_code(F.col("gp_practice_code"), a.GP_CODE_PATTERN)
    return _codes(spark, sf_dir).select(feed.ROW_ID, code.alias("gp_practice_code"))


@query
def fill_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["presenting_complaint", "disposition"]
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, *columns)
    return raw.transform(normalise.markers_to_null, columns, a.MISSING_MARKERS).transform(
        normalise.fill_default, columns, a.UNKNOWN
    )


@query
def fix_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(feed.ROW_ID, *a.RAW_COLUMNS)
    return (
        raw.transform(cleaning.blanks_to_null)
        .transform(cleaning.fixed_codes)
        .select(
            feed.ROW_ID,
            "triage_category",
            "gp_practice_code",
            "gp_code_flag",
            "presenting_complaint",
            "disposition",
        )
    )


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_mixed_timestamps(spark, sf_dir)


@query
def duration_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = moments.minutes_between(F.col("arrival_time"), F.col("departure_time"))
    return _times(spark, sf_dir).select(feed.ROW_ID, minutes.alias("stay_minutes"))


@query
def duration_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(spark, sf_dir).select(feed.ROW_ID, kpi.stay_minutes().alias("los_minutes"))


@query
def shape_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        feed.ROW_ID,
        text.shape(F.col("arrival_time")).alias("arrival_shape"),
        text.shape(F.col("presenting_complaint")).alias("complaint_shape"),
    )


# --- Filters ----------------------------------------------------------------


@query
def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside a domain, with their rows."""
    raw = _raw(spark, sf_dir)
    return profile.frequencies(
        raw.filter(~F.col("triage_category").isin(*a.TRIAGE_CODES)), "triage_category"
    )


@query
def domain_violations_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem")
    return items.filter(~F.col("l_returnflag").isin("A", "N")).select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )


@query
def domain_violations_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order: a large domain, held in a table."""
    urgent = _table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return lookup.members(
        _table(spark, sf_dir, "customer"),
        F.col("c_custkey"),
        urgent,
        "o_custkey",
        outside=True,
    ).select("c_custkey", "c_name")


@query
def null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that miss a time or a patient after blanks became NULL."""
    wanted = ["pseudo_patient_id", "arrival_time", "departure_time"]
    df = cleaning.blanks_to_null(_raw(spark, sf_dir)).select(feed.ROW_ID, *wanted)
    missing = [F.col(c).isNull() for c in wanted]
    return df.filter(missing[0] | missing[1] | missing[2])


@query
def padding_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded values per column, before and after trimming."""
    columns = ["presenting_complaint", "disposition"]
    raw = _raw(spark, sf_dir).select(*columns)
    trimmed = {c: text.blank_to_null(F.col(c), a.MISSING_MARKERS) for c in columns}
    return raw.agg(
        *[F.count_if(text.is_padded(F.col(c))).alias(f"{c}_before") for c in columns],
        *[F.count_if(text.is_padded(trimmed[c])).alias(f"{c}_after") for c in columns],
    )


@query
def unmatched_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints outside the list, before and after their case is fixed."""
    raw = _raw(spark, sf_dir).select(F.trim("presenting_complaint").alias("raw"))
    fixed = text.canonical_case(F.col("raw"), a.COMPLAINTS)
    blank = F.lower("raw").isin(*a.MISSING_MARKERS)
    return raw.agg(
        F.count_if(~blank & ~F.col("raw").isin(*a.COMPLAINTS)).alias("unmatched_before"),
        F.count_if(~blank & ~fixed.isin(*a.COMPLAINTS)).alias("unmatched_after"),
    )


@query
def residual_suffix_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("triage_category")
    return _raw(spark, sf_dir).agg(
        F.count_if(text.has_decimal_suffix(code)).alias("suffixes_before"),
        F.count_if(text.has_decimal_suffix(text.strip_decimal_suffix(code))).alias(
            "suffixes_after"
        ),
    )


# --- Rules and quarantine ---------------------------------------------------


def _failing(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    [rule] = [r for r in _rules() if r.name == name]
    return _checked(spark, sf_dir).filter(rule.violated()).select(a.KEY, *columns)


@query
def rule_missing_arrival_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing(spark, sf_dir, "missing_arrival_time", "departure_time")


@query
def rule_missing_departure_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing(spark, sf_dir, "missing_departure_time", "arrival_time")


@query
def rule_departure_before_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing(
        spark, sf_dir, "departure_before_arrival", "arrival_time", "departure_time"
    )


@query
def rule_invalid_triage_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing(spark, sf_dir, "invalid_triage_code", "triage_category")


@query
def rule_future_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing(spark, sf_dir, "future_dated_attendance", "arrival_time")


@query
def rule_extreme_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing(
        spark, sf_dir, "extreme_length_of_stay", "arrival_time", "departure_time"
    )


@query
def rule_missing_patient_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing(spark, sf_dir, "missing_patient_id", "arrival_time")


@query
def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows with their reasons, empty text for clean ones."""
    return _reasons_as_text(_tagged(spark, sf_dir).select(a.KEY, rules.REASONS))


@query
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


@query
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantined = rules.split(_tagged(spark, sf_dir))
    return _reasons_as_text(quarantined.select(*a.CLEAN_COLUMNS, rules.REASONS))


# --- Aggregations -----------------------------------------------------------


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(cleaning.blanks_to_null(_raw(spark, sf_dir)), a.RAW_COLUMNS)


@query
def null_profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(_table(spark, sf_dir, "documents"))


@query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(*a.RAW_COLUMNS, *feed.FEED_ORDER)
    return run.stage_counts(raw, feed.FEED_ORDER, feed.ROW_ID, _rules())


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.failure_report(_checked(spark, sf_dir), _rules())


@query
def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantined = rules.split(_tagged(spark, sf_dir))
    return report.reasons_listed(quarantined)


@query
def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = text.code_flag(F.col("gp_practice_code"), a.GP_CODE_PATTERN)
    return profile.frequencies(
        _codes(spark, sf_dir).select(flag.alias("gp_code_flag")), "gp_code_flag"
    )


@query
def kpi_breach_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the registered view."""
    kpi.register_views(_clean(spark, sf_dir), a.BREACH_MINUTES)
    return spark.table("v_four_hour_breach")


@query
def kpi_stay_by_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the registered view, in order of its key."""
    kpi.register_views(_clean(spark, sf_dir), a.BREACH_MINUTES)
    return spark.table("v_los_by_triage").orderBy("triage_category")


@query
def kpi_arrivals_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the registered view, in order of its key."""
    kpi.register_views(_clean(spark, sf_dir), a.BREACH_MINUTES)
    return spark.table("v_arrivals_by_hour").orderBy("arrival_hour")


@query
def kpi_overall_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.overall_median(_clean(spark, sf_dir))


@query
def shape_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape_counts(_raw(spark, sf_dir), ["arrival_time", "departure_time"])


@query
def shape_profile_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape_counts(
        _table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"]
    )


@query
def top_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_shapes(_raw(spark, sf_dir), "presenting_complaint")


@query
def top_shapes_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_shapes(_table(spark, sf_dir, "orders"), "o_orderpriority")


@query
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaning.standard_text(cleaning.blanks_to_null(_raw(spark, sf_dir)))
    return profile.distinct_counts(df, [a.KEY, "presenting_complaint", "disposition"])


@query
def distinct_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(
        _table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag"]
    )


@query
def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_overview(_raw(spark, sf_dir).select(*a.RAW_COLUMNS))


@query
def raw_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of the feed."""
    return profile.peek(_raw(spark, sf_dir), feed.FEED_ORDER).select(*a.RAW_COLUMNS)


# --- Rollups by period ------------------------------------------------------


def _rolled_up(spark: SparkSession, made: DataFrame, purpose: str) -> DataFrame:
    folder = new_folder(spark, purpose)
    rollup.store(made, folder)
    return rollup.stored(spark, folder, made)


@query
def stay_quantiles_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of stays per month and triage code, from stored days."""
    day = F.date_format("arrival_time", "yyyy-MM-dd")
    days = rollup.value_counts(_clean(spark, sf_dir), day, kpi.stay_minutes(), "triage_category")
    month = F.substring(rollup.PERIOD, 1, 7).alias("month")
    found = rollup.quantiles(
        _rolled_up(spark, days, "stays-by-day"), [0.5, 0.9], month, "triage_category"
    )
    at = [F.round(F.col("quantiles")[i], 2).alias(name) for i, name in enumerate(["median", "p90"])]
    return found.select("month", "triage_category", "n", *at)


@query
def customers_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers with orders per year, from the stored bits of months."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    months = rollup.key_bits(_table(spark, sf_dir, "orders"), month, F.col("o_custkey"))
    year = F.substring(rollup.PERIOD, 1, 4).alias("year")
    return rollup.distinct_keys(_rolled_up(spark, months, "customers-by-month"), year)


# --- Deduplication ----------------------------------------------------------


@query
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir).select(*a.RAW_COLUMNS, *feed.FEED_ORDER)
    return dedupe.keep_first(raw, [a.KEY], feed.FEED_ORDER, feed.ROW_ID)


@query
def dedupe_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of each customer: duplicates with other payloads."""
    return dedupe.keep_first(
        _table(spark, sf_dir, "orders"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        "o_orderkey",
    )


@query
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered once and stored, as the numbers are read twice."""
    folder = new_folder(spark, "duplicate_rows")
    numbered = feed.numbered_feed(_raw(spark, sf_dir).select(a.KEY, *feed.FEED_ORDER))
    numbered.select("raw_row_number", a.KEY).write.parquet(folder)
    stored = spark.read.schema(f"raw_row_number bigint, {a.KEY} string").parquet(folder)
    return dedupe.later_occurrences(stored, a.KEY, "raw_row_number").select(
        "raw_row_number", a.KEY
    )


@query
def rows_of_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows whose key occurs more than once, first occurrences included."""
    raw = _raw(spark, sf_dir).select(a.KEY, feed.ROW_ID)
    repeated = dedupe.repeated_keys(raw, a.KEY)
    return lookup.members(raw, F.col(a.KEY), repeated, a.KEY)


@query
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_counts(_raw(spark, sf_dir), a.KEY)


# --- Reconciliation ---------------------------------------------------------


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.planted_reasons(_raw(spark, sf_dir), [r.name for r in _rules()])


def _found(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return run.found_reasons(_tagged(spark, sf_dir, **options))


@query
def reconcile_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.matched(_found(spark, sf_dir), _truth(spark, sf_dir), [a.KEY])


@query
def reconcile_false_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under rules that also reject a missing triage code, which is not a
    planted reject; under the usual rules there are none."""
    found = _found(spark, sf_dir, null_triage_fails=True)
    return reconcile.false_positives(found, _truth(spark, sf_dir), [a.KEY])


@query
def reconcile_false_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under rules that allow stays of up to 10,000 minutes; under the usual
    rules there are none."""
    found = _found(spark, sf_dir, longest_stay_minutes=10_000)
    return reconcile.false_negatives(found, _truth(spark, sf_dir), [a.KEY])


@query
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.summary(_found(spark, sf_dir), _truth(spark, sf_dir), [a.KEY])


@query
def reconcile_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _found(spark, sf_dir, null_triage_fails=True, longest_stay_minutes=10_000)
    return reconcile.by_label(found, _truth(spark, sf_dir), a.KEY, "reason")


@query
def reconcile_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders against all customers."""
    ordered = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    known = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return reconcile.summary(ordered, known, ["custkey"])


# --- Fault injection --------------------------------------------------------


def _damaged(df: DataFrame, planted: list[faults.Fault], *columns: str) -> DataFrame:
    """All rows after one kind of damage, and which fault each carries."""
    return (
        df.transform(faults.inject, planted)
        .transform(faults.log_faults, planted)
        .select(
            feed.EVENT, *columns, F.array_join("planted.error_type", ",").alias("planted")
        )
    )


def _good_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.as_text(_good(spark, sf_dir), mixed_formats=False)


@query
def inject_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c for c in a.RAW_COLUMNS if c not in (a.KEY, "triage_category")]
    return _damaged(_good_text(spark, sf_dir), feed.MISSING_FAULTS, *columns)


@query
def inject_invalid_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged(_good_text(spark, sf_dir), feed.INVALID_CODE_FAULTS, "triage_category")


@query
def inject_malformed_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged(
        _good_text(spark, sf_dir), feed.MALFORMED_CODE_FAULTS, "gp_practice_code"
    )


@query
def inject_mixed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.as_text(_good(spark, sf_dir)).select(
        feed.EVENT, "arrival_time", "departure_time"
    )


@query
def inject_decimal_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged(
        _good_text(spark, sf_dir), feed.DECIMAL_SUFFIX_FAULTS, "triage_category"
    )


@query
def inject_lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged(_good_text(spark, sf_dir), feed.LOWERCASE_FAULTS, "gp_practice_code")


@query
def inject_text_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged(
        _good_text(spark, sf_dir), feed.TEXT_FAULTS, "presenting_complaint", "disposition"
    )


@query
def inject_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and their copies, appended by a union."""
    good = faults.append_copies(_good_text(spark, sf_dir), feed.COPIED_ROWS)
    return good.select(feed.EVENT, *a.RAW_COLUMNS, "copy")


def _times_damaged(spark: SparkSession, sf_dir: str, planted: list[faults.Fault]) -> DataFrame:
    return _damaged(_good(spark, sf_dir), planted, "arrival", "departure")


@query
def inject_negative_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times_damaged(spark, sf_dir, feed.NEGATIVE_STAY_FAULTS)


@query
def inject_extreme_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times_damaged(spark, sf_dir, feed.EXTREME_STAY_FAULTS)


@query
def inject_future_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times_damaged(spark, sf_dir, feed.FUTURE_DATE_FAULTS)


@query
def raw_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = feed.numbered_feed(_raw(spark, sf_dir).select(a.KEY, *feed.FEED_ORDER))
    return numbered.select("raw_row_number", a.KEY, feed.ROW_ID)


@query
def events_numbered_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "ts")
    folder = new_folder(spark, "events-by-time")
    return numbering.number_in_order(events, ["ts", "event_id"], "row_number", folder)


@query
def orders_numbered_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a text of few values, the last first: each value spans several ranges."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return numbering.number_in_order(
        orders,
        [F.desc("o_orderpriority"), "o_orderdate", "o_orderkey"],
        "row_number",
        new_folder(spark, "orders-by-priority"),
    ).drop("o_orderdate")


@query
def fault_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by how many structural faults they carry: at most one, but for the
    slot that is to fail two rules."""
    return faults.faults_per_row(_good(spark, sf_dir), feed.STRUCTURAL_FAULTS)


@query
def answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.planted_faults(_raw(spark, sf_dir))


@query
def fault_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries per kind of fault; the kinds need no row numbers."""
    planted = feed.with_duplicate_entry(_raw(spark, sf_dir))
    entries = planted.select(F.explode("planted.error_type").alias("error_type"))
    return profile.frequencies(entries, "error_type")


# --- Faults in given tables -------------------------------------------------


def _damaged_table(
    spark: SparkSession, sf_dir: str, table: str, key: str, planted: list[faults.Fault]
) -> DataFrame:
    """Key, damaged column and fault of all rows of a given table."""
    column = planted[0].columns[0]
    moduli = sorted({f.pick.modulus for f in planted})
    return (
        faults.with_residues(_table(spark, sf_dir, table).select(key, column), key, moduli)
        .transform(faults.inject, planted)
        .transform(faults.log_faults, planted)
        .select(key, column, F.array_join("planted.error_type", ",").alias("planted"))
    )


@query
def damaged_customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = [
        faults.Fault("lower_case", ("c_name",), faults.Pick(11, (2,)), "lower({value})"),
        faults.Fault("padded", ("c_name",), faults.Pick(13, (5, 6)), "concat(' ', {value}, '  ')"),
    ]
    return _damaged_table(spark, sf_dir, "customer", "c_custkey", planted)


@query
def damaged_order_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = [
        faults.Fault("number_only", ("o_orderpriority",), faults.Pick(17, (3,)), "left({value}, 1)"),
        faults.Fault("missing", ("o_orderpriority",), faults.Pick(7, (0,)), "NULL"),
    ]
    return _damaged_table(spark, sf_dir, "orders", "o_orderkey", planted)


@query
def damaged_document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = [
        faults.Fault("region_added", ("lang",), faults.Pick(5, (1,)), "concat({value}, '-XX')"),
        faults.Fault("upper_case", ("lang",), faults.Pick(3, (2,)), "upper({value})"),
    ]
    return _damaged_table(spark, sf_dir, "documents", "doc_id", planted)


@query
def misspelt_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market segments of all customers with a letter lost, doubled or swapped by the key,
    and the segment that each spelling was meant to be."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    at = (F.pmod(key, F.length(segment) - 1) + 1).cast("int")
    head, tail = F.substring(segment, F.lit(1), at), F.substring(segment, at + 1, F.length(segment))
    damaged = (
        F.when(F.pmod(key, F.lit(3)) == 0, F.concat(F.substring(segment, F.lit(1), at - 1), tail))
        .when(F.pmod(key, F.lit(3)) == 1, F.concat(head, F.substring(segment, at, F.lit(1)), F.lower(tail)))
        .otherwise(F.concat(head, F.lit("xyz"), tail))
    )
    customers = _table(spark, sf_dir, "customer")
    return spelling.meant(customers.select(damaged.alias("v")), "v", customers, "c_mktsegment")


@query
def customers_with_alike_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a customer's name with a character lost and the names within one edit of it."""
    customers = _table(spark, sf_dir, "customer")
    at = (F.pmod(F.col("c_custkey"), F.lit(9)) + 1).cast("int")
    name = F.col("c_name")
    lost = F.concat(F.substring(name, F.lit(1), at - 1), F.substring(name, at + 1, F.length(name)))
    return spelling.neighbours(
        customers.select(lost.alias("v")), "v", customers, "c_name", within=1, fold_case=False
    )


# --- Whole jobs -------------------------------------------------------------


@query
def cleaning_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised, deduplicated and judged rows, with all columns."""
    return _reasons_as_text(_tagged(spark, sf_dir).select(*a.CLEAN_COLUMNS, rules.REASONS))


@query
def cleaned_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean rows of the CSV feed, deduplicated by position in its files."""
    folder = new_folder(spark, "cleaned_from_csv")
    text_csv.write_text_csv(_raw(spark, sf_dir).select(*a.RAW_COLUMNS), folder)
    scanned = text_csv.read_text_csv(
        spark, folder, a.RAW_COLUMNS, corrupt_column=True, with_position=True
    )
    return cleaning.clean_rows(
        scanned,
        text_csv.SOURCE_ORDER,
        text_csv.SOURCE_ROW,
        _rules(malformed_line=text_csv.CORRUPT),
    )


@query
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as lines of text, some cut short and some with a field too many,
    through the full job: outcome and reasons per row, malformed lines whole."""
    folder = new_folder(spark, "malformed_lines")
    fields = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in a.RAW_COLUMNS])
    raw = _raw(spark, sf_dir)
    line = (
        F.when(F.col("_mod_97").isin(50, 51), F.concat(fields, F.lit(",one more")))
        .when(F.col("_mod_97") == 52, F.regexp_replace(fields, ",[^,]*,[^,]*$", ""))
        .otherwise(fields)
    )
    raw.select(line.alias("value")).write.text(f"{folder}/in")
    scanned = text_csv.read_text_csv(
        spark, f"{folder}/in", a.RAW_COLUMNS, corrupt_column=True, with_position=True, header=False
    )
    done = run.full_run(
        scanned,
        text_csv.SOURCE_ORDER,
        text_csv.SOURCE_ROW,
        _rules(malformed_line=text_csv.CORRUPT),
        f"{folder}/out",
    )
    return _reasons_as_text(
        done.outcomes().select(a.KEY, "outcome", rules.REASONS, F.col("original.line").alias("line"))
    )


def _run(spark: SparkSession, sf_dir: str, purpose: str) -> run.Run:
    return run.full_run(
        _raw(spark, sf_dir),
        feed.FEED_ORDER,
        feed.ROW_ID,
        _rules(),
        new_folder(spark, purpose),
        _truth(spark, sf_dir),
    )


@query
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the reconciliation of a whole stored run."""
    done = _run(spark, sf_dir, "full_run")
    counts = done.stage_counts()
    checked = spark.read.parquet(f"{done.folder}/reconciliation")
    as_lines = [
        df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("measure"), F.col(c).alias("value"))
                        for c in df.columns
                    ]
                )
            )
        )
        for df in (counts, checked)
    ]
    return as_lines[0].unionByName(as_lines[1])


@query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in and out of the stages; the seconds stay in the stored table."""
    done = _run(spark, sf_dir, "run_metrics")
    stages = spark.read.parquet(done.metrics_path).filter(F.col("rows_in").isNotNull())
    return stages.select("stage", "rows_in", "rows_out")


@query
def expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the two files that a job is given: the raw feed and its answer key."""
    folder = new_folder(spark, "expectation_report")
    messy = _raw(spark, sf_dir)
    text_csv.write_text_csv(messy.select(*a.RAW_COLUMNS), f"{folder}/raw")
    write_answer_key(feed.planted_faults(messy), f"{folder}/key")
    events = feed.read_events(spark, f"{sf_dir}/events.parquet")
    copied = F.when((F.col(feed.EVENT) % 97).isin(40, 41), 2).otherwise(1)
    return expectations.expectation_report(
        text_csv.read_text_csv(spark, f"{folder}/raw", a.RAW_COLUMNS, with_position=True),
        text_csv.SOURCE_ORDER,
        text_csv.SOURCE_ROW,
        _rules(),
        read_answer_key(spark, f"{folder}/key"),
        events.agg(F.sum(copied).cast("bigint").alias("rows")),
    )


@query
def arrivals_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as landed CSV files, cleaned by the streaming job."""
    folder = new_folder(spark, "arrivals_cleaned")
    text_csv.write_text_csv(_raw(spark, sf_dir).select(*a.RAW_COLUMNS), f"{folder}/in")
    arrivals.clean_arrivals(
        spark,
        f"{folder}/in",
        f"{folder}/out",
        f"{folder}/checkpoint",
        _rules(malformed_line=text_csv.CORRUPT),
    ).awaitTermination()
    return _reasons_as_text(
        tables.read_outcomes(spark, f"{folder}/out").select(*a.CLEAN_COLUMNS, rules.REASONS)
    )
