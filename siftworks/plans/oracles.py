"""The registered queries once more, as SQL for DuckDB.

Written from the meaning of each query and not generated from the Spark plans.
Shared parts are common table expressions that are put before a query.
"""

from __future__ import annotations

# Fixed values, spelled as SQL lists.
COMPLAINTS = (
    "['Abdominal pain', 'Chest pain', 'Shortness of breath', 'Minor injury - limb', "
    "'Head injury', 'Fall', 'Laceration / wound', 'Back pain', 'Fever', 'Headache', "
    "'Allergic reaction', 'Urinary symptoms', 'Vomiting / diarrhoea', 'Eye problem', "
    "'Rash', 'Palpitations']"
)
DISPOSITIONS = (
    "['Discharged home', 'Admitted to ward', 'Transferred to another provider', "
    "'Discharged with follow-up', 'Referred to GP', 'Left before treatment complete']"
)
MARKERS = "('', 'null', 'n/a', 'na', '-', 'none', 'nil')"
WRITTEN = "['', 'NULL', 'N/A', 'n/a', '-']"
REASONS = [
    "missing_arrival_time",
    "missing_departure_time",
    "departure_before_arrival",
    "invalid_triage_code",
    "future_dated_attendance",
    "extreme_length_of_stay",
    "missing_patient_id",
]
RAW = (
    "attendance_id, pseudo_patient_id, arrival_time, departure_time, triage_category, "
    "presenting_complaint, disposition, gp_practice_code"
)
CLEAN = RAW + ", gp_code_flag"
CODE = r"'^[A-Z][0-9]{5}$'"

# --- The feed ---------------------------------------------------------------

GOOD = f"""
good AS (
  SELECT event_id, event_id % 97 AS slot,
    printf('ATT%06d', event_id) AS attendance_id,
    printf('PSN%07d', 1000000 + user_id) AS pseudo_patient_id,
    ts AS arrival,
    ts + to_seconds((20 + (event_id * 7919) % 881) * 60 + (event_id * 31) % 60) AS departure,
    cast(1 + (event_id * 13) % 5 AS varchar) AS triage_category,
    {COMPLAINTS}[(event_id * 17) % 16 + 1] AS presenting_complaint,
    {DISPOSITIONS}[(event_id * 29) % 6 + 1] AS disposition,
    printf('E8%04d', 1000 + (user_id * 37) % 9000) AS gp_practice_code
  FROM events)"""


def _written(column: str, mixed: bool = True) -> str:
    iso = f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    if not mixed:
        return iso
    return f"""CASE WHEN (event_id * 7) % 100 < 85 THEN {iso}
      WHEN (event_id * 7) % 100 < 91 THEN strftime({column}, '%d/%m/%Y %H:%M')
      WHEN (event_id * 7) % 100 < 96 THEN strftime({column}, '%d-%b-%Y %H:%M')
      ELSE strftime({column}, '%Y-%m-%dT%H:%M:%S') END"""


NEGATIVE = (
    "CASE WHEN slot IN (3, 4) THEN arrival - to_minutes(1 + event_id // 97 * 13 % 2000) ELSE {} END"
)
EXTREME = """CASE slot WHEN 8 THEN arrival + to_minutes(2882 + (event_id * 131) % 40000)
      WHEN 25 THEN arrival + to_minutes(2880) WHEN 26 THEN arrival + to_minutes(2881)
      ELSE {} END"""
LATER = "to_years(cast(1 + event_id % 7 AS int))"
FUTURE = "CASE WHEN slot = 7 THEN {0} + " + LATER + " ELSE {0} END"

MARKER = f"{WRITTEN}[event_id % 5 + 1]"
INVALID = "['0', '6', '9', '99', 'X', '-1'][event_id % 6 + 1]"
MALFORMED = """CASE event_id // 97 % 4
      WHEN 0 THEN gp_practice_code[1:event_id % 6] || gp_practice_code[event_id % 6 + 2:]
      WHEN 1 THEN cast(event_id % 10 AS varchar) || gp_practice_code[2:]
      WHEN 2 THEN gp_practice_code[1:3] || ' ' || gp_practice_code[5:]
      ELSE gp_practice_code[1:5] || 'O' END"""


def _untidy(column: str, kind: str, value: str) -> str:
    return (
        f"CASE {kind} WHEN 0 THEN {value}[1:2] || upper({value}[3:]) "
        f"WHEN 1 THEN lower({value}[1:1]) || {value}[2:] "
        f"ELSE {value} || repeat(' ', cast(1 + event_id % 4 AS int)) END"
    )


COMPLAINT_NOISE = "event_id % 10 = 3 AND slot NOT BETWEEN 18 AND 21"
DISPOSITION_NOISE = "event_id % 12 = 5 AND slot NOT IN (22, 23)"
SUFFIX_NOISE = "event_id % 100 = 50 AND slot NOT IN (5, 6, 24, 28)"
LOWER_NOISE = "event_id % 100 = 60 AND slot NOT BETWEEN 10 AND 17"
COMPLAINT_UNTIDY = _untidy(
    "presenting_complaint", "event_id % 3", "presenting_complaint"
)
DISPOSITION_UNTIDY = _untidy("disposition", "(event_id // 12) % 3", "disposition")

FEED = f"""{GOOD},
timed AS (
  SELECT * REPLACE (
    {FUTURE.format('arrival')} AS arrival,
    CASE WHEN slot = 7 THEN departure + {LATER}
      WHEN slot IN (3, 4) THEN {NEGATIVE.format('departure')}
      ELSE {EXTREME.format('departure')} END AS departure)
  FROM good),
written AS (
  SELECT * REPLACE (
    CASE WHEN slot = 9 THEN {MARKER} ELSE pseudo_patient_id END AS pseudo_patient_id,
    CASE WHEN slot IN (5, 6, 24) THEN {INVALID} WHEN slot = 28 THEN 'N/A'
      WHEN {SUFFIX_NOISE} THEN triage_category || '.0' ELSE triage_category END
      AS triage_category,
    CASE WHEN slot BETWEEN 18 AND 21 THEN {MARKER}
      WHEN {COMPLAINT_NOISE} THEN {COMPLAINT_UNTIDY}
      ELSE presenting_complaint END AS presenting_complaint,
    CASE WHEN slot IN (22, 23) THEN {MARKER}
      WHEN {DISPOSITION_NOISE} THEN {DISPOSITION_UNTIDY}
      ELSE disposition END AS disposition,
    CASE WHEN slot BETWEEN 12 AND 17 THEN {MARKER}
      WHEN slot IN (10, 11) THEN {MALFORMED}
      WHEN {LOWER_NOISE} THEN lower(gp_practice_code)
      ELSE gp_practice_code END AS gp_practice_code),
    CASE WHEN slot IN (0, 24) THEN {MARKER} WHEN slot = 27 THEN '5/3/2024 14:30'
      ELSE {_written('arrival')} END AS arrival_time,
    CASE WHEN slot IN (1, 2) THEN {MARKER} ELSE {_written('departure')} END AS departure_time
  FROM timed),
feed AS (
  SELECT event_id, slot, copy, {RAW}, event_id * 2 + copy AS source_row,
    ((event_id % 2147483648) * 1103515245 + 12345 + copy * 7) % 2147483648 AS feed_order
  FROM written, unnest(CASE WHEN slot IN (40, 41) THEN [0, 1] ELSE [0] END) AS c(copy))"""

# --- Cleaning ---------------------------------------------------------------


def _nullified(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) IN {MARKERS} THEN NULL ELSE trim({column}) END"


def _canonical(column: str, values: str) -> str:
    return (
        f"coalesce(list_filter({values}, lambda v: lower(v) = lower({column}))[1], {column})"
    )


def _parsed(column: str) -> str:
    day, time = "[0-9]{2}", "[0-9]{2}:[0-9]{2}"
    return f"""CASE
      WHEN regexp_full_match({column}, '[0-9]{{4}}-{day}-{day} {time}:{day}')
        THEN try_strptime({column}, '%Y-%m-%d %H:%M:%S')
      WHEN regexp_full_match({column}, '{day}/{day}/[0-9]{{4}} {time}')
        THEN try_strptime({column}, '%d/%m/%Y %H:%M')
      WHEN regexp_full_match({column}, '{day}-[A-Za-z]{{3}}-[0-9]{{4}} {time}')
        THEN try_strptime({column}, '%d-%b-%Y %H:%M')
      WHEN regexp_full_match({column}, '[0-9]{{4}}-{day}-{day}T{time}:{day}')
        THEN try_strptime({column}, '%Y-%m-%dT%H:%M:%S') END"""


FLAG = (
    "CASE WHEN gp_practice_code IS NULL THEN 'missing' "
    f"WHEN NOT regexp_matches(upper(gp_practice_code), {CODE}) THEN 'malformed' END"
)
NORMAL_CODE = (
    f"CASE WHEN regexp_matches(upper(gp_practice_code), {CODE}) THEN upper(gp_practice_code) END"
)
STRIPPED = r"regexp_replace(triage_category, '\.0$', '')"

NULLIFIED = f"""{FEED},
nullified AS (
  SELECT event_id, slot, copy, source_row, feed_order,
    {', '.join(f'{_nullified(c)} AS {c}' for c in RAW.split(', '))}
  FROM feed)"""

CHECKED = f"""{NULLIFIED},
normal AS (
  SELECT event_id, slot, copy, source_row, feed_order, attendance_id, pseudo_patient_id,
    {_parsed('arrival_time')} AS arrival_time,
    {_parsed('departure_time')} AS departure_time,
    {STRIPPED} AS triage_category,
    coalesce({_canonical('presenting_complaint', COMPLAINTS)}, 'Unknown')
      AS presenting_complaint,
    coalesce({_canonical('disposition', DISPOSITIONS)}, 'Unknown') AS disposition,
    {NORMAL_CODE} AS gp_practice_code,
    {FLAG} AS gp_code_flag
  FROM nullified),
checked AS (
  SELECT * FROM normal
  QUALIFY row_number() OVER (PARTITION BY attendance_id ORDER BY feed_order, source_row) = 1)"""


def _judged(null_triage: str = "false", longest: int = 2880) -> str:
    return f"""{CHECKED},
broken AS (
  SELECT *,
    arrival_time IS NULL AS missing_arrival_time,
    departure_time IS NULL AS missing_departure_time,
    coalesce(departure_time < arrival_time, false) AS departure_before_arrival,
    coalesce(triage_category NOT IN ('1', '2', '3', '4', '5'), {null_triage})
      AS invalid_triage_code,
    coalesce(year(arrival_time) <> 2024, false) AS future_dated_attendance,
    coalesce(date_diff('second', arrival_time, departure_time) / 60 > {longest}, false)
      AS extreme_length_of_stay,
    pseudo_patient_id IS NULL AS missing_patient_id
  FROM checked),
judged AS (
  SELECT *, concat_ws(',',
    {', '.join(f"CASE WHEN {r} THEN '{r}' END" for r in REASONS)}) AS failure_reasons
  FROM broken),
clean AS (SELECT {CLEAN} FROM judged WHERE failure_reasons = ''),
stays AS (
  SELECT *, date_diff('minute', arrival_time, departure_time) AS los_minutes FROM clean)"""


JUDGED = _judged()


def _percent(part: str, total: str, digits: int) -> str:
    return (
        f"cast(round(cast(100 * ({part}) / ({total}) AS decimal(38, 10)), {digits}) AS double)"
    )


REPORT = f"""
SELECT reason, count, {_percent('count', '(SELECT count(*) FROM checked)', 2)} AS pct_of_input
FROM (SELECT unnest(string_split(failure_reasons, ',')) AS reason, count(*) AS count
      FROM judged WHERE failure_reasons <> '' GROUP BY 1)
ORDER BY count DESC, reason"""

# --- The answer key ---------------------------------------------------------

_PLANTED = [
    ("arrival_time", "missing_arrival_time", "slot IN (0, 24, 27)", "reject"),
    ("departure_time", "missing_departure_time", "slot IN (1, 2)", "reject"),
    ("departure_time", "departure_before_arrival", "slot IN (3, 4)", "reject"),
    ("triage_category", "invalid_triage_code", "slot IN (5, 6, 24)", "reject"),
    ("arrival_time", "future_dated_attendance", "slot = 7", "reject"),
    ("departure_time", "extreme_length_of_stay", "slot IN (8, 26)", "reject"),
    ("pseudo_patient_id", "missing_patient_id", "slot = 9", "reject"),
    ("gp_practice_code", "malformed_gp_code", "slot IN (10, 11)", "set to NULL and flag"),
    ("gp_practice_code", "missing_gp_code", "slot BETWEEN 12 AND 17", "set to NULL and flag"),
    (
        "presenting_complaint",
        "missing_presenting_complaint",
        "slot BETWEEN 18 AND 21",
        "fill with 'Unknown'",
    ),
    ("disposition", "missing_disposition", "slot IN (22, 23)", "fill with 'Unknown'"),
    ("triage_category", "triage_decimal_format", SUFFIX_NOISE, "fix (3.0 -> 3)"),
    ("gp_practice_code", "gp_code_lowercase", LOWER_NOISE, "fix (upper-case)"),
    (
        "presenting_complaint",
        "inconsistent_text_format",
        COMPLAINT_NOISE,
        "fix (trim spaces, standardise case)",
    ),
    (
        "disposition",
        "inconsistent_text_format",
        DISPOSITION_NOISE,
        "fix (trim spaces, standardise case)",
    ),
    (
        "arrival_time, departure_time",
        "mixed_date_format",
        "(event_id * 7) % 100 >= 85",
        "fix (parse into one timestamp format)",
    ),
    ("(entire row)", "duplicate_row", "occurrence > 1", "remove (keep first)"),
]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


KEYED = f"""{FEED},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY feed_order, source_row) AS raw_row_number,
    row_number() OVER (PARTITION BY attendance_id ORDER BY feed_order, source_row)
      AS occurrence
  FROM feed),
entries AS (
  {' UNION ALL '.join(
    f'SELECT raw_row_number, attendance_id, {_quoted(c)} AS "column", '
    f'{_quoted(e)} AS error_type, {_quoted(action)} AS expected_action '
    f'FROM numbered WHERE {where}'
    for c, e, where, action in _PLANTED)})"""

_REJECTS = ", ".join(_quoted(r) for r in REASONS)


def _pairs(null_triage: str = "false", longest: int = 2880) -> str:
    """Found and true (attendance_id, reason) pairs, and both sides of the ids."""
    planted = " UNION ALL ".join(
        f"SELECT DISTINCT attendance_id, {_quoted(e)} AS reason FROM feed WHERE {where}"
        for _, e, where, action in _PLANTED
        if action == "reject"
    )
    return f"""{_judged(null_triage, longest)},
found AS (
  SELECT attendance_id, unnest(string_split(failure_reasons, ',')) AS reason
  FROM judged WHERE failure_reasons <> ''),
truth AS ({planted}),
found_ids AS (SELECT DISTINCT attendance_id FROM found),
truth_ids AS (SELECT DISTINCT attendance_id FROM truth)"""


SUMMARY = """
SELECT (SELECT count(*) FROM truth_ids) AS truth_keys,
  (SELECT count(*) FROM found_ids) AS found_keys,
  (SELECT count(*) FROM (FROM found_ids INTERSECT FROM truth_ids)) AS matched,
  (SELECT count(*) FROM (FROM found_ids EXCEPT FROM truth_ids)) AS only_found,
  (SELECT count(*) FROM (FROM truth_ids EXCEPT FROM found_ids)) AS only_truth"""

STAGES = """
SELECT (SELECT count(*) FROM feed) AS rows_read,
  (SELECT count(*) FROM checked) AS rows_deduplicated,
  (SELECT count(*) FROM feed) - (SELECT count(*) FROM checked) AS duplicates_removed,
  (SELECT count(*) FROM clean) AS rows_clean,
  (SELECT count(*) FROM judged WHERE failure_reasons <> '') AS rows_quarantined"""


def _unpivot(select: str) -> str:
    return f"SELECT name AS measure, value FROM (UNPIVOT ({select}) ON COLUMNS(*))"


def _shape(column: str) -> str:
    return (
        f"regexp_replace(regexp_replace({column}, '[0-9]', '9', 'g'), '[A-Za-z]', 'X', 'g')"
    )


def _shapes(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_shape(c)} AS shape, count(*) AS row_count, "
        f"min({c}) AS example_value FROM {source} GROUP BY 2"
        for c in columns
    )


def _overview(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", 'string' AS type, "
        f"count(*) AS row_count, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) + max(cast({c} IS NULL AS int)) AS distinct_values FROM feed"
        for i, c in enumerate(columns, 1)
    )


def _expectations() -> str:
    """Expected counts from the slots, actual ones from the cleaned rows."""
    stray = "presenting_complaint <> trim(presenting_complaint)"
    cased = f"(SELECT {_canonical('presenting_complaint', COMPLAINTS)} AS v FROM nullified)"
    ended = f"(SELECT {_canonical('disposition', DISPOSITIONS)} AS v FROM nullified)"
    rejected = "(slot BETWEEN 0 AND 9 OR slot IN (24, 26, 27))"
    checks = [
        (
            "rows read",
            "(SELECT sum(CASE WHEN event_id % 97 IN (40, 41) THEN 2 ELSE 1 END) FROM events)",
            "(SELECT count(*) FROM feed)",
        ),
        (
            "padded complaints after trimming",
            "0",
            f"(SELECT count(*) FROM nullified WHERE {stray})",
        ),
        (
            "complaint values, missing included",
            "17",
            f"(SELECT count(*) FROM (SELECT DISTINCT v FROM {cased}))",
        ),
        (
            "disposition values, missing included",
            "7",
            f"(SELECT count(*) FROM (SELECT DISTINCT v FROM {ended}))",
        ),
        (
            "complaints outside the list",
            "0",
            f"(SELECT count(*) FROM {cased} WHERE NOT list_contains({COMPLAINTS}, v))",
        ),
        (
            "arrivals missing after parsing",
            "(SELECT count(*) FROM feed WHERE slot IN (0, 24, 27))",
            "(SELECT count(*) FROM normal WHERE arrival_time IS NULL)",
        ),
        (
            "departures missing after parsing",
            "(SELECT count(*) FROM feed WHERE slot IN (1, 2))",
            "(SELECT count(*) FROM normal WHERE departure_time IS NULL)",
        ),
        (
            "triage codes ending in .0",
            "0",
            "(SELECT count(*) FROM normal WHERE triage_category LIKE '%.0')",
        ),
        (
            "codes flagged missing",
            "(SELECT count(*) FROM feed WHERE slot BETWEEN 12 AND 17)",
            "(SELECT count(*) FROM normal WHERE gp_code_flag = 'missing')",
        ),
        (
            "codes flagged malformed",
            "(SELECT count(*) FROM feed WHERE slot IN (10, 11))",
            "(SELECT count(*) FROM normal WHERE gp_code_flag = 'malformed')",
        ),
        (
            "complaints missing after filling",
            "0",
            "(SELECT count(*) FROM normal WHERE presenting_complaint IS NULL)",
        ),
        (
            "dispositions missing after filling",
            "0",
            "(SELECT count(*) FROM normal WHERE disposition IS NULL)",
        ),
        (
            "rows after deduplication",
            "(SELECT count(*) FROM events)",
            "(SELECT count(*) FROM checked)",
        ),
        (
            "distinct attendances after deduplication",
            "(SELECT count(*) FROM events)",
            "(SELECT count(DISTINCT attendance_id) FROM checked)",
        ),
        (
            "clean rows",
            f"(SELECT count(*) FROM good WHERE NOT {rejected})",
            "(SELECT count(*) FROM clean)",
        ),
        (
            "quarantined rows",
            f"(SELECT count(*) FROM good WHERE {rejected})",
            "(SELECT count(*) FROM judged WHERE failure_reasons <> '')",
        ),
        *[
            (
                f"rows failing {e}",
                f"(SELECT count(*) FROM good WHERE {where})",
                f"(SELECT count(*) FROM judged WHERE {e})",
            )
            for _, e, where, action in _PLANTED
            if action == "reject"
        ],
    ]
    lines = " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", cast({expected} AS bigint) AS expected, "
        f"cast({actual} AS bigint) AS actual"
        for name, expected, actual in checks
    )
    return f'SELECT "check", expected, actual, expected = actual AS ok FROM ({lines})'


def _failing(rule: str, columns: str) -> str:
    return f"WITH {JUDGED} SELECT attendance_id, {columns} FROM judged WHERE {rule}"


def _damage(select: str, planted: str) -> str:
    return f"WITH {GOOD} SELECT event_id, {select}, {planted} AS planted FROM good"


def _logged(*faults: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {where} THEN '{e}' END" for e, where in faults)
    return f"concat_ws(',', {cases})"


def all_oracles() -> dict[str, str]:
    good_text = (
        f"{GOOD}, texts AS (SELECT *, {_written('arrival', False)} AS arrival_time, "
        f"{_written('departure', False)} AS departure_time FROM good)"
    )
    times = (
        f"{FEED}, times AS (SELECT source_row, {_parsed('arrival_time')} AS arrival_time, "
        f"{_parsed('departure_time')} AS departure_time FROM feed)"
    )
    trimmed = f"{FEED}, trimmed AS (SELECT source_row, trim(disposition) AS disposition FROM feed)"
    canonical = (
        f"WITH {trimmed} SELECT source_row, {_canonical('disposition', DISPOSITIONS)} "
        "AS disposition FROM trimmed"
    )
    strict_pairs = _pairs(null_triage="triage_category IS NULL")
    lenient_pairs = _pairs(longest=10_000)
    other_pairs = _pairs(null_triage="triage_category IS NULL", longest=10_000)
    return {
        # Sources and sinks
        # CSV knows no difference between empty and missing.
        "scan_csv_text": f"""WITH {FEED} SELECT
            {', '.join(f"nullif({c}, '') AS {c}" for c in RAW.split(', '))} FROM feed""",
        "scan_answer_key": f"""WITH {KEYED} SELECT
            cast(raw_row_number AS varchar) AS raw_row_number, attendance_id, "column",
            error_type, expected_action FROM entries""",
        "stay_quantiles_by_month": f"""WITH {JUDGED}
            SELECT strftime(arrival_time, '%Y-%m') AS month, triage_category, count(*) AS n,
              round(quantile_cont(los_minutes, 0.5), 2) AS median,
              round(quantile_cont(los_minutes, 0.9), 2) AS p90
            FROM stays WHERE los_minutes IS NOT NULL GROUP BY 1, 2""",
        "customers_by_year": """SELECT strftime(o_orderdate, '%Y') AS year,
              count(DISTINCT o_custkey) AS distinct_keys
            FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1""",
        "events_numbered_by_time": """SELECT event_id, ts,
            row_number() OVER (ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS row_number
            FROM events""",
        "orders_numbered_by_priority": """SELECT o_orderkey, o_orderpriority,
            row_number() OVER (ORDER BY o_orderpriority DESC NULLS LAST,
              o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS row_number
            FROM orders""",
        "misspelt_segments": """WITH v AS (
              SELECT DISTINCT CASE c_custkey % 3
                WHEN 0 THEN c_mktsegment[1:pos - 1] || c_mktsegment[pos + 1:]
                WHEN 1 THEN c_mktsegment[1:pos] || c_mktsegment[pos:pos] || lower(c_mktsegment[pos + 1:])
                ELSE c_mktsegment[1:pos] || 'xyz' || c_mktsegment[pos + 1:] END AS value
              FROM (SELECT *, c_custkey % (length(c_mktsegment) - 1) + 1 AS pos FROM customer)),
            k AS (SELECT DISTINCT c_mktsegment AS known FROM customer),
            near AS (SELECT value, known, cast(levenshtein(lower(trim(value)), lower(trim(known))) AS int) AS distance
              FROM v, k WHERE levenshtein(lower(trim(value)), lower(trim(known))) <= 2),
            best AS (SELECT * FROM near
              QUALIFY distance = min(distance) OVER (PARTITION BY value))
            SELECT value, CASE WHEN count(*) = 1 THEN min(known) END AS known, distance,
              count(*) AS candidates FROM best GROUP BY value, distance""",
        "customers_with_alike_names": """WITH v AS (
              SELECT DISTINCT c_name[1:pos - 1] || c_name[pos + 1:] AS value
              FROM (SELECT *, c_custkey % 9 + 1 AS pos FROM customer))
            SELECT DISTINCT value, c_name AS known, cast(levenshtein(value, c_name) AS int) AS distance
            FROM v, customer WHERE levenshtein(value, c_name) <= 1""",
        "versioned_load": f"""WITH {JUDGED}, loaded AS (
              SELECT 1 AS version, 'judged' AS note, triage_category FROM judged
              UNION ALL SELECT 2, 'clean', triage_category FROM clean)
            SELECT cast(version AS bigint) AS version, note, triage_category, count(*) AS row_count,
              cast(sum(count(*)) OVER (PARTITION BY version) AS bigint) AS table_rows
            FROM loaded GROUP BY version, note, triage_category""",
        "rows_read_by_file": f"""WITH {FEED}
            SELECT cast(event_id % 5 AS int) AS part, count(*) AS rows_read FROM feed GROUP BY 1""",
        "orders_new_against_history": """SELECT o_orderkey, o_custkey, o_orderdate FROM (
              SELECT * FROM orders
              QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
            WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
        "attendances_day_by_day": f"""WITH {FEED}, before AS (
              SELECT DISTINCT attendance_id FROM feed WHERE copy = 0 AND source_row % 3 <> 0)
            SELECT attendance_id, source_row FROM (
              SELECT * FROM feed WHERE copy > 0 OR source_row % 3 = 0
              QUALIFY row_number() OVER (PARTITION BY attendance_id ORDER BY feed_order, source_row) = 1)
            WHERE attendance_id NOT IN (SELECT attendance_id FROM before)""",
        "load_roundtrip": f"WITH {JUDGED} SELECT * FROM clean",
        "report_sink": f"WITH {JUDGED} {REPORT}",
        # Projections
        "trim_and_nullify": f"WITH {NULLIFIED} SELECT source_row, {RAW} FROM nullified",
        "canonicalise_case": canonical,
        "canonicalise_case_join": canonical,
        "standardise_text": f"""WITH {NULLIFIED} SELECT source_row,
            {_canonical('presenting_complaint', COMPLAINTS)} AS presenting_complaint,
            {_canonical('disposition', DISPOSITIONS)} AS disposition FROM nullified""",
        "parse_mixed_timestamps": f"WITH {times} SELECT * FROM times",
        "strip_decimal_suffix": f"""WITH {FEED}
            SELECT source_row, {STRIPPED} AS triage_category FROM feed""",
        "code_flag": f"""WITH {NULLIFIED}
            SELECT source_row, {FLAG} AS gp_code_flag FROM nullified""",
        "normalise_code": f"""WITH {NULLIFIED}
            SELECT source_row, {NORMAL_CODE} AS gp_practice_code FROM nullified""",
        "fill_default": f"""WITH {NULLIFIED} SELECT source_row,
            coalesce(presenting_complaint, 'Unknown') AS presenting_complaint,
            coalesce(disposition, 'Unknown') AS disposition FROM nullified""",
        "fix_codes": f"""WITH {NULLIFIED} SELECT source_row, {STRIPPED} AS triage_category,
            {NORMAL_CODE} AS gp_practice_code, {FLAG} AS gp_code_flag,
            coalesce(presenting_complaint, 'Unknown') AS presenting_complaint,
            coalesce(disposition, 'Unknown') AS disposition FROM nullified""",
        "duration_fractional": f"""WITH {times} SELECT source_row,
            date_diff('second', arrival_time, departure_time) / 60 AS stay_minutes
            FROM times""",
        "duration_minutes": f"""WITH {times} SELECT source_row,
            date_diff('minute', arrival_time, departure_time) AS los_minutes FROM times""",
        "shape_mask": f"""WITH {FEED} SELECT source_row,
            {_shape('arrival_time')} AS arrival_shape,
            {_shape('presenting_complaint')} AS complaint_shape FROM feed""",
        # Filters
        "domain_violations": f"""WITH {FEED}
            SELECT triage_category, count(*) AS row_count FROM feed
            WHERE triage_category NOT IN ('1', '2', '3', '4', '5') GROUP BY 1""",
        "domain_violations_lineitem": """SELECT l_orderkey, l_linenumber, l_returnflag
            FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')""",
        "domain_violations_join": """SELECT c_custkey, c_name FROM customer
            WHERE c_custkey NOT IN
              (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
        "null_check": f"""WITH {NULLIFIED}
            SELECT source_row, pseudo_patient_id, arrival_time, departure_time FROM nullified
            WHERE pseudo_patient_id IS NULL OR arrival_time IS NULL
              OR departure_time IS NULL""",
        "padding_check": f"""WITH {NULLIFIED} SELECT
            (SELECT count(*) FROM feed WHERE presenting_complaint
              <> trim(presenting_complaint)) AS presenting_complaint_before,
            (SELECT count(*) FROM feed WHERE disposition
              <> trim(disposition)) AS disposition_before,
            (SELECT count(*) FROM nullified WHERE presenting_complaint
              <> trim(presenting_complaint)) AS presenting_complaint_after,
            (SELECT count(*) FROM nullified WHERE disposition
              <> trim(disposition)) AS disposition_after""",
        "unmatched_values": f"""WITH {NULLIFIED} SELECT
            (SELECT count(*) FROM nullified
              WHERE NOT list_contains({COMPLAINTS}, presenting_complaint))
              AS unmatched_before,
            (SELECT count(*) FROM nullified
              WHERE NOT list_contains(list_transform({COMPLAINTS}, lambda v: lower(v)),
                lower(presenting_complaint))) AS unmatched_after""",
        "residual_suffix_check": f"""WITH {FEED} SELECT
            count(*) FILTER (triage_category LIKE '%.0') AS suffixes_before,
            count(*) FILTER ({STRIPPED} LIKE '%.0') AS suffixes_after FROM feed""",
        # Rules and quarantine
        "rule_missing_arrival_time": _failing("missing_arrival_time", "departure_time"),
        "rule_missing_departure_time": _failing("missing_departure_time", "arrival_time"),
        "rule_departure_before_arrival": _failing(
            "departure_before_arrival", "arrival_time, departure_time"
        ),
        "rule_invalid_triage_code": _failing("invalid_triage_code", "triage_category"),
        "rule_future_dated": _failing("future_dated_attendance", "arrival_time"),
        "rule_extreme_stay": _failing(
            "extreme_length_of_stay", "arrival_time, departure_time"
        ),
        "rule_missing_patient_id": _failing("missing_patient_id", "arrival_time"),
        "failure_reasons": f"WITH {JUDGED} SELECT attendance_id, failure_reasons FROM judged",
        "clean_rows": f"WITH {JUDGED} SELECT * FROM clean",
        "quarantined_rows": f"""WITH {JUDGED}
            SELECT {CLEAN}, failure_reasons FROM judged WHERE failure_reasons <> ''""",
        # Aggregations
        "null_profile": f"""WITH {NULLIFIED} SELECT
            {', '.join(f'count(*) - count({c}) AS {c}' for c in RAW.split(', '))}
            FROM nullified""",
        "null_profile_documents": """SELECT count(*) - count(doc_id) AS doc_id,
            count(*) - count(text) AS text, count(*) - count(lang) AS lang,
            count(*) - count(source) AS source, count(*) - count(n_chars) AS n_chars
            FROM documents""",
        "stage_counts": f"WITH {JUDGED} {STAGES}",
        "dq_report": f"WITH {JUDGED} {REPORT}",
        "rejects_by_reason": f"WITH {JUDGED} SELECT reason, count FROM ({REPORT})",
        "flag_counts": f"""WITH {NULLIFIED}
            SELECT {FLAG} AS gp_code_flag, count(*) AS row_count FROM nullified GROUP BY 1""",
        "kpi_breach_rate": f"""WITH {JUDGED} SELECT count(*) AS total_attendances,
            count(*) FILTER (los_minutes > 240) AS breaches,
            {_percent('count(*) FILTER (los_minutes > 240)', 'count(*)', 1)}
              AS breach_rate_pct FROM stays""",
        "kpi_stay_by_triage": f"""WITH {JUDGED} SELECT triage_category,
            count(*) AS attendances, round(avg(los_minutes), 0) AS avg_los_minutes,
            round(median(los_minutes), 0) AS median_los_minutes
            FROM stays GROUP BY triage_category ORDER BY triage_category""",
        "kpi_arrivals_by_hour": f"""WITH {JUDGED}
            SELECT cast(extract(hour FROM arrival_time) AS int) AS arrival_hour,
            count(*) AS attendances FROM clean GROUP BY 1 ORDER BY 1""",
        "kpi_overall_median": f"""WITH {JUDGED}
            SELECT round(median(los_minutes), 0) AS median_los_minutes FROM stays""",
        "shape_profile": f"WITH {FEED} {_shapes('feed', ['arrival_time', 'departure_time'])}",
        "shape_profile_customers": _shapes("customer", ["c_name", "c_mktsegment"]),
        "top_shapes": f"""WITH {FEED} SELECT shape, row_count, example_value
            FROM ({_shapes('feed', ['presenting_complaint'])})
            ORDER BY row_count DESC, shape LIMIT 20""",
        "top_shapes_orders": f"""SELECT shape, row_count, example_value
            FROM ({_shapes('orders', ['o_orderpriority'])})
            ORDER BY row_count DESC, shape LIMIT 20""",
        "distinct_counts": f"""WITH {CHECKED}, cased AS (SELECT attendance_id,
              {_canonical('presenting_complaint', COMPLAINTS)} AS presenting_complaint,
              {_canonical('disposition', DISPOSITIONS)} AS disposition FROM nullified)
            SELECT (SELECT count(*) FROM (SELECT DISTINCT attendance_id FROM cased))
              AS attendance_id,
            (SELECT count(*) FROM (SELECT DISTINCT presenting_complaint FROM cased))
              AS presenting_complaint,
            (SELECT count(*) FROM (SELECT DISTINCT disposition FROM cased))
              AS disposition""",
        "distinct_counts_lineitem": """SELECT count(DISTINCT l_orderkey) AS l_orderkey,
            count(DISTINCT l_partkey) AS l_partkey,
            count(DISTINCT l_returnflag) AS l_returnflag FROM lineitem""",
        "raw_profile": f"WITH {FEED} {_overview(RAW.split(', '))}",
        "raw_peek": f"WITH {FEED} SELECT {RAW} FROM feed ORDER BY feed_order, source_row LIMIT 5",
        # Deduplication
        "dedupe_keep_first": f"""WITH {FEED} SELECT {RAW}, feed_order, source_row FROM feed
            QUALIFY row_number() OVER (
              PARTITION BY attendance_id ORDER BY feed_order, source_row) = 1""",
        "dedupe_orders": """SELECT * FROM orders QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
        "duplicate_rows": f"""WITH {KEYED}
            SELECT raw_row_number, attendance_id FROM numbered WHERE occurrence > 1""",
        "rows_of_repeated_keys": f"""WITH {FEED} SELECT attendance_id, source_row FROM feed
            WHERE attendance_id IN (
              SELECT attendance_id FROM feed GROUP BY 1 HAVING count(*) > 1)""",
        "duplicate_count": f"""WITH {FEED} SELECT count(*) AS rows_in,
            count(DISTINCT attendance_id) AS rows_out,
            count(*) - count(DISTINCT attendance_id) AS duplicates_removed FROM feed""",
        # Reconciliation
        "reconcile_matched": f"WITH {_pairs()} FROM found_ids INTERSECT FROM truth_ids",
        "reconcile_false_positive": f"WITH {strict_pairs} FROM found_ids EXCEPT FROM truth_ids",
        "reconcile_false_negative": f"WITH {lenient_pairs} FROM truth_ids EXCEPT FROM found_ids",
        "reconcile_summary": f"WITH {_pairs()} {SUMMARY}",
        "reconcile_by_rule": f"""WITH {other_pairs} SELECT reason,
            count(t.attendance_id) AS truth_rows, count(f.attendance_id) AS found_rows,
            count(*) FILTER (t.attendance_id = f.attendance_id) AS matched,
            count(*) FILTER (t.attendance_id = f.attendance_id)
              / nullif(count(f.attendance_id), 0) AS precision,
            count(*) FILTER (t.attendance_id = f.attendance_id)
              / nullif(count(t.attendance_id), 0) AS recall
            FROM (SELECT *, attendance_id AS id FROM truth) t
            FULL JOIN (SELECT *, attendance_id AS id FROM found) f USING (id, reason)
            GROUP BY reason""",
        "reconcile_customers": f"""WITH
            found_ids AS (SELECT DISTINCT o_custkey FROM orders),
            truth_ids AS (SELECT DISTINCT c_custkey FROM customer) {SUMMARY}""",
        # Fault injection
        "inject_missing": f"""WITH {good_text} SELECT event_id,
            CASE WHEN slot = 9 THEN {MARKER} ELSE pseudo_patient_id END AS pseudo_patient_id,
            CASE WHEN slot IN (0, 24) THEN {MARKER} ELSE arrival_time END AS arrival_time,
            CASE WHEN slot IN (1, 2) THEN {MARKER} ELSE departure_time END AS departure_time,
            CASE WHEN slot BETWEEN 18 AND 21 THEN {MARKER} ELSE presenting_complaint END
              AS presenting_complaint,
            CASE WHEN slot IN (22, 23) THEN {MARKER} ELSE disposition END AS disposition,
            CASE WHEN slot BETWEEN 12 AND 17 THEN {MARKER} ELSE gp_practice_code END
              AS gp_practice_code,
            {_logged(
                ('missing_arrival_time', 'slot IN (0, 24)'),
                ('missing_departure_time', 'slot IN (1, 2)'),
                ('missing_patient_id', 'slot = 9'),
                ('missing_gp_code', 'slot BETWEEN 12 AND 17'),
                ('missing_presenting_complaint', 'slot BETWEEN 18 AND 21'),
                ('missing_disposition', 'slot IN (22, 23)'))} AS planted FROM texts""",
        "inject_invalid_code": _damage(
            f"CASE WHEN slot IN (5, 6, 24) THEN {INVALID} ELSE triage_category END "
            "AS triage_category",
            _logged(("invalid_triage_code", "slot IN (5, 6, 24)")),
        ),
        "inject_malformed_code": _damage(
            f"CASE WHEN slot IN (10, 11) THEN {MALFORMED} ELSE gp_practice_code END "
            "AS gp_practice_code",
            _logged(("malformed_gp_code", "slot IN (10, 11)")),
        ),
        "inject_mixed_formats": f"""WITH {GOOD} SELECT event_id,
            {_written('arrival')} AS arrival_time,
            {_written('departure')} AS departure_time FROM good""",
        "inject_decimal_suffix": _damage(
            f"CASE WHEN {SUFFIX_NOISE} THEN triage_category || '.0' ELSE triage_category END "
            "AS triage_category",
            _logged(("triage_decimal_format", SUFFIX_NOISE)),
        ),
        "inject_lowercase": _damage(
            f"CASE WHEN {LOWER_NOISE} THEN lower(gp_practice_code) ELSE gp_practice_code END "
            "AS gp_practice_code",
            _logged(("gp_code_lowercase", LOWER_NOISE)),
        ),
        "inject_text_noise": _damage(
            f"CASE WHEN {COMPLAINT_NOISE} THEN {COMPLAINT_UNTIDY} ELSE presenting_complaint END "
            "AS presenting_complaint, "
            f"CASE WHEN {DISPOSITION_NOISE} THEN {DISPOSITION_UNTIDY} ELSE disposition END "
            "AS disposition",
            _logged(
                ("inconsistent_text_format", COMPLAINT_NOISE),
                ("inconsistent_text_format", DISPOSITION_NOISE),
            ),
        ),
        "inject_duplicates": f"""WITH {good_text}
            SELECT event_id, {RAW}, 0 AS copy FROM texts UNION ALL
            SELECT event_id, {RAW}, 1 AS copy FROM texts WHERE slot IN (40, 41)""",
        "inject_negative_stay": _damage(
            f"arrival, {NEGATIVE.format('departure')} AS departure",
            _logged(("departure_before_arrival", "slot IN (3, 4)")),
        ),
        "inject_extreme_stay": _damage(
            f"arrival, {EXTREME.format('departure')} AS departure",
            _logged(("extreme_length_of_stay", "slot IN (8, 26)")),
        ),
        "inject_future_date": _damage(
            f"{FUTURE.format('arrival')} AS arrival, {FUTURE.format('departure')} AS departure",
            _logged(("future_dated_attendance", "slot = 7")),
        ),
        "raw_row_number": f"""WITH {KEYED}
            SELECT raw_row_number, attendance_id, source_row FROM numbered""",
        "fault_allocation": f"""WITH {GOOD} SELECT cast(CASE WHEN slot = 24 THEN 2
              WHEN slot <= 23 OR slot IN (26, 27) THEN 1 ELSE 0 END AS int) AS faults,
            count(*) AS row_count FROM good GROUP BY 1""",
        "answer_key": f"WITH {KEYED} SELECT * FROM entries",
        "fault_counts": f"""WITH {KEYED}
            SELECT error_type, count(*) AS row_count FROM entries GROUP BY 1""",
        # Whole jobs
        "cleaning_chain": f"WITH {JUDGED} SELECT {CLEAN}, failure_reasons FROM judged",
        "cleaned_from_csv": f"WITH {JUDGED} SELECT * FROM clean",
        "damaged_customer_names": """SELECT c_custkey,
            CASE WHEN c_custkey % 11 = 2 THEN lower(c_name)
              WHEN c_custkey % 13 IN (5, 6) THEN ' ' || c_name || '  ' ELSE c_name END AS c_name,
            concat_ws(',', CASE WHEN c_custkey % 11 = 2 THEN 'lower_case' END,
              CASE WHEN c_custkey % 13 IN (5, 6) THEN 'padded' END) AS planted FROM customer""",
        "damaged_order_priorities": """SELECT o_orderkey,
            CASE WHEN o_orderkey % 17 = 3 THEN o_orderpriority[1:1]
              WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
            concat_ws(',', CASE WHEN o_orderkey % 17 = 3 THEN 'number_only' END,
              CASE WHEN o_orderkey % 7 = 0 THEN 'missing' END) AS planted FROM orders""",
        "damaged_document_languages": """SELECT doc_id,
            CASE WHEN doc_id % 5 = 1 THEN lang || '-XX' WHEN doc_id % 3 = 2 THEN upper(lang)
              ELSE lang END AS lang,
            concat_ws(',', CASE WHEN doc_id % 5 = 1 THEN 'region_added' END,
              CASE WHEN doc_id % 3 = 2 THEN 'upper_case' END) AS planted FROM documents""",
        "malformed_lines": f"""WITH {JUDGED}
            SELECT CASE WHEN f.slot NOT IN (50, 51, 52) THEN j.attendance_id END AS attendance_id,
              CASE WHEN f.slot NOT IN (50, 51, 52) AND failure_reasons = '' THEN 'clean'
                ELSE 'quarantined' END AS outcome,
              CASE WHEN f.slot IN (50, 51, 52) THEN 'malformed_line' ELSE failure_reasons END
                AS failure_reasons,
              CASE WHEN f.slot IN (50, 51) THEN f.line || ',one more'
                WHEN f.slot = 52 THEN regexp_replace(f.line, ',[^,]*,[^,]*$', '') END AS line
            FROM judged j JOIN (SELECT attendance_id, slot, concat_ws(',',
                {', '.join(f"coalesce({c}, '')" for c in RAW.split(', '))}) AS line
              FROM feed WHERE copy = 0) f ON j.attendance_id = f.attendance_id""",
        "run_metrics": f"""WITH {JUDGED}, n AS ({STAGES})
            SELECT 'read' AS stage, rows_read AS rows_in, rows_read AS rows_out FROM n
            UNION ALL SELECT 'deduplicate', rows_read, rows_deduplicated FROM n
            UNION ALL SELECT 'keep_clean', rows_deduplicated, rows_clean FROM n
            UNION ALL SELECT 'quarantine', rows_deduplicated, rows_quarantined FROM n
            UNION ALL SELECT 'load', rows_clean, rows_clean FROM n""",
        "arrivals_cleaned": f"WITH {JUDGED} SELECT {CLEAN}, failure_reasons FROM judged",
        "full_run": f"""WITH {_pairs()}
            SELECT * FROM ({_unpivot(STAGES)}) UNION ALL
            SELECT * FROM ({_unpivot(SUMMARY)})""",
        "expectation_report": f"WITH {JUDGED} {_expectations()}",
    }
