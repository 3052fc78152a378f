"""The same results in SQL, computed from the base tables without any JSON.

Each statement shares one prelude of common table expressions that spell out
what every event of the derived feeds should become.
"""

from __future__ import annotations

from weirflow.sources.feed import CUSTOMERS_TOPIC, WIDE_TOPIC
from weirflow.sources import generator

# Spelled out here, not taken from the engine's declarations, which they check.
TARGET_COLUMNS = (
    "activity_id job_id jobdiva_no candidate company_name assignment_start_date assignment_end_date job_title "
    "location excluded_reason sr_assignment_start sr_assignment_end standard_revenue_report_month clienterpid "
    "bcworkerid adjustedstbillrate adjustedstpayrate adjgphrst adjrevenue stbillrate"
).split()
TIMESTAMP_COLUMNS = (
    "assignment_start_date assignment_end_date sr_assignment_start sr_assignment_end"
).split()
DECIMAL_COLUMNS = "adjustedstbillrate adjustedstpayrate adjgphrst adjrevenue stbillrate".split()
COMPOSITE_KEY = ("activity_id", "job_id", "company_name")
TOPIC_PREFIX = "pgserver1.public."
# The target columns each source maps, and those its sink writes.
OWNED = {
    "job_activity": (
        "activity_id job_id jobdiva_no candidate company_name assignment_start_date assignment_end_date bcworkerid"
    ).split(),
    "jobs": "job_id job_title location".split(),
    "clients_to_exclude": "company_name excluded_reason".split(),
    "standard_revenue": (
        "sr_assignment_start sr_assignment_end standard_revenue_report_month clienterpid bcworkerid "
        "adjustedstbillrate adjustedstpayrate adjgphrst adjrevenue stbillrate"
    ).split(),
}
WRITTEN = {
    "job_activity": OWNED["job_activity"],
    "jobs": "activity_id job_id company_name job_title location".split(),
    "clients_to_exclude": "activity_id job_id company_name excluded_reason".split(),
    "standard_revenue": ["activity_id", "job_id", "company_name", *OWNED["standard_revenue"]],
}


def _op(key: str) -> str:
    return (
        f"CASE {key} % 10 WHEN 0 THEN 'd' WHEN 1 THEN 'u' WHEN 2 THEN 'r' "
        "WHEN 3 THEN NULL ELSE 'c' END"
    )


def _null(column: str) -> str:
    if column in TIMESTAMP_COLUMNS:
        return "CAST(NULL AS TIMESTAMP)"
    if column in DECIMAL_COLUMNS:
        return "CAST(NULL AS DECIMAL(10,2))"
    return "CAST(NULL AS VARCHAR)"


def _topic(name: str) -> str:
    return f"'{TOPIC_PREFIX}{name}'"


def _sunk(name: str, placeholders: dict[str, str]) -> str:
    """A source's stored rows, padded to the whole target."""
    owned = OWNED[name]
    columns = ", ".join(
        f"{placeholders.get(c, c if c in owned else _null(c))} AS {c}"
        for c in TARGET_COLUMNS
    )
    return f"SELECT {_topic(name)} AS topic, ord, '{name}' AS source_table, {columns} FROM {name}_live"


AMOUNT = "CAST(value AS DECIMAL(10,2))"

PRELUDE = f"""
WITH job_activity_all AS (
  SELECT 2 * o_orderkey + v AS ord,
    CASE WHEN v = 1 THEN 'u' ELSE {_op('o_orderkey')} END AS op,
    CAST(o_orderkey AS VARCHAR) AS activity_id,
    'JOB_' || o_custkey AS job_id,
    'JD' || (o_orderkey % 1000) AS jobdiva_no,
    o_orderpriority AS candidate,
    'CLIENT_' || ((o_custkey + v) % 50) AS company_name,
    CASE o_orderkey % 6
      WHEN 2 THEN o_orderdate WHEN 4 THEN NULL WHEN 5 THEN NULL
      ELSE o_orderdate + to_seconds(o_orderkey % 86400)
    END AS assignment_start_date,
    CASE o_orderkey % 50
      WHEN 0 THEN TIMESTAMP '2024-02-29 00:00:00'
      WHEN 1 THEN TIMESTAMP '2023-05-01 00:00:00'
      ELSE o_orderdate + INTERVAL 90 DAY + INTERVAL 17 HOUR
    END AS assignment_end_date,
    'BC' || (o_custkey % 200) AS bcworkerid
  FROM orders, (VALUES (0), (1)) versions(v)
  WHERE v = 0 OR o_orderkey % 4 = 1
), jobs_all AS (
  SELECT p_partkey AS ord, {_op('p_partkey')} AS op,
    CASE WHEN p_partkey % 7 = 0 THEN 'JOBS' ELSE 'jobs' END AS table_name,
    'JOB_' || p_partkey AS job_id, p_type AS job_title,
    CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS location
  FROM part
), clients_to_exclude_all AS (
  SELECT s_suppkey AS ord, {_op('s_suppkey')} AS op,
    'CLIENT_' || s_suppkey AS company_name, s_name AS excluded_reason
  FROM supplier
), standard_revenue_all AS (
  SELECT event_id AS ord, {_op('event_id')} AS op,
    event_id % 97 = 0 AS broken, event_id % 12 = 9 AS overflow,
    date_trunc('second', ts) AS sr_assignment_start,
    date_trunc('millisecond', ts) AS sr_assignment_end,
    strftime(ts, '%Y-%m') AS standard_revenue_report_month,
    'CLIENT' || (event_id % 7) AS clienterpid,
    'BC' || user_id AS bcworkerid,
    {AMOUNT} AS adjustedstbillrate, {AMOUNT} AS adjustedstpayrate, {AMOUNT} AS adjgphrst,
    CASE event_id % 12
      WHEN 0 THEN 0.00 WHEN 1 THEN NULL WHEN 2 THEN 75.50 WHEN 3 THEN 0.00
      WHEN 4 THEN 0.50 WHEN 6 THEN NULL WHEN 7 THEN 12.35 WHEN 8 THEN 1000.00
      WHEN 9 THEN NULL ELSE {AMOUNT}
    END::DECIMAL(10,2) AS adjrevenue,
    {AMOUNT} AS stbillrate
  FROM events
), customers_all AS (
  SELECT c_custkey AS ord, {_op('c_custkey')} AS op, c_custkey, c_name, c_nationkey,
    c_acctbal, c_mktsegment,
    CASE WHEN c_custkey % 10 = 0 THEN 'delete'
         WHEN c_custkey % 19 = 3 THEN 'no_image'
         WHEN c_custkey % 17 = 3 THEN 'no_table'
         WHEN c_custkey % 5 = 0 THEN 'empty_image' END AS reason
  FROM customer
), wide_all AS (
  SELECT o_orderkey AS ord, {_op('o_orderkey')} AS op,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'W' || o_orderkey END AS activity_id,
    o_orderpriority AS candidate,
    CASE o_orderkey % 6
      WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate
      WHEN 2 THEN TIMESTAMP '2023-03-03 00:00:15.25'
    END AS assignment_start_date,
    CASE o_orderkey % 5
      WHEN 0 THEN 12.35 WHEN 1 THEN 5.00
      WHEN 3 THEN CAST(o_totalprice AS DECIMAL(10,2))
    END::DECIMAL(10,2) AS adjrevenue,
    o_orderkey % 6 IN (3, 4) OR o_orderkey % 5 = 2 AS unreadable,
    'WJ' || o_custkey AS job_id, 'JD' || (o_orderkey % 1000) AS jobdiva_no,
    'WC_' || (o_custkey % 50) AS company_name, o_orderstatus AS job_title,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS location,
    'r' || (o_orderkey % 3) AS excluded_reason,
    strftime(o_orderdate, '%Y-%m') AS standard_revenue_report_month,
    'E' || (o_custkey % 7) AS clienterpid, 'WB' || (o_custkey % 200) AS bcworkerid,
    o_orderdate AS assignment_end_date, o_orderdate AS sr_assignment_start,
    CASE WHEN o_orderkey % 8 <> 0 THEN o_orderdate END AS sr_assignment_end,
    CAST(o_totalprice AS DECIMAL(10,2)) AS adjustedstbillrate, 7.25::DECIMAL(10,2) AS adjustedstpayrate,
    (o_orderkey % 100)::DECIMAL(10,2) AS adjgphrst, (-(o_orderkey % 100) - 0.5)::DECIMAL(10,2) AS stbillrate
  FROM orders
), job_activity_live AS (
  SELECT * FROM job_activity_all WHERE op IS DISTINCT FROM 'd'
), jobs_live AS (
  SELECT * FROM jobs_all WHERE op IS DISTINCT FROM 'd'
), clients_to_exclude_live AS (
  SELECT * FROM clients_to_exclude_all WHERE op IS DISTINCT FROM 'd'
), standard_revenue_mapped AS (
  SELECT * FROM standard_revenue_all WHERE op IS DISTINCT FROM 'd' AND NOT broken
), standard_revenue_live AS (
  SELECT * FROM standard_revenue_mapped WHERE NOT overflow
), wide_live AS (
  SELECT * FROM wide_all WHERE op IS DISTINCT FROM 'd'
), stored AS (
  {_sunk('job_activity', {})}
  UNION ALL {_sunk('jobs', {'activity_id': 'job_id', 'company_name': "'job_record'"})}
  UNION ALL {_sunk('clients_to_exclude', {
      'activity_id': "'client_record'", 'job_id': "'client_record'"})}
  UNION ALL {_sunk('standard_revenue', {
      'activity_id': 'bcworkerid', 'job_id': "'revenue_record'",
      'company_name': "'revenue_record'"})}
), merged AS (
  SELECT * FROM stored
  QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY ord DESC) = 1
)
"""

COLUMNS = ", ".join(TARGET_COLUMNS)


def _padded(present: dict[str, str]) -> str:
    return ", ".join(f"{present.get(c, _null(c))} AS {c}" for c in TARGET_COLUMNS)


def _all_topics(columns: str) -> str:
    """One select over every event of the unified feed: topic, ord, op and more."""
    return f"""(
  SELECT {_topic('job_activity')} AS topic, ord, op, 'job_activity' AS table_name,
    activity_id AS a, job_id AS j, NULL AS c, bcworkerid AS b, true AS has_image, false AS broken
  FROM job_activity_all
  UNION ALL SELECT {_topic('jobs')}, ord, op, 'jobs', NULL, job_id, NULL, NULL, true, false FROM jobs_all
  UNION ALL SELECT {_topic('clients_to_exclude')}, ord, op, 'clients_to_exclude',
    NULL, NULL, company_name, NULL, true, false FROM clients_to_exclude_all
  UNION ALL SELECT {_topic('standard_revenue')}, ord, CASE WHEN NOT broken THEN op END,
    'standard_revenue', NULL, NULL, NULL, bcworkerid, true, broken FROM standard_revenue_all
  UNION ALL SELECT '{CUSTOMERS_TOPIC}', ord, op, CASE WHEN ord % 17 <> 3 THEN 'customers' END,
    NULL, NULL, NULL, NULL, ord % 19 <> 3, false FROM customers_all
) {columns}"""


ORACLES: dict[str, str] = {}


def _add(name: str, body: str) -> None:
    ORACLES[name] = f"{PRELUDE}\n{body}"


_add("cdc_feed_counts", f"""
SELECT topic, count(*) AS events, min(ord) AS first_offset, max(ord) AS last_offset,
  sum(('0x' || substr(md5(concat_ws('|', CASE WHEN NOT broken THEN 'read' ELSE 'broken' END, op, a, j, c,
    CASE WHEN NOT broken THEN b END)), 1, 8))::BIGINT)::BIGINT AS checksum
FROM {_all_topics('t')} GROUP BY topic""")

_add("cdc_topic_split", f"""
SELECT topic, op, count(*) AS events FROM {_all_topics('t')}
WHERE topic <> '{CUSTOMERS_TOPIC}' GROUP BY topic, op""")

for _source in OWNED:
    _live = "standard_revenue_mapped" if _source == "standard_revenue" else f"{_source}_live"
    _add(f"map_{_source}", f"""
SELECT ord AS "offset", '{_source}' AS source_table, {', '.join(OWNED[_source])}
FROM {_live}""")
    _add(f"sink_{_source}", f"""
SELECT ord AS "offset", {', '.join(WRITTEN[_source])}
FROM stored WHERE source_table = '{_source}'""")

_add("map_unknown_passthrough", """
SELECT ord AS "offset", 'customers' AS table_name, f.field, f.value
FROM customers_all, LATERAL (VALUES
  ('c_custkey', CAST(c_custkey AS VARCHAR)), ('c_name', c_name),
  ('c_nationkey', CAST(c_nationkey AS VARCHAR)), ('c_acctbal', CAST(c_acctbal AS VARCHAR)),
  ('c_mktsegment', c_mktsegment)) f(field, value)
WHERE reason IS NULL""")

_add("image_select", f"""
SELECT topic, ord AS "offset", op, table_name, has_image,
  a AS activity_id, j AS job_id, c AS client_id, b AS bcworkerid
FROM {_all_topics('t')} WHERE NOT broken""")

_add("matching_key", f"""
SELECT {_topic('job_activity')} AS topic, ord AS "offset",
  'activity_id' AS key_column, activity_id AS key_value FROM job_activity_all
UNION ALL SELECT {_topic('jobs')}, ord, 'job_id', job_id FROM jobs_all
UNION ALL SELECT {_topic('clients_to_exclude')}, ord, 'company_name', company_name
  FROM clients_to_exclude_all
UNION ALL SELECT {_topic('standard_revenue')}, ord, 'bcworkerid', bcworkerid
  FROM standard_revenue_all WHERE NOT broken
UNION ALL SELECT {_topic('standard_revenue')}, ord, 'clienterpid', clienterpid
  FROM standard_revenue_all WHERE NOT broken
UNION ALL SELECT '{CUSTOMERS_TOPIC}', ord, NULL, NULL FROM customers_all
  WHERE ord % 19 <> 3 AND ord % 17 <> 3""")

_add("route_case_insensitive", """
SELECT table_name, 'jobs' AS source_table, count(*) AS events FROM jobs_all GROUP BY table_name""")

_add("bind_by_name", f"""
SELECT ord AS "offset", {', '.join(f"CASE WHEN op IS DISTINCT FROM 'd' THEN {c} END AS {c}" for c in TARGET_COLUMNS)},
  CASE WHEN op = 'd' THEN 'delete' WHEN unreadable THEN 'bad_value'
       WHEN activity_id IS NULL THEN 'null_key' END AS reason
FROM wide_all""")

ORACLES["parse_datetime"] = """
SELECT o_orderkey, CASE o_orderkey % 16
  WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate WHEN 2 THEN o_orderdate
  WHEN 3 THEN o_orderdate + to_milliseconds(o_orderkey)
  WHEN 6 THEN date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 SECOND
  WHEN 7 THEN o_orderdate + INTERVAL 1 DAY
  WHEN 9 THEN o_orderdate
  WHEN 11 THEN TIMESTAMP '2243-10-16 00:00:00'
  WHEN 12 THEN TIMESTAMP '1970-01-01 00:01:40' END AS parsed
FROM orders"""

ORACLES["parse_decimal"] = f"""
SELECT event_id, CASE event_id % 14
  WHEN 0 THEN {AMOUNT} WHEN 1 THEN {AMOUNT} WHEN 2 THEN -{AMOUNT}
  WHEN 3 THEN 100 * {AMOUNT}
  WHEN 4 THEN CAST('0.' || event_id AS DECIMAL(10,2))
  WHEN 5 THEN 0 WHEN 6 THEN 0 WHEN 7 THEN 0
  WHEN 10 THEN event_id + 0.01 WHEN 11 THEN 0 WHEN 12 THEN 0
  END::DECIMAL(10,2) AS parsed
FROM events"""

_add("sink_revenue_keyless", f"""
SELECT ord AS "offset", {', '.join(OWNED['standard_revenue'])}, 'null_key' AS reason
FROM standard_revenue_mapped""")

_WIDE_STORED = f"SELECT {COLUMNS} FROM wide_live WHERE NOT unreadable AND activity_id IS NOT NULL"

_add("sink_full_row_upsert", f"""
SELECT {COLUMNS} FROM merged WHERE source_table = 'job_activity'
UNION ALL {_WIDE_STORED}""")

_add("sink_unified_rows", f"""
SELECT ord AS "offset", source_table, {COLUMNS} FROM stored""")

_add("sink_rejects", f"""
SELECT 'selective' AS sink, {_topic('standard_revenue')} AS topic, ord AS "offset",
  'bad_value' AS reason FROM standard_revenue_mapped WHERE overflow
UNION ALL SELECT 'full_row', {_topic('standard_revenue')}, ord,
  CASE WHEN overflow THEN 'bad_value' ELSE 'null_key' END FROM standard_revenue_mapped
UNION ALL SELECT 'full_row', {_topic('jobs')}, ord, 'null_key' FROM jobs_live
UNION ALL SELECT 'full_row', {_topic('clients_to_exclude')}, ord, 'null_key'
  FROM clients_to_exclude_live
UNION ALL SELECT 'full_row', '{CUSTOMERS_TOPIC}', ord, 'null_key'
  FROM customers_all WHERE reason IS NULL
UNION ALL SELECT 'full_row', '{WIDE_TOPIC}', ord,
  CASE WHEN unreadable THEN 'bad_value' ELSE 'null_key' END
  FROM wide_live WHERE unreadable OR activity_id IS NULL""")

_add("drop_audit", """
SELECT reason, count(*) AS events FROM (
  SELECT CASE WHEN op = 'd' THEN 'delete' ELSE 'accepted' END AS reason FROM job_activity_all
  UNION ALL SELECT CASE WHEN op = 'd' THEN 'delete' ELSE 'accepted' END FROM jobs_all
  UNION ALL SELECT CASE WHEN op = 'd' THEN 'delete' ELSE 'accepted' END FROM clients_to_exclude_all
  UNION ALL SELECT CASE WHEN broken THEN 'parse_error' WHEN op = 'd' THEN 'delete'
    WHEN overflow THEN 'bad_value' ELSE 'accepted' END FROM standard_revenue_all
  UNION ALL SELECT coalesce(reason, 'unknown_table') FROM customers_all
  UNION ALL SELECT CASE WHEN op = 'd' THEN 'delete' ELSE 'unknown_table' END FROM wide_all
  UNION ALL SELECT CASE WHEN o_orderkey % 5 = 4 THEN 'unknown_table' ELSE 'accepted' END FROM orders
) GROUP BY reason""")

_add("merge_append", f"SELECT {COLUMNS} FROM stored")
_add("merge_replace_row", f"SELECT {COLUMNS} FROM merged")
_add("merge_replace_row_composite", f"""
SELECT {COLUMNS} FROM stored
QUALIFY row_number() OVER (PARTITION BY {', '.join(COMPOSITE_KEY)} ORDER BY ord DESC) = 1""")

_add("merge_replace_row_by_ts", f"""
SELECT {COLUMNS} FROM stored
QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY ord) = 1""")
ORACLES["ingest_metrics"] = ORACLES["drop_audit"]

ORACLES["merge_partial"] = f"""
WITH known AS (SELECT *, o_orderkey % 5 AS kind FROM orders WHERE o_orderkey % 5 <> 4),
latest AS (
  SELECT * FROM known
  QUALIFY row_number() OVER (PARTITION BY o_custkey, kind ORDER BY o_orderkey DESC) = 1
), placed AS (
  SELECT CAST(o_custkey AS VARCHAR) AS activity_id,
    max(CASE WHEN kind = 0 THEN o_orderpriority END) AS candidate,
    max(CASE WHEN kind = 1 AND o_orderkey % 2 = 0 THEN o_orderstatus END) AS job_title,
    max(CASE WHEN kind = 3 THEN o_orderstatus END) AS excluded_reason,
    max(CASE WHEN kind = 2 THEN CAST(o_totalprice AS DECIMAL(10,2)) END) AS adjrevenue,
    arg_max(CASE kind WHEN 0 THEN 'A' ELSE 'J' END || o_orderkey, o_orderkey) FILTER (kind IN (0, 1)) AS job_id,
    arg_max(CASE kind WHEN 0 THEN 'A' ELSE 'X' END || o_orderkey, o_orderkey) FILTER (kind IN (0, 3)) AS company_name,
    arg_max(CASE kind WHEN 0 THEN 'A' ELSE 'R' END || o_orderkey, o_orderkey) FILTER (kind IN (0, 2)) AS bcworkerid
  FROM latest GROUP BY o_custkey
)
SELECT {_padded({c: c for c in (
    'activity_id', 'candidate', 'job_title', 'adjrevenue', 'excluded_reason', 'job_id', 'company_name', 'bcworkerid')})}
FROM placed"""
ORACLES["stream_partial"] = ORACLES["merge_partial"]

_UPDATED = {
    c: f"{alias}.{c}"
    for alias, columns in (
        ("a", OWNED["job_activity"]),
        ("j", ("job_title", "location")),
        ("x", ("excluded_reason",)),
        ("r", [c for c in OWNED["standard_revenue"] if c != "bcworkerid"]),
    )
    for c in columns
}


def _match_update(revenue: str) -> str:
    """Common tables up to ``matched``: the target of ``match_update`` with the revenue changes chosen."""
    return f"""
, last_activity AS (
  SELECT * FROM job_activity_live
  QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY ord DESC) = 1
), last_job AS (
  SELECT * FROM jobs_live QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ord DESC) = 1
), last_client AS (
  SELECT * FROM clients_to_exclude_live
  QUALIFY row_number() OVER (PARTITION BY company_name ORDER BY ord DESC) = 1
), last_revenue AS (
  SELECT * FROM standard_revenue_live WHERE {revenue}
  QUALIFY row_number() OVER (PARTITION BY bcworkerid ORDER BY ord DESC) = 1
), matched AS (
  SELECT {', '.join(f'{_UPDATED[c]} AS {c}' for c in TARGET_COLUMNS)}
  FROM last_activity a
  LEFT JOIN last_job j ON a.job_id = j.job_id
  LEFT JOIN last_client x ON a.company_name = x.company_name
  LEFT JOIN last_revenue r ON a.bcworkerid = r.bcworkerid
)"""


_add("merge_match_update", f"{_match_update('true')} SELECT * FROM matched")

_REVENUE = [c for c in OWNED["standard_revenue"] if c != "bcworkerid"]
# rows with a client take the last change of worker and client, others the last of the worker
_add("match_existing_two_part", f"""{_match_update('ord % 2 = 0')}, later AS (
  SELECT *, row_number() OVER (PARTITION BY bcworkerid ORDER BY ord DESC) AS of_worker,
    row_number() OVER (PARTITION BY bcworkerid, clienterpid ORDER BY ord DESC) AS of_both
  FROM standard_revenue_live WHERE ord % 2 = 1
)
SELECT {', '.join(
    f"CASE WHEN l.ord IS NULL THEN m.{c} ELSE l.{c} END AS {c}" if c in _REVENUE else f"m.{c}" for c in TARGET_COLUMNS
)}
FROM matched m LEFT JOIN later l ON m.bcworkerid = l.bcworkerid
  AND CASE WHEN m.clienterpid IS NULL THEN of_worker = 1 ELSE of_both = 1 AND l.clienterpid = m.clienterpid END""")

ORACLES["compact_match_update"] = ORACLES["match_update_two_batches"] = ORACLES["merge_match_update"]
ORACLES["refresh_match_update"] = ORACLES["stream_maintained_match_update"] = ORACLES["merge_match_update"]
ORACLES["compact_composite"] = ORACLES["merge_replace_row_composite"]
ORACLES["refresh_replace_row"] = ORACLES["merge_replace_row"]
ORACLES["refresh_partial"] = ORACLES["merge_partial"]

_add("target_delete_then_refresh", f"""
, gone AS (
  SELECT activity_id AS key, max(ord) AS until FROM stored
  WHERE ord % 2 = 0 AND (activity_id LIKE 'JOB_1%' OR activity_id LIKE 'client_%' OR activity_id LIKE '1%')
  GROUP BY activity_id
)
SELECT {COLUMNS} FROM stored LEFT JOIN gone ON activity_id = key
WHERE until IS NULL OR ord > until
QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY ord DESC) = 1""")

_add("target_point_lookup", f"SELECT {COLUMNS} FROM merged WHERE activity_id = '101'")
_add("target_count", "SELECT count(*) AS total_records FROM merged")
_add("target_like_count", """
SELECT count(*) AS total_records FROM merged
WHERE activity_id LIKE 'JOB_1%' OR activity_id LIKE 'BC_%'
   OR activity_id LIKE 'client_%' OR activity_id LIKE '12_'""")
_add("target_in_list", """
SELECT activity_id, job_id, company_name, candidate, job_title, excluded_reason, bcworkerid,
  adjustedstbillrate, 'test_record' AS record_type
FROM merged WHERE activity_id IN ('101', 'JOB_12', 'BC7', 'client_record') ORDER BY activity_id""")
_add("target_sample", f"SELECT {COLUMNS} FROM merged ORDER BY activity_id LIMIT 5")
_add("target_delete_where", f"""
SELECT {COLUMNS} FROM merged
WHERE coalesce(NOT (activity_id = 'client_record' OR activity_id LIKE 'BC1%'
  OR activity_id LIKE 'JOB_%' OR activity_id IN ('1', '2', '3')
  OR company_name = 'CLIENT_7'), true)""")

_INSERTED = ("activity_id", "job_id", "company_name", "candidate", "job_title")
_add("target_insert_values", f"""
SELECT {COLUMNS} FROM merged WHERE activity_id NOT IN ('101', 'client_record')
UNION ALL SELECT {_padded({c: c for c in _INSERTED})} FROM (VALUES
  ('test_activity_1', 'test_job_1_updated', 'Test Company A Updated', 'Jane Doe', NULL),
  ('101', 'job_456', 'Company ABC', 'Bob Johnson', 'Data Engineer'),
  ('client_record', 'client_record', 'Excluded Company', NULL, NULL)
) v({', '.join(_INSERTED)})""")

ORACLES["stream_replace_row"] = ORACLES["merge_replace_row"]
ORACLES["stream_replay_idempotent"] = ORACLES["merge_replace_row"]
ORACLES["redrive_rejects"] = ORACLES["merge_replace_row"]
ORACLES["stream_state_partial"] = ORACLES["merge_partial"]
ORACLES["ingest_progress"] = (
    f"SELECT sum(events)::BIGINT AS events, sum(events)::BIGINT AS told FROM ({ORACLES['drop_audit']})"
)
_add("resume_from_offset", f"""
SELECT topic, count(*) AS events, min(ord) AS first_offset, max(ord) AS last_offset,
  count(*) FILTER (op = 'u') AS updates
FROM {_all_topics('t')} WHERE ord >= 100 AND NOT broken GROUP BY topic""")
ORACLES["stream_maintained"] = ORACLES["merge_replace_row"]


# --- generated events --------------------------------------------------------


def _pick(values: tuple[str, ...], number: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], ({number}) % {len(values)} + 1)"


def _pad(prefix: str, number: str, width: int = 3) -> str:
    return f"printf('{prefix}%0{width}d', {number})"


def _moment(number: str) -> str:
    n = f"({number})"
    return (
        f"printf('2024-%02d-%02d %02d:%02d:00', {n} % 12 + 1, {n} % 28 + 1, {n} % 24, {n} % 60)"
    )


def _amount(low: int, span: int) -> str:
    return f"CAST(((i * 37) % {span * 100} + {low * 100}) / 100.0 AS DECIMAL(10,2))"


_NAME = f"{_pick(generator.FIRST_NAMES, 'i')} || ' ' || {_pick(generator.LAST_NAMES, 'i * 3')}"


def _json(op: str, table: str, **fields: str) -> str:
    body = " || ',' || ".join(
        f"'\"{name}\":\"' || ({value}) || '\"'" for name, value in fields.items()
    )
    head = f'{{"op":"{op}","source":{{"table":"{table}"}},"after":{{'
    return f"'{head}' || {body} || '}}}}'"


def _activity(key: str) -> str:
    return _json(
        "c", "job_activity", activity_id=key, job_id=_pad("JOB_", "i * 7 % 1000"),
        jobdiva_no=_pad("JD", "i * 11 % 1000"), candidate_name=_NAME,
        company_name=_pick(generator.COMPANIES, "i"), assignment_start_date=_moment("i"),
        assignment_end_date=_moment("i + 5"), bcworkerid=_pad("BC", "i * 13 % 1000"),
    )


def _job(op: str, key: str) -> str:
    return _json(
        op, "jobs", job_id=key, job_title=_pick(generator.JOB_TITLES, "i"),
        location=_pick(generator.LOCATIONS, "i"),
    )


def _revenue(op: str, key: str) -> str:
    return _json(
        op, "standard_revenue", bcworkerid=key, clienterpid=_pad("CLIENT", "i * 17 % 1000"),
        adjusted_st_bill_rate=f"CAST({_amount(50, 50)} AS VARCHAR)",
        adjusted_st_pay_rate=f"CAST({_amount(30, 30)} AS VARCHAR)",
        adj_gph_rst=f"CAST({_amount(0, 20)} AS VARCHAR)",
        adj_revenue=f"CAST({_amount(1000, 2000)} AS VARCHAR)",
        st_bill_rate=f"CAST({_amount(45, 40)} AS VARCHAR)",
        standard_revenue_report_month="printf('2024-%02d', i % 12 + 1)",
        assignment_start_date=_moment("i"), assignment_end_date=_moment("i + 5"),
    )


def _exclusion(op: str, key: str) -> str:
    return _json(
        op, "clients_to_exclude", client_id=key,
        exclusion_reason=_pick(generator.EXCLUSION_REASONS, "i"),
    )


def _steps(ids: str, *steps: tuple[str, str]) -> str:
    return f"WITH ids AS (SELECT {ids})\n" + "\nUNION ALL ".join(
        f"SELECT i, {n} AS step, {value} AS value FROM ids WHERE {where}"
        for n, (value, where) in enumerate(steps)
    )


ORACLES["gen_batch"] = _steps(
    "o_orderkey AS i FROM orders",
    (_activity(_pad("test_activity_", "i")), "true"),
    (_job("c", _pad("JOB_", "i")), "true"),
    (_revenue("c", _pad("BC", "i")), "true"),
    (_exclusion("c", _pad("CLIENT_", "i")), "i % 5 = 0"),
)
ORACLES["gen_performance"] = _steps(
    "o_orderkey AS i FROM orders",
    (_activity(_pad("perf_test_", "i", 6)), "true"),
    (_job("u", _pad("JOB_", "i % 100")), "i % 10 = 0"),
)
ORACLES["golden_scenarios"] = _steps(
    "p_partkey AS i FROM part",
    (_activity("'upsert_test_' || i"), "true"),
    (_job("u", _pad("JOB_", "i")), "true"),
    (_revenue("u", _pad("BC", "i")), "true"),
    (_exclusion("u", _pad("CLIENT", "i")), "true"),
)
ORACLES["gen_target_rows"] = f"""
WITH ids AS (SELECT c_custkey AS i FROM customer)
SELECT CAST(i AS VARCHAR) AS activity_id, 'TEST_JOB_' || i AS job_id,
  {_pad('JD', 'i * 11 % 1000')} AS jobdiva_no, {_NAME} AS candidate,
  {_pick(generator.COMPANIES, 'i')} AS company_name,
  CAST({_moment('i')} AS TIMESTAMP) AS assignment_start_date,
  CAST({_moment('i + 5')} AS TIMESTAMP) AS assignment_end_date,
  {_pick(generator.JOB_TITLES, 'i')} AS job_title, {_pick(generator.LOCATIONS, 'i')} AS location,
  {_pad('BC', 'i * 13 % 1000')} AS bcworkerid, {_amount(50, 50)} AS adjustedstbillrate,
  {_amount(30, 30)} AS adjustedstpayrate, {_amount(1000, 2000)} AS adjrevenue
FROM ids"""
