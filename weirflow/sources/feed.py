"""Change feeds derived from base tables.

Stored tables hold no change events, so these functions turn their rows into
the events that a capture of such tables would have produced, deletes, odd
spellings and broken values included. They are plain projections: any table
size, batch or streaming, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from weirflow.schema import TAG_FIELD, TOPIC_PREFIX
from weirflow.sources.topics import as_topic

CUSTOMERS_TOPIC = TOPIC_PREFIX + "customers"
WIDE_TOPIC = TOPIC_PREFIX + "wide_rows"

STANDARD = "yyyy-MM-dd HH:mm:ss"


def _stamp(moment: str, pattern: str = STANDARD) -> str:
    return f'date_format({moment}, "{pattern}")'


def _millis(moment: str) -> str:
    """Epoch milliseconds of a zone-less timestamp, whatever the session zone."""
    micros = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST({moment} AS TIMESTAMP_NTZ))"
    return f"(({micros} - pmod({micros}, 1000L)) div 1000)"


def _case(selector: str, *values: str | None) -> str:
    """The value at the position that ``selector`` gives; ``None`` is NULL."""
    whens = " ".join(
        f"WHEN {selector} = {n} THEN {value}" for n, value in enumerate(values) if value
    )
    return f"CASE {whens} END"


def _first_op(key: str) -> str:
    """Operation of the first event of a key; most are creates."""
    return (
        f"CASE {key} % 10 WHEN 0 THEN 'd' WHEN 1 THEN 'u' WHEN 2 THEN 'r' "
        "WHEN 3 THEN NULL ELSE 'c' END"
    )


def _topic(
    rows: DataFrame,
    topic: str,
    table: str,
    order: str,
    op: str,
    fields: dict[str, str],
    present: str = "true",
    broken: str = "false",
) -> DataFrame:
    """Messages of one topic. A delete carries its image as ``before``.

    The image is a column first: put into both places at once, its code would stand there twice
    and make a method that the JVM no longer compiles.
    """
    names = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    rows = rows.selectExpr("*", f"{op} AS __op", f"IF({present}, named_struct({names}), NULL) AS __image")
    event = (
        f"to_json(named_struct('op', __op, "
        f"'source', named_struct('table', {table}, 'ts_ms', {order}), "
        f"'before', IF(__op <=> 'd', __image, NULL), "
        f"'after', IF(__op <=> 'd', NULL, __image)))"
    )
    value = f"IF({broken}, '{{ invalid json }}', {event})"
    return as_topic(rows, topic, F.expr(value), F.expr(order))


def activity_feed(orders: DataFrame) -> DataFrame:
    """``job_activity`` events: one per order, and an update with another
    company for every fourth."""
    versions = "explode(IF(o_orderkey % 4 = 1, array(0, 1), array(0))) AS version"
    start = "timestampadd(SECOND, o_orderkey % 86400, o_orderdate)"
    end = "(o_orderdate + INTERVAL '90 17' DAY TO HOUR)"
    return _topic(
        orders.selectExpr("*", versions),
        topic=TOPIC_PREFIX + "job_activity",
        table="'job_activity'",
        order="(2 * o_orderkey + version)",
        op=f"IF(version = 1, 'u', {_first_op('o_orderkey')})",
        fields={
            "activity_id": "CAST(o_orderkey AS STRING)",
            "job_id": "concat('JOB_', o_custkey)",
            "jobdiva_no": "concat('JD', o_orderkey % 1000)",
            "candidate_name": "o_orderpriority",
            "company_name": "concat('CLIENT_', (o_custkey + version) % 50)",
            "assignment_start_date": _case(
                "o_orderkey % 6",
                _stamp(start),
                _stamp(start, "yyyy-MM-dd'T'HH:mm:ss"),
                "CAST(unix_date(CAST(o_orderdate AS DATE)) AS STRING)",
                f"CAST({_millis(start)} AS STRING)",
                f"concat({_stamp(start)}, '.5')",
            ),
            "assignment_end_date": (
                "CASE o_orderkey % 50 WHEN 0 THEN '2024-02-30 00:00:00' "
                f"WHEN 1 THEN '2023-04-31T24:00:00' ELSE concat('\\t', {_stamp(end)}, ' ') END"
            ),
            "bcworkerid": "concat('BC', o_custkey % 200)",
        },
    )


def jobs_feed(part: DataFrame) -> DataFrame:
    """``jobs`` events, with some table names in capitals and some locations
    missing."""
    return _topic(
        part,
        topic=TOPIC_PREFIX + "jobs",
        table="IF(p_partkey % 7 = 0, 'JOBS', 'jobs')",
        order="p_partkey",
        op=_first_op("p_partkey"),
        fields={
            "job_id": "concat('JOB_', p_partkey)",
            "job_title": "p_type",
            "location": "IF(p_partkey % 11 = 0, NULL, p_brand)",
        },
    )


def exclusions_feed(supplier: DataFrame) -> DataFrame:
    """``clients_to_exclude`` events."""
    return _topic(
        supplier,
        topic=TOPIC_PREFIX + "clients_to_exclude",
        table="'clients_to_exclude'",
        order="s_suppkey",
        op=_first_op("s_suppkey"),
        fields={
            "client_id": "concat('CLIENT_', s_suppkey)",
            "exclusion_reason": "s_name",
        },
    )


def revenue_feed(events: DataFrame) -> DataFrame:
    """``standard_revenue`` events with dirty amounts and some broken messages."""
    amount = "CAST(CAST(value AS DECIMAL(12,2)) AS STRING)"
    return _topic(
        events,
        topic=TOPIC_PREFIX + "standard_revenue",
        table="'standard_revenue'",
        order="event_id",
        op=_first_op("event_id"),
        broken="event_id % 97 = 0",
        fields={
            "bcworkerid": "concat('BC', user_id)",
            "clienterpid": "concat('CLIENT', event_id % 7)",
            "adjusted_st_bill_rate": amount,
            "adjusted_st_pay_rate": "value",
            "adj_gph_rst": f"concat('+', {amount})",
            "adj_revenue": _case(
                "event_id % 12",
                "'E8WS'", "''", "' 75.50 '", "'5.'", "'.5'", amount, None,
                "'+12.345'", "'1e3'", "'123456789.00'", amount, amount,
            ),
            "st_bill_rate": f"concat('\\t', {amount}, ' ')",
            "standard_revenue_report_month": _stamp("ts", "yyyy-MM"),
            "assignment_start_date": _stamp("ts"),
            "assignment_end_date": _millis("ts"),
        },
    )


def unmapped_feed(customer: DataFrame) -> DataFrame:
    """Events of a table without a mapping. Some images are empty or missing,
    and some events do not name their table."""
    return _topic(
        customer,
        topic=CUSTOMERS_TOPIC,
        table="IF(c_custkey % 17 = 3, NULL, 'customers')",
        order="c_custkey",
        op=_first_op("c_custkey"),
        present="c_custkey % 19 <> 3",
        fields={c: f"IF(c_custkey % 5 = 0, NULL, {c})" for c in customer.columns},
    )


def wide_rows_feed(orders: DataFrame) -> DataFrame:
    """Events whose images carry target columns under their own names, with
    values that only some readers accept."""
    return _topic(
        orders,
        topic=WIDE_TOPIC,
        table="'wide_rows'",
        order="o_orderkey",
        op=_first_op("o_orderkey"),
        fields={
            "activity_id": "IF(o_orderkey % 13 = 0, NULL, concat('W', o_orderkey))",
            "candidate": "o_orderpriority",
            "assignment_start_date": _case(
                "o_orderkey % 6",
                _stamp("o_orderdate"),
                _stamp("o_orderdate", "yyyy-M-d H:m:s"),
                "'2023-2-30 23:59:75.25'",
                _stamp("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
                _stamp("o_orderdate", "yyyy-MM-dd"),
            ),
            "adjrevenue": _case(
                "o_orderkey % 5",
                "'12.345'", "'5.'", "' 5.00'",
                "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)",
            ),
            "job_id": "concat('WJ', o_custkey)",
            "jobdiva_no": "concat('JD', o_orderkey % 1000)",
            "company_name": "concat('WC_', o_custkey % 50)",
            "job_title": "o_orderstatus",
            "location": "IF(o_orderkey % 9 = 0, NULL, o_orderpriority)",
            "excluded_reason": "concat('r', o_orderkey % 3)",
            "standard_revenue_report_month": _stamp("o_orderdate", "yyyy-MM"),
            "clienterpid": "concat('E', o_custkey % 7)",
            "bcworkerid": "concat('WB', o_custkey % 200)",
            "assignment_end_date": _stamp("o_orderdate"),
            "sr_assignment_start": _stamp("o_orderdate"),
            "sr_assignment_end": "IF(o_orderkey % 8 = 0, NULL, " + _stamp("o_orderdate") + ")",
            "adjustedstbillrate": "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)",
            "adjustedstpayrate": "'7.25'",
            "adjgphrst": "CAST(o_orderkey % 100 AS STRING)",
            "stbillrate": "concat('-', o_orderkey % 100, '.5')",
        },
    )


def keyed_by_customer_feed(orders: DataFrame) -> DataFrame:
    """Events of four sources that meet on one key, ``activity_id``, some of them
    on shared columns: each image names its source and the target columns it
    writes. Every fifth names a source that is not known."""
    kind = "o_orderkey % 5"

    def own(prefix: str) -> str:
        return f"concat('{prefix}', o_orderkey)"

    return _topic(
        orders,
        topic=WIDE_TOPIC,
        table="'wide_rows'",
        order="o_orderkey",
        op="'c'",
        fields={
            TAG_FIELD: (
                f"element_at(array('job_activity', 'Jobs', 'standard_revenue', "
                f"'Clients_To_Exclude', 'payments'), CAST({kind} + 1 AS INT))"
            ),
            "activity_id": "CAST(o_custkey AS STRING)",
            "candidate": f"IF({kind} IN (0, 4), o_orderpriority, NULL)",
            "job_id": f"CASE {kind} WHEN 0 THEN {own('A')} WHEN 1 THEN {own('J')} END",
            "company_name": f"CASE {kind} WHEN 0 THEN {own('A')} WHEN 3 THEN {own('X')} END",
            "bcworkerid": f"CASE {kind} WHEN 0 THEN {own('A')} WHEN 2 THEN {own('R')} END",
            "job_title": f"IF({kind} = 1 AND o_orderkey % 2 = 0, o_orderstatus, NULL)",
            "excluded_reason": f"IF({kind} = 3, o_orderstatus, NULL)",
            "adjrevenue": f"IF({kind} = 2, o_totalprice, NULL)",
        },
    )


def change_feed(read: Callable[[str], DataFrame]) -> DataFrame:
    """All topics as one feed; ``read`` gives a base table by name."""
    return reduce(DataFrame.unionByName, [
        activity_feed(read("orders")),
        jobs_feed(read("part")),
        exclusions_feed(read("supplier")),
        revenue_feed(read("events")),
        unmapped_feed(read("customer")),
    ])
