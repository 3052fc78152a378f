"""From classified events to rows of the wide target table.

All sources are mapped in one pass over the feed: each target column is one
expression that looks at the row's source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions.convert import (
    clean_datetime,
    decimal_overflow,
    java_trim,
    jdbc_timestamp,
    parse_clean_datetime,
    parse_clean_decimal,
    plain_decimal,
    standard_decimal,
    standard_timestamp,
)
from weirflow.operators.envelope import IMAGE, parse_envelope, usable
from weirflow.schema import (
    DECIMAL_COLUMNS,
    SOURCES,
    SOURCE_NAMES,
    TARGET_COLUMNS,
    TIMESTAMP_COLUMNS,
    target_type,
)

# The columns that order changes; together they must be unique within a feed.
ORDER = ("timestamp", "topic", "partition", "offset")

CONVERTED = (*TIMESTAMP_COLUMNS, *DECIMAL_COLUMNS)


def typed_null(column: str) -> Column:
    return F.lit(None).cast(target_type(column))


def bind_columns(df: DataFrame, *keep: str) -> DataFrame:
    """Bind a frame onto the target by column name; absent columns are NULL."""
    return df.select(
        *keep,
        *[
            (F.col(c).cast(target_type(c)) if c in df.columns else typed_null(c)).alias(c)
            for c in TARGET_COLUMNS
        ],
    )


def _clean(field: str, column: str) -> str:
    """The text of a field that is to be converted, ready for reading."""
    text = f"event.after.{field}"
    return clean_datetime(text) if column in TIMESTAMP_COLUMNS else java_trim(text)


def _clean_fields(sources: Sequence[str]) -> dict[str, str]:
    """Source field -> its cleaned text, for every field that is converted."""
    fields: dict[str, tuple[str, list[str]]] = {}
    for name in sources:
        for column, field in SOURCES[name].columns.items():
            if column in CONVERTED:
                fields.setdefault(field, (column, []))[1].append(name)
    return {
        field: f"IF(by_source IN ({', '.join(repr(u) for u in users)}), "
        f"{_clean(field, column)}, NULL)"
        for field, (column, users) in fields.items()
    }


def _mapped(column: str, field: str) -> str:
    if column in TIMESTAMP_COLUMNS:
        return parse_clean_datetime(f"clean_{field}")
    if column in DECIMAL_COLUMNS:
        return parse_clean_decimal(f"clean_{field}")
    return f"event.after.{field}"


def _bound(column: str) -> str:
    """A column bound by name, its usual form first. Such rows are rare: the lambda
    keeps their conversion out of the generated code of all others, which the JVM
    would no longer compile if it grew too large."""
    text = f"event.after.{column}"
    if column not in CONVERTED:
        return text
    read, usual = (
        (jdbc_timestamp, standard_timestamp) if column in TIMESTAMP_COLUMNS else (plain_decimal, standard_decimal)
    )
    return f"transform(array({text}), x -> coalesce({usual('x')}, {read('x')}))[0]"


def _bindable(sources: Sequence[str]) -> list[str]:
    """Target columns that a row of these sources can fill."""
    return [c for c in TARGET_COLUMNS if any(c in SOURCES[name].columns for name in sources)]


def _target_value(column: str, sources: Sequence[str], bindable: Sequence[str]) -> str:
    whens = [
        f"WHEN by_source = '{name}' THEN {_mapped(column, SOURCES[name].columns[column])}"
        for name in sources
        if column in SOURCES[name].columns
    ]
    if column in bindable:
        whens.append(f"WHEN by_name THEN {_bound(column)}")
    kind = target_type(column).simpleString()
    return f"CASE {' '.join(whens)} END" if whens else f"CAST(NULL AS {kind})"


def _bad_value(sources: Sequence[str], bindable: Sequence[str]) -> str:
    """Whether a value cannot be stored: a decimal out of range, or, where
    columns are bound by name, a text that is not of the column's type."""
    whens = []
    for name in sources:
        decimals = [f for c, f in SOURCES[name].columns.items() if c in DECIMAL_COLUMNS]
        if decimals:
            tests = " OR ".join(f"({decimal_overflow(f'event.after.{f}', f'clean_{f}')})" for f in decimals)
            whens.append(f"WHEN by_source = '{name}' THEN coalesce({tests}, false)")
    unread = " OR ".join(
        f"(event.after.{c} IS NOT NULL AND {_bound(c)} IS NULL)"
        for c in CONVERTED
        if c in bindable
    )
    if unread:
        whens.append(f"WHEN by_name THEN {unread}")
    return f"CASE {' '.join(whens)} ELSE false END" if whens else "false"


def map_events(
    events: DataFrame, bind: str = "tagged", sources: Sequence[str] = SOURCE_NAMES
) -> DataFrame:
    """Map parsed events onto the target: adds ``source_table``, ``reason``, the
    20 target columns and ``bad_value``, true where a value cannot be stored.
    Rows that have a reason get NULLs.

    ``bind`` says which rows of unmapped tables are read by target column name:
    ``tagged``, those that name a known source, or ``all``. Only ``sources`` are
    mapped; naming few of them keeps the plan small.
    """
    if bind not in ("tagged", "all"):
        raise ValueError(f"bind must be 'tagged' or 'all', not {bind!r}")
    by_name = "event.reason IS NULL AND NOT event.mapped"
    if bind == "tagged":
        by_name += " AND event.source_table IS NOT NULL"
    kept = [f"`{c}`" for c in events.columns if c != "event"]
    staged = events.selectExpr(
        *kept,
        "event",
        "IF(event.reason IS NULL AND event.mapped, event.source_table, NULL) AS by_source",
        f"{by_name} AS by_name",
    )
    clean = [f"{text} AS clean_{field}" for field, text in _clean_fields(sources).items()]
    bindable = TARGET_COLUMNS if bind == "all" else _bindable(sources)
    return staged.selectExpr("*", *clean).selectExpr(
        *kept,
        "event.source_table",
        "event.reason",
        *[f"{_target_value(c, sources, bindable)} AS {c}" for c in TARGET_COLUMNS],
        f"{_bad_value(sources, bindable)} AS bad_value",
    )


def map_source(feed: DataFrame, name: str) -> DataFrame:
    """Mapped rows of one source: its own target columns, nothing else."""
    events = usable(parse_envelope(feed)).filter(
        f"event.mapped AND event.source_table = '{name}'"
    )
    kept = [c for c in feed.columns if c != "value"]
    mapped = map_events(events, sources=(name,))
    return mapped.select(*kept, "source_table", *SOURCES[name].owned)


def matching_key(feed: DataFrame) -> DataFrame:
    """``matching_key``: which target rows an event updates, as a map with the
    NULL parts left out; empty for tables without a mapping."""
    events = parse_envelope(feed, before=True).filter(
        f"event.readable AND {IMAGE} IS NOT NULL AND event.table_name IS NOT NULL"
    )
    whens = []
    for source in SOURCES.values():
        parts = ", ".join(
            f"'{c}', {IMAGE}.{source.columns[c]}" for c in source.match_on
        )
        whens.append(
            f"WHEN event.mapped AND event.source_table = '{source.name}' "
            f"THEN map_filter(map({parts}), (k, v) -> v IS NOT NULL)"
        )
    key = f"CASE {' '.join(whens)} ELSE CAST(map() AS MAP<STRING, STRING>) END"
    kept = [c for c in feed.columns if c != "value"]
    return events.select(
        *kept, "event.source_table", F.expr(key).alias("matching_key")
    )


# --- sinks -----------------------------------------------------------------


def _sink_value(column: str, literals: bool, sources: Sequence[str]) -> str:
    """A target column as its source's sink writes it."""
    whens = []
    for source in map(SOURCES.get, sources):
        here = f"WHEN source_table = '{source.name}' THEN"
        filled = source.placeholders.get(column)
        if filled is not None:
            copied = filled[1:] if filled.startswith("@") else f"'{filled}'"
            if literals:
                whens.append(f"{here} {copied}")
            elif column == "activity_id":
                whens.append(f"{here} coalesce({column}, {copied})")
        elif column not in source.columns:
            # a row bound by name may carry columns its sink does not write
            whens.append(f"{here} NULL")
    return f"CASE {' '.join(whens)} ELSE {column} END" if whens else column


def to_sink(
    mapped: DataFrame, literals: bool = True, sources: Sequence[str] = SOURCE_NAMES
) -> DataFrame:
    """The row each event writes: only its source's columns, with placeholder
    keys where the source has no value of its own.

    With ``literals=False`` only a missing ``activity_id`` is filled, so that a
    column-wise merge does not overwrite real values with placeholders.
    ``reason`` is extended with the sink's own: ``unknown_table``, ``bad_value``
    and ``null_key``.
    """
    values = {c: _sink_value(c, literals, sources) for c in TARGET_COLUMNS}
    values["reason"] = (
        "coalesce(reason, CASE WHEN source_table IS NULL THEN 'unknown_table' "
        f"WHEN bad_value THEN 'bad_value' WHEN {values['activity_id']} IS NULL THEN 'null_key' END)"
    )
    kept = [f"`{c}`" for c in mapped.columns if c not in values]
    return mapped.selectExpr(*kept, *[f"{value} AS {c}" for c, value in values.items()])


def to_full_row(mapped: DataFrame) -> DataFrame:
    """The row each event writes when all 20 columns are bound by name, with no
    placeholder keys and no regard to the source."""
    reason = (
        "coalesce(reason, CASE WHEN bad_value THEN 'bad_value' "
        "WHEN activity_id IS NULL THEN 'null_key' END)"
    )
    return mapped.withColumn("reason", F.expr(reason))


def _events(feed: DataFrame, event_time: bool) -> DataFrame:
    """Parsed events, on request with the time their source wrote them, ``ts_ms``,
    to be used as the first order column."""
    events = parse_envelope(feed)
    return events.withColumn("ts_ms", F.col("event.ts_ms")) if event_time else events


def audited_rows(
    feed: DataFrame, sink: str = "selective", literals: bool = True, event_time: bool = False
) -> DataFrame:
    """One row per event of the feed: its target columns, and ``reason`` where
    it does not reach the target."""
    return _sink_rows(_events(feed, event_time), sink, literals, SOURCE_NAMES)


def _sink_rows(
    events: DataFrame, sink: str, literals: bool, sources: Sequence[str]
) -> DataFrame:
    if sink == "selective":
        rows = to_sink(map_events(events, sources=sources), literals, sources)
    elif sink == "full_row":
        rows = to_full_row(map_events(events, bind="all"))
    else:
        raise ValueError(f"sink must be 'selective' or 'full_row', not {sink!r}")
    kept = [c for c in events.columns if c not in ("value", "event")]
    return rows.select(*kept, "source_table", "reason", *TARGET_COLUMNS)


def changes(
    feed: DataFrame,
    sink: str = "selective",
    literals: bool = True,
    sources: Sequence[str] = SOURCE_NAMES,
    event_time: bool = False,
) -> DataFrame:
    """The rows of a feed that reach the target, in no particular order; with
    the selective sink only those of ``sources``. With ``event_time`` they carry
    ``ts_ms``; merge them with ``order=("ts_ms", *ORDER)``."""
    events = usable(_events(feed, event_time))
    if sink == "selective":
        events = events.filter(F.col("event.source_table").isin(*sources))
    return accepted(_sink_rows(events, sink, literals, sources))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull()).drop("reason")


def rejected(rows: DataFrame) -> DataFrame:
    """Mapped rows that the sink could not store."""
    return rows.filter(F.col("reason").isin("bad_value", "null_key"))


def drop_audit(rows: DataFrame) -> DataFrame:
    """Events per outcome; ``accepted`` for those that reach the target."""
    return rows.groupBy(
        F.coalesce(F.col("reason"), F.lit("accepted")).alias("reason")
    ).agg(F.count("*").alias("events"))


def keyless_revenue(feed: DataFrame) -> DataFrame:
    """Revenue rows without key columns. None can be stored: each is returned
    with its ten columns and the reason ``null_key``."""
    kept = [c for c in feed.columns if c != "value"]
    rows = map_source(feed, "standard_revenue").drop("source_table")
    return rows.select(
        *kept,
        *SOURCES["standard_revenue"].owned,
        F.lit("null_key").alias("reason"),
    )
