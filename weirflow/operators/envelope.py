"""From change-event text to classified events.

A feed is any DataFrame, batch or streaming, with the columns of a message
topic: ``value`` (the event as JSON text), ``topic``, ``partition``, ``offset``
and ``timestamp``. Further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from weirflow.schema import (
    CORRUPT_FIELD,
    DELETE_OPS,
    OPEN_ENVELOPE_SCHEMA,
    SOURCE_NAMES,
    TAG_FIELD,
    envelope_schema,
)

# Strict JSON: no single quotes, no bare NaN or Infinity.
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _quoted(values: Iterable[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# SQL text over a raw event and its lower-case table name.
_RAW, _TABLE = "__parsed.raw", "__table"
_LOWER_TABLE = (
    # most names are in lower case already
    f"IF({_RAW}.source.table IN ({_quoted(SOURCE_NAMES)}), {_RAW}.source.table, lower({_RAW}.source.table))"
)
_TAG = f"lower({_RAW}.after.`{TAG_FIELD}`)"
_IS_DELETE = f"coalesce({_RAW}.op IN ({_quoted(DELETE_OPS)}), false)"
_IS_MAPPED = f"coalesce({_TABLE} IN ({_quoted(SOURCE_NAMES)}), false)"
_EVENT_FIELDS = {
    "op": f"{_RAW}.op",
    "ts_ms": f"try_cast({_RAW}.source.ts_ms AS BIGINT)",
    "raw_table": f"{_RAW}.source.table",
    # routing ignores case
    "table_name": _TABLE,
    "is_delete": _IS_DELETE,
    # whether the table has a mapping
    "mapped": _IS_MAPPED,
    # the source whose sink takes the event: its table, or the tag that an
    # unmapped row carries
    "source_table": (
        f"CASE WHEN {_IS_MAPPED} THEN {_TABLE} "
        f"WHEN {_TABLE} IS NOT NULL AND {_TAG} IN ({_quoted(SOURCE_NAMES)}) THEN {_TAG} END"
    ),
    # why the event cannot be used, in the order in which it is found out
    "reason": (
        f"CASE WHEN {_RAW}.{CORRUPT_FIELD} IS NOT NULL THEN 'parse_error' "
        f"WHEN {_IS_DELETE} THEN 'delete' "
        f"WHEN {_RAW}.after IS NULL THEN 'no_image' "
        f"WHEN {_RAW}.source.table IS NULL THEN 'no_table' "
        "WHEN __parsed.empty THEN 'empty_image' END"
    ),
    "readable": f"{_RAW}.{CORRUPT_FIELD} IS NULL",
    "after": f"{_RAW}.after",
}


# Whether the image of a raw event ``e`` has no field at all. This reads the text again, but
# only where the table has no mapping.
_IS_EMPTY = (
    f"e.after IS NOT NULL AND NOT coalesce(lower(e.source.table) IN ({_quoted(SOURCE_NAMES)}), true) "
    "AND get_json_object(value, '$.after') = '{}'"
)


def parse_envelope(feed: DataFrame, before: bool = False) -> DataFrame:
    """Add ``event``: the parsed change event and how it is routed.

    Fields: ``op``, ``ts_ms``, ``raw_table``, ``table_name``, ``is_delete``,
    ``mapped``, ``source_table``, ``reason`` (NULL if usable), ``readable``,
    ``after`` and, on request, ``before``.

    The one-element ``explode``s keep the parse, the table name and the routing in steps of
    their own. Without them the optimizer copies each into every later filter and column that
    looks at it, and does the work several times per row. The routing holds no lambda, so
    that it is generated code.
    """
    schema = envelope_schema(before).simpleString()
    options = {"columnNameOfCorruptRecord": CORRUPT_FIELD, **STRICT_JSON}
    fields = _EVENT_FIELDS | ({"before": f"{_RAW}.before"} if before else {})
    struct = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    parsed = f"from_json(value, '{schema}', map({_quoted(sum(options.items(), ()))}))"
    parsed = f"transform(array({parsed}), e -> named_struct('raw', e, 'empty', {_IS_EMPTY}))"
    return (
        feed.select("*", F.expr(f"explode({parsed})").alias("__parsed"))
        .select("*", F.expr(f"explode(array({_LOWER_TABLE}))").alias(_TABLE))
        .select(*[F.col(f"`{c}`") for c in feed.columns], F.expr(f"explode(array(named_struct({struct})))").alias("event"))
    )


# The image an event carries: ``before`` of a delete, else ``after``.
IMAGE = "IF(event.is_delete, event.before, event.after)"


def usable(events: DataFrame) -> DataFrame:
    return events.filter("event.reason IS NULL")


def image_select(feed: DataFrame) -> DataFrame:
    """Every readable event with the row image it carries, deletes included."""
    events = parse_envelope(feed, before=True).filter("event.readable")
    return events.select(
        *[c for c in feed.columns if c != "value"],
        "event.op",
        "event.table_name",
        F.expr(IMAGE).alias("image"),
    )


# A map in which a repeated field has its last value.
_LAST_OF_EACH = (
    "IF(size(array_distinct(map_keys(m))) = size(m), m, map_from_entries(transform(array_distinct(map_keys(m)), "
    "k -> named_struct('key', k, 'value', element_at(filter(map_entries(m), e -> e.key = k), -1).value))))"
)


def passthrough(feed: DataFrame) -> DataFrame:
    """Events of tables without a mapping, with every field of the row image in
    the map ``image``; of a repeated field the last value.

    The text is parsed once, with the image as a map; see :func:`parse_envelope`
    for the one-element ``explode``.
    """
    options = {"columnNameOfCorruptRecord": CORRUPT_FIELD, **STRICT_JSON}
    parsed = f"from_json(value, '{OPEN_ENVELOPE_SCHEMA}', map({_quoted(sum(options.items(), ()))}))"
    usable_here = (
        f"{_RAW}.{CORRUPT_FIELD} IS NULL AND NOT {_IS_DELETE} AND size({_RAW}.after) > 0 "
        f"AND {_RAW}.source.table IS NOT NULL AND NOT {_IS_MAPPED}"
    )
    event = (
        f"transform(array(named_struct('raw', {parsed})), __parsed -> "
        f"transform(array(lower({_RAW}.source.table)), {_TABLE} -> "
        f"named_struct('table_name', {_TABLE}, 'usable', coalesce({usable_here}, false), "
        f"'image', transform(array({_RAW}.after), m -> {_LAST_OF_EACH})[0]))[0])"
    )
    return feed.select("*", F.expr(f"explode({event})").alias("event")).filter("event.usable").select(
        *[c for c in feed.columns if c != "value"], "event.table_name", "event.image"
    )
