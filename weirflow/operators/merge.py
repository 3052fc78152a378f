"""Merging changes into the keyed target.

``changes`` are sink rows: the target's columns, ``source_table`` and the
columns that order them. Every rule of :func:`merge` is a function of the *set*
of changes, so replaying, reordering or re-batching a feed gives the same table,
and compacted changes can be merged again with later ones. :func:`match_existing`
alone updates a table whose changes are no longer at hand; it depends on batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from weirflow.operators.mapping import ORDER
from weirflow.operators.skew import hot_keys, spread_join
from weirflow.schema import COMPOSITE_KEY, SOURCES, TARGET_COLUMNS, TARGET_KEY

MODES = ("append", "replace_row", "full_row", "partial", "match_update")


def last_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER
) -> DataFrame:
    """The last row of each key.

    Spark keeps only each task's last row per key before the shuffle, so a key
    that holds a large share of the rows sends at most one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        rows.withColumn("__rank", F.row_number().over(window))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )


# Columns by which some rule tells rows of one source apart: the key columns of
# both key sets and the matching keys.
TOLD_APART = tuple(dict.fromkeys(
    [*COMPOSITE_KEY, *(c for s in SOURCES.values() for c in s.match_on)]
))


def compact(
    changes: DataFrame, keys: Sequence[str] = TARGET_KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """Drop changes that no merge rule but ``append`` can see.

    Rules look at the last change per key, per source and per matching key, with
    or without a client. Each of those is the last of its own combination of
    source, key columns and matching columns, of which all are kept here. Other
    key columns than the two key sets must be named in ``keys``. The result is a
    set of changes again.
    """
    return last_per_key(
        changes, ["source_table", *dict.fromkeys([*keys, *TOLD_APART])], order
    )


def append(changes: DataFrame) -> DataFrame:
    return changes.select(*TARGET_COLUMNS)


def replace_row(
    changes: DataFrame, keys: Sequence[str] = TARGET_KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """The last change of a key replaces the whole row; columns that it does not
    carry become NULL."""
    return last_per_key(changes, keys, order).select(*TARGET_COLUMNS)


def _owner_groups(keys: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Sources that may write a column -> the columns they share."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for column in TARGET_COLUMNS:
        owners = tuple(s.name for s in SOURCES.values() if column in s.columns)
        if column not in keys:
            groups.setdefault(owners, []).append(column)
    return groups


def partial(
    changes: DataFrame, keys: Sequence[str] = TARGET_KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """A change overwrites only the columns its source owns, with NULL too; the
    others keep their value.

    One aggregate per group of columns with the same owners. Partial results
    are combined before the shuffle.
    """
    groups = _owner_groups(keys)
    position = f"struct({', '.join(order)})"
    aggregates = []
    placed = {key: key for key in keys}
    for owners, columns in groups.items():
        name = "__".join(owners)
        sources = ", ".join(f"'{o}'" for o in owners)
        aggregates.append(F.expr(
            f"max_by(struct({', '.join(columns)}), "
            f"IF(source_table IN ({sources}), {position}, NULL))"
        ).alias(name))
        placed |= {column: f"{name}.{column}" for column in columns}
    merged = changes.groupBy(*keys).agg(*aggregates)
    return merged.selectExpr(*[f"{placed[c]} AS {c}" for c in TARGET_COLUMNS])


Changes = DataFrame | Mapping[str, DataFrame]


def _of_source(changes: Changes, source: str) -> DataFrame:
    if isinstance(changes, Mapping):
        changes = changes[source]
    return changes.filter(F.col("source_table") == source)


def _merge_activity(
    target: DataFrame | None, changes: Changes, order: Sequence[str]
) -> DataFrame:
    """Existing rows with their own changes applied, plus rows not seen before."""
    owned = SOURCES["job_activity"].owned
    fresh = replace_row(_of_source(changes, "job_activity"), TARGET_KEY, order)
    if target is None:
        return fresh
    new, old = fresh.alias("new"), target.select(*TARGET_COLUMNS).alias("old")
    both = old.join(new, F.expr("old.activity_id = new.activity_id"), "full")
    return both.selectExpr(*[
        f"IF(new.activity_id IS NULL, old.{c}, new.{c}) AS {c}" if c in owned else f"old.{c}"
        for c in TARGET_COLUMNS
    ])


def _overwrite(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Set ``columns`` from the struct ``change`` where there is one."""
    return rows.selectExpr(*[
        f"IF(change IS NULL, {c}, change.{c}) AS {c}" if c in columns else c
        for c in TARGET_COLUMNS
    ])


def _last_change(
    changes: Changes, source: str, key: str, order: Sequence[str]
) -> DataFrame:
    """The last change of one source per matching key, as ``(key, change)``."""
    rows = _of_source(changes, source).filter(F.col(key).isNotNull())
    carried = [c for c in SOURCES[source].owned if c != key]
    return last_per_key(rows, [key], order).select(key, F.struct(*carried).alias("change"))


def _last_revenue(
    changes: Changes, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key, the last revenue change of all, and the last without a client."""
    carried = [c for c in SOURCES["standard_revenue"].owned if c != "bcworkerid"]
    position = f"struct({', '.join(order)})"
    rows = _of_source(changes, "standard_revenue").filter(
        " AND ".join(f"{key} IS NOT NULL" for key in keys)
    )
    return rows.selectExpr(
        *keys,
        f"struct({position} AS position, {', '.join(carried)}) AS change",
        f"{position} AS position",
        f"IF(clienterpid IS NULL, {position}, NULL) AS position_no_client",
    ).groupBy(*keys).agg(
        F.max_by("change", "position").alias("any_client"),
        F.max_by("change", "position_no_client").alias("no_client"),
    )


def _matched(
    rows: DataFrame, changes: Changes, order: Sequence[str], by_client: bool
) -> DataFrame:
    """``rows`` with the last matching change of each other source applied."""
    pair = ("bcworkerid", "clienterpid")
    key_sets = [("job_id",), ("company_name",), ("bcworkerid",)]
    if by_client:
        key_sets.append(pair)
    hot = dict(zip(key_sets, hot_keys(rows, key_sets)))

    def joined(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
        return spread_join(left, right, keys, spread_by="activity_id", hot=hot[keys])

    jobs = _last_change(changes, "jobs", "job_id", order)
    rows = _overwrite(joined(rows, jobs, "job_id"), ("job_title", "location"))
    clients = _last_change(changes, "clients_to_exclude", "company_name", order)
    rows = _overwrite(joined(rows, clients, "company_name"), ("excluded_reason",))
    rows = joined(rows, _last_revenue(changes, ["bcworkerid"], order), "bcworkerid")
    change = "any_client"
    if by_client:
        same = _last_revenue(changes, pair, order).selectExpr(*pair, "any_client AS same_client")
        rows = joined(rows, same, *pair)
        change = (
            "CASE WHEN clienterpid IS NULL THEN any_client "
            "WHEN same_client IS NULL THEN no_client "
            "WHEN no_client.position > same_client.position THEN no_client "
            "ELSE same_client END"
        )
    revenue = [c for c in SOURCES["standard_revenue"].owned if c != "bcworkerid"]
    return _overwrite(rows.withColumn("change", F.expr(change)), revenue)


def match_update(changes: Changes, order: Sequence[str] = ORDER) -> DataFrame:
    """A change updates every row that has its matching key; only activity
    changes add rows.

    Rows are those of the last activity changes, and the last matching change of
    each other source wins, whichever of the two came first. No activity change
    carries a client, so by the set of changes alone a revenue change matches on
    the worker.

    ``changes`` are mapped with ``literals=False``, so that no placeholder takes
    part in the matching. Give them per source where the feeds are separate:
    each is then read once.
    """
    return _matched(_merge_activity(None, changes, order), changes, order, by_client=False)


def match_existing(
    table: DataFrame, changes: Changes, order: Sequence[str] = ORDER
) -> DataFrame:
    """A merged table after one batch of ``changes``, for where the changes that
    made it are gone.

    Matching looks at the rows as they are after the batch's activity changes. A
    revenue change matches on the worker, and on the client only where both the
    row and the change have one. What an earlier batch could not match is lost.
    """
    return _matched(_merge_activity(table, changes, order), changes, order, by_client=True)


def _with_earlier(changes: Changes, earlier: DataFrame) -> Changes:
    if not isinstance(changes, Mapping):
        return earlier.unionByName(changes)
    return {
        name: earlier.filter(F.col("source_table") == name).unionByName(rows)
        for name, rows in changes.items()
    }


def merge(
    changes: Changes,
    mode: str = "replace_row",
    keys: Sequence[str] = TARGET_KEY,
    order: Sequence[str] = ORDER,
    target: DataFrame | None = None,
) -> DataFrame:
    """The target after ``changes``, under one of :data:`MODES`.

    ``target`` are the changes kept so far (see :func:`compact`).
    ``full_row`` is ``replace_row`` over rows mapped with ``sink="full_row"``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if target is not None:
        changes = _with_earlier(changes, target)
    if mode == "match_update":
        return match_update(changes, order)
    if mode == "append":
        return append(changes)
    if mode == "partial":
        return partial(changes, keys, order)
    return replace_row(changes, keys, order)
