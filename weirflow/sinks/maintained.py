"""A stored target that is kept up to date batch by batch.

What is stored are changes, hash-distributed over buckets by key and sorted by it. A batch is
reduced to the changes that its merge rule can see and laid, as one more layer, over the buckets in which it has
keys; nothing that is stored is read or written again. Deletes are layers, too: marks with the
key and its last position, applied by readers. Buckets with many layers are folded into one.
A commit (see :mod:`weirflow.sinks.commits`) names the layers of each bucket and the last
batch of each run, in one step: a batch is in the target once or not at all, however often it
is delivered and wherever its writer stops.

Readers see a bucketed Spark table over the layers of one snapshot, so that merging them needs
no exchange.

In ``match_update`` a change may update rows of any key. Two more tables serve it: ``matches``, the last
change of each matching key, and ``places``, an index from each matching key of a row to the
row's bucket. New matching changes are turned into changes of the rows that they match, found
in the buckets that the index names; new rows take what ``matches`` has for them. Other
buckets are left alone. Such a change of a row counts as long as the row has the matching key
it was made for.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from weirflow.operators import mapping
from weirflow.operators.mapping import ORDER
from weirflow.operators.merge import MODES, last_per_key, merge
from weirflow.schema import SOURCES, TARGET_COLUMNS, TARGET_KEY, target_type
from weirflow.sinks.commits import Conflict, Snapshot, commit, latest, store_of
from weirflow.sinks.parquet import BUCKETS, found_paths, finished_after, read_log

#: Layers from which on a bucket is folded, and tries of a transaction that others overtake.
LAYERS, TRIES = 8, 20

_TARGET = [T.StructField(c, target_type(c)) for c in TARGET_COLUMNS]
_ORDER = [
    T.StructField("timestamp", T.TimestampType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
]
_KIND = [T.StructField("kind", T.StringType()), T.StructField("match_key", T.StringType())]
SCHEMAS = {
    # ``deleted`` marks a delete, by predicate, of the key's rows as they were at its position
    "rows": T.StructType([
        *_TARGET, T.StructField("source_table", T.StringType()), *_ORDER, T.StructField("deleted", T.BooleanType()),
    ]),
    "matches": T.StructType([*_KIND, *_ORDER, *_TARGET]),
    "places": T.StructType([*_KIND, T.StructField("place", T.IntegerType())]),
}
#: The column by which each source's changes match rows, and what they overwrite.
MATCHED = {
    "jobs": ("job_id", ("job_title", "location")),
    "clients_to_exclude": ("company_name", ("excluded_reason",)),
    "standard_revenue": ("bcworkerid", tuple(c for c in SOURCES["standard_revenue"].owned if c != "bcworkerid")),
}

manifest = latest


def _position() -> Column:
    return F.struct(*ORDER)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket that Spark's own bucketing gives a key."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _keys(known: Snapshot, table: str) -> tuple[str, ...]:
    return known.keys if table == "rows" else ("kind", "match_key")


# --- stored tables -------------------------------------------------------------


def _stored(spark: SparkSession, path: str, known: Snapshot, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """An inner table as of a snapshot, some buckets or all; only their folders are read."""
    schema = T.StructType([*SCHEMAS[table].fields, T.StructField("bucket", T.IntegerType()), T.StructField("layer", T.StringType())])
    layers = known.layers.get(table, {})
    if not layers or buckets is not None and not any(b in layers for b in buckets):
        return spark.createDataFrame([], schema)
    name = f"maintained_{hashlib.sha1(path.encode()).hexdigest()[:12]}_{known.token}_{table}"
    if not spark.catalog.tableExists(name):
        keys = ", ".join(_keys(known, table))
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (bucket, layer) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {known.buckets} BUCKETS LOCATION '{path}/layers/{table}'"
        )
        parts = [
            f"PARTITION (bucket={b}, layer='{layer}') LOCATION '{path}/layers/{table}/{layer}/bucket={b}'"
            for b, own in sorted(layers.items()) for layer in own
        ]
        for k in range(0, len(parts), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts[k : k + 500])}")
    rows = spark.table(name)
    return rows if buckets is None else rows.filter(F.col("bucket").isin(sorted(set(buckets))))


def _laid(rows: DataFrame, path: str, known: Snapshot, table: str) -> tuple[str, list[int]]:
    """Write rows as a layer of their own, not yet part of any snapshot; its name and its buckets."""
    spark, layer, keys = rows.sparkSession, uuid.uuid4().hex, _keys(known, table)
    folder, name = f"{path}/layers/{table}/{layer}", f"layer_{layer}"
    writer = (
        rows.select(*SCHEMAS[table].names, bucket_of(keys, known.buckets).alias("bucket"))
        .hint("rebalance", "bucket")  # even parts: a bucket that is large for one task is written by several
        .write.format("parquet").mode("overwrite").option("path", folder)
        .partitionBy("bucket").bucketBy(known.buckets, *keys).sortBy(*keys)
    )
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # of the catalog; the files stay
    return layer, [int(p.rsplit("=", 1)[1]) for p in found_paths(spark, f"{folder}/bucket=*")]


def _with_rows(rows: DataFrame, path: str, known: Snapshot, table: str) -> Snapshot:
    return known.with_layer(table, *_laid(rows, path, known, table))


# --- merging what is stored ----------------------------------------------------


def _live(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes that come after the last delete of their key."""
    gone = F.max(F.when(F.col("deleted"), _position())).over(Window.partitionBy(*keys))
    return rows.withColumn("__gone", gone).filter(
        ~F.col("deleted") & (F.col("__gone").isNull() | (_position() > F.col("__gone")))
    ).drop("__gone")


def _matching(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes of rows: the activity changes that count, and those of other sources made for the key the row has."""
    activity = F.col("source_table") == "job_activity"
    gone = F.max(F.when(F.col("deleted"), _position())).over(Window.partitionBy(*keys))
    rows = rows.withColumn("__gone", gone).filter(
        ~F.col("deleted") & (~activity | F.col("__gone").isNull() | (_position() > F.col("__gone")))
    ).drop("__gone")
    columns = [column for column, _ in MATCHED.values()]
    base = F.max_by(F.struct(*columns), F.when(activity, _position())).over(Window.partitionBy(*keys))
    held = reduce(
        lambda a, b: a | b,
        [(F.col("source_table") == s) & (F.col(c) == F.col(f"__base.{c}")) for s, (c, _) in MATCHED.items()],
    )
    return rows.withColumn("__base", base).filter(F.col("__base").isNotNull() & (activity | held)).drop("__base")


def _matched_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target of ``match_update`` from changes of its rows."""

    def last(source: str, columns: Sequence[str]) -> Column:
        return F.max_by(F.struct(*columns), F.when(F.col("source_table") == source, _position()))

    owned = [c for c in SOURCES["job_activity"].owned if c not in keys]
    found = _matching(rows, keys).groupBy(*keys).agg(
        last("job_activity", owned).alias("job_activity"),
        *(last(s, columns).alias(s) for s, (_, columns) in MATCHED.items()),
    )
    place = {c: F.col(c) for c in keys} | {c: F.col(f"job_activity.{c}") for c in owned}
    for source, (_, columns) in MATCHED.items():
        for c in columns:
            own = place.get(c, F.lit(None).cast(target_type(c)))
            place[c] = F.when(F.col(source).isNull(), own).otherwise(F.col(f"{source}.{c}"))
    return found.select(*(place[c].alias(c) for c in TARGET_COLUMNS))


def _merged(rows: DataFrame, known: Snapshot) -> DataFrame:
    if known.mode == "match_update":
        return _matched_rows(rows, known.keys)
    return merge(_live(rows, known.keys).drop("bucket", "layer", "deleted"), known.mode, known.keys)


def _reduced(rows: DataFrame, known: Snapshot) -> DataFrame:
    """The changes, and delete marks, that later reads can still see."""
    keys = list(known.keys)
    marks = last_per_key(rows.filter("deleted"), keys)
    if known.mode == "match_update":
        kept = last_per_key(_matching(rows, keys), [*keys, "source_table"])
    else:
        per = keys if known.mode in ("replace_row", "full_row") else [*keys, "source_table"]
        kept = last_per_key(_live(rows, keys), per)
    return kept.unionByName(marks)


# --- transactions --------------------------------------------------------------


def _begun(spark: SparkSession, path: str, mode: str, keys: Sequence[str], buckets: int) -> Snapshot:
    if mode not in MODES or mode == "append":
        raise ValueError(f"a maintained target cannot have mode {mode!r}")
    if mode == "match_update" and tuple(keys) != TARGET_KEY:
        raise ValueError(f"the key of a target of this mode is {TARGET_KEY}")
    known = latest(spark, path) or Snapshot(0, mode, tuple(keys), buckets)
    if (known.mode, known.keys, known.buckets) != (mode, tuple(keys), buckets):
        raise ValueError(f"this target has {known.mode}, {known.keys}, {known.buckets} buckets")
    return known


def _transaction(spark: SparkSession, path: str, work: Callable[[], Snapshot | None]) -> Snapshot | None:
    """Commit what ``work`` makes of the latest snapshot; again from the start if another writer was faster."""
    for attempt in range(TRIES):
        made = work()
        if made is None:
            return None
        try:
            return commit(spark, path, made)
        except Conflict:
            time.sleep(min(0.05 * 2**attempt, 5))
    raise Conflict(f"{path}: overtaken {TRIES} times")


def _positioned(changes: DataFrame) -> DataFrame:
    return changes.select(*TARGET_COLUMNS, "source_table", *ORDER, F.lit(False).alias("deleted"))


def _worked_in(changes: DataFrame, path: str, known: Snapshot) -> Snapshot:
    """A snapshot with the changes, laid over the buckets that they concern."""
    rows = _positioned(changes)
    if known.mode == "match_update":
        return _matched_in(rows, path, known)
    per = known.keys if known.mode in ("replace_row", "full_row") else [*known.keys, "source_table"]
    return _with_rows(last_per_key(rows, per), path, known, "rows")


def _translated(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Changes of the given rows, one for each match that they have."""
    parts = []
    for source, (column, columns) in MATCHED.items():
        own = matches.filter(F.col("kind") == source).select(
            F.col("match_key").alias("__key"), *ORDER, *(F.col(c).alias(f"__{c}") for c in columns)
        )
        ids = rows.select(*TARGET_KEY, F.col(column).alias("__key"))
        parts.append(ids.join(own, "__key").select(
            *(
                F.col(c) if c in TARGET_KEY else F.col("__key").alias(c) if c == column
                else F.col(f"__{c}").alias(c) if c in columns else F.lit(None).cast(target_type(c)).alias(c)
                for c in TARGET_COLUMNS
            ),
            F.lit(source).alias("source_table"), *ORDER, F.lit(False).alias("deleted"),
        ))
    return reduce(DataFrame.unionByName, parts)


def _by_kind(rows: DataFrame, chosen: Callable[[str, str], Column], *columns) -> DataFrame:
    """Per source that matches: its kind, the matching key, and some columns, of the rows chosen for it."""
    return reduce(DataFrame.unionByName, [
        rows.filter(chosen(source, column) & F.col(column).isNotNull()).select(
            F.lit(source).alias("kind"), F.col(column).alias("match_key"), *columns
        )
        for source, (column, _) in MATCHED.items()
    ])


def _matched_in(rows: DataFrame, path: str, known: Snapshot) -> Snapshot:
    """A batch of ``match_update``: its matches, its rows, and what each changes about the other."""
    spark = rows.sparkSession
    staging = f"{path}/staging/{uuid.uuid4().hex}"
    rows.write.parquet(staging)  # parsed once
    rows = spark.read.schema(SCHEMAS["rows"]).parquet(staging)
    fresh = last_per_key(rows.filter(F.col("source_table") == "job_activity"), TARGET_KEY)
    columns = [*ORDER, *TARGET_COLUMNS]
    news = last_per_key(_by_kind(rows, lambda s, _: F.col("source_table") == s, *columns), ["kind", "match_key"])
    made = _with_rows(news, path, known, "matches")
    news = _stored(spark, path, replace(made, layers={"matches": _only_new(made, known, "matches")}, token=uuid.uuid4().hex), "matches")
    # stored rows that the new matches concern: in the buckets that the index names
    slots = [r["bucket"] for r in news.select("bucket").distinct().collect()]  # buckets at most
    named = _stored(spark, path, known, "places", slots).join(news.select("kind", "match_key"), ["kind", "match_key"], "left_semi")
    touched = [r["place"] for r in named.select("place").distinct().collect()]
    old = last_per_key(
        _live(_stored(spark, path, known, "rows", touched), known.keys).filter(F.col("source_table") == "job_activity"), known.keys
    )
    matches = last_per_key(_stored(spark, path, made, "matches"), ["kind", "match_key"])
    laid = fresh.select(*SCHEMAS["rows"].names).unionByName(_translated(old, news)).unionByName(_translated(fresh, matches))
    made = _with_rows(laid, path, made, "rows")
    places = _by_kind(fresh, lambda s, c: F.lit(True), bucket_of(known.keys, known.buckets).alias("place")).distinct()
    made = _with_rows(places, path, made, "places")
    folder, store = store_of(spark, staging)
    store.delete(folder, True)
    return made


def _only_new(made: Snapshot, known: Snapshot, table: str) -> dict[int, tuple[str, ...]]:
    before = known.layers.get(table, {})
    return {b: new for b, ls in made.layers.get(table, {}).items() if (new := ls[len(before.get(b, ())) :])}


def apply_changes(
    changes: DataFrame,
    path: str,
    run: str,
    batch_id: int,
    mode: str = "replace_row",
    keys: Sequence[str] = TARGET_KEY,
    buckets: int = BUCKETS,
) -> bool:
    """Work one batch of a run into the target, whole or not at all; False if it has been before.

    ``mode``, ``keys`` and ``buckets`` are set by the first batch, and later ones that name others
    are refused. The batches of a run come in order; different runs may write at the same time.
    """
    spark = changes.sparkSession

    def work() -> Snapshot | None:
        known = _begun(spark, path, mode, keys, buckets)
        if batch_id <= known.marks.get(run, -1):
            return None
        return _worked_in(changes, path, known).with_mark(run, batch_id)

    done = _transaction(spark, path, work) is not None
    if done:
        fold(spark, path)
    return done


def target_writer(
    path: str,
    run: str,
    mode: str = "replace_row",
    keys: Sequence[str] = TARGET_KEY,
    buckets: int = BUCKETS,
    sink: str = "selective",
    literals: bool = True,
) -> Callable[[DataFrame, int], None]:
    """A function that works one micro-batch of a feed into the target; a batch delivered again changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        apply_changes(mapping.changes(batch, sink, literals), path, run, batch_id, mode, keys, buckets)

    return write


def refresh_target(
    spark: SparkSession,
    log: str,
    path: str,
    mode: str = "replace_row",
    keys: Sequence[str] = TARGET_KEY,
    buckets: int = BUCKETS,
) -> int:
    """Work the log's new finished batches into the target; how many there were.

    ``mode``, ``keys`` and ``buckets`` are set by the first refresh, and later ones
    that name others are refused. Of each run the batches after its mark count, up to the first
    that is not finished.
    """
    count = 0

    def work() -> Snapshot | None:
        nonlocal count
        known = _begun(spark, path, mode, keys, buckets)
        new = finished_after(spark, log, known.marks)
        count = len(new)
        if not new:
            return None
        made = _worked_in(read_log(spark, log, batches=sorted(new)), path, known)
        for run, batch in new:
            made = made.with_mark(run, batch)
        return made

    if _transaction(spark, path, work) is not None:
        fold(spark, path)
    return count


def fold(spark: SparkSession, path: str, layers: int = LAYERS) -> int:
    """Fold the buckets that have ``layers`` layers or more into one each; how many buckets there were."""
    count = 0

    def work() -> Snapshot | None:
        nonlocal count
        known = made = latest(spark, path)
        count = 0
        for table, by in known.layers.items() if known else ():
            high = [b for b, own in by.items() if len(own) >= layers]
            if not high:
                continue
            rows = _stored(spark, path, known, table, high)
            if table == "rows":
                rows = _reduced(rows, known)
            elif table == "matches":
                rows = last_per_key(rows, ["kind", "match_key"])
            else:
                rows = rows.select("kind", "match_key", "place").distinct()
            layer, written = _laid(rows, path, known, table)
            made = made.with_folded(table, layer, high, written)
            count += len(high)
        return made if count else None

    _transaction(spark, path, work)
    return count


# --- readers -------------------------------------------------------------------


def read_maintained(spark: SparkSession, path: str) -> DataFrame:
    """The target as of its last commit."""
    known = latest(spark, path)
    return _merged(_stored(spark, path, known, "rows"), known)


def maintained_rows(spark: SparkSession, path: str, keys: Sequence[dict[str, str]]) -> DataFrame:
    """The rows of some keys, each given as all key columns; only their buckets are read."""
    known = latest(spark, path)
    for key in keys:
        if set(key) != set(known.keys):
            raise ValueError(f"the key columns of this target are {list(known.keys)}, not {list(key)}")
    wanted = spark.createDataFrame(
        [tuple(key[k] for k in known.keys) for key in keys], ", ".join(f"{k} STRING" for k in known.keys)
    )
    numbers = [r["b"] for r in wanted.select(bucket_of(known.keys, known.buckets).alias("b")).distinct().collect()]
    same = reduce(
        lambda a, b: a | b,
        [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(key[k]) for k in known.keys]) for key in keys],
        F.lit(False),
    )
    return _merged(_stored(spark, path, known, "rows", numbers).filter(same), known)


def maintained_row(spark: SparkSession, path: str, key: dict[str, str]) -> DataFrame:
    """The row of one key; only its bucket is read."""
    return maintained_rows(spark, path, [key])


def delete_maintained(spark: SparkSession, path: str, where: Column) -> None:
    """Delete the target's rows for which ``where`` is true, for good.

    The delete is kept with the position of the last change its key has, so that
    replayed changes do not bring the row back and later ones do. No stored row is rewritten.
    """

    def work() -> Snapshot | None:
        known = latest(spark, path)
        state = _stored(spark, path, known, "rows")
        gone = _merged(state, known).filter(F.coalesce(where, F.lit(False))).select(*known.keys)
        changes = state.filter("NOT deleted")
        if known.mode == "match_update":
            changes = changes.filter(F.col("source_table") == "job_activity")
        last = changes.groupBy(*known.keys).agg(F.max(_position()).alias("at"))
        named = gone.select(*(F.col(k).alias(f"__{k}") for k in known.keys))
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in known.keys]
        marks = last.join(named, same, "left_semi").select(
            *(F.col(c) if c in known.keys else F.lit(None).cast(target_type(c)).alias(c) for c in TARGET_COLUMNS),
            F.lit(None).cast("string").alias("source_table"), *(F.col(f"at.{c}").alias(c) for c in ORDER),
            F.lit(True).alias("deleted"),
        )
        made = _with_rows(marks, path, known, "rows")
        return made if made.layers != known.layers else None

    _transaction(spark, path, work)
