"""Named queries over the base tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from weirflow.functions import parse_datetime as to_datetime, parse_decimal as to_decimal
from weirflow.operators import mapping, merge as merging, target
from weirflow.operators.envelope import IMAGE, image_select as select_images, parse_envelope, passthrough
from weirflow.schema import COMPOSITE_KEY, SOURCES, TARGET_COLUMNS
from weirflow.session import spread_reads, work_folder
from weirflow.sinks import maintained
from weirflow.sinks.parquet import BUCKETS
from weirflow.sinks import (
    compact_log,
    delete_maintained,
    read_log,
    read_maintained,
    read_metrics,
    read_target,
    refresh_target,
    target_row,
    target_rows,
    target_writer,
    write_target,
)
from weirflow.sources import (
    activity_feed,
    change_feed,
    exclusions_feed,
    jobs_feed,
    keyed_by_customer_feed,
    read_change_files,
    read_table,
    revenue_feed,
    split_topics,
    stream_change_files,
    unmapped_feed,
    wide_rows_feed,
)
from weirflow.sources import generator
from weirflow.sources.topics import EVENT_FILES, TOPIC_COLUMNS
from weirflow.sources.offsets import append_messages, end_positions, read_offsets
from weirflow.streaming import ProgressTable, apply_batches, ingest, maintain_partial, redrive

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# The unique column of each base table that events are derived from.
KEYS = {
    "orders": "o_orderkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
    "events": "event_id",
    "customer": "c_custkey",
}


def _rows(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return change_feed(lambda name: _rows(spark, sf, name))


def _wide_feed(spark: SparkSession, sf: str) -> DataFrame:
    return wide_rows_feed(_rows(spark, sf, "orders"))


SOURCE_FEEDS = {
    "job_activity": lambda spark, sf: activity_feed(_rows(spark, sf, "orders")),
    "jobs": lambda spark, sf: jobs_feed(_rows(spark, sf, "part")),
    "clients_to_exclude": lambda spark, sf: exclusions_feed(_rows(spark, sf, "supplier")),
    "standard_revenue": lambda spark, sf: revenue_feed(_rows(spark, sf, "events")),
}


def _target(spark: SparkSession, sf: str) -> DataFrame:
    return merging.merge(mapping.changes(_feed(spark, sf)), "replace_row")


def _stored_target(spark: SparkSession, sf: str) -> str:
    """The merged table, written; its path."""
    path = work_folder(spark, "target")
    write_target(_target(spark, sf), path)
    return path


def _read_back(spark: SparkSession, sf: str) -> DataFrame:
    return read_target(spark, _stored_target(spark, sf))


# --- sources -----------------------------------------------------------------


@query
def cdc_feed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, and a checksum over what every event says."""
    events = parse_envelope(_feed(spark, sf), before=True)
    image = F.expr(IMAGE)
    said = F.md5(F.concat_ws(
        "|", F.when(F.col("event.readable"), "read").otherwise("broken"), "event.op",
        *(image[c] for c in ("activity_id", "job_id", "client_id", "bcworkerid")),
    ))
    return events.groupBy("topic").agg(
        F.count("*").alias("events"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum(F.conv(F.substring(said, 1, 8), 16, 10).cast("bigint")).alias("checksum"),
    )


@query
def cdc_topic_split(spark: SparkSession, sf: str) -> DataFrame:
    def operations(feed: DataFrame) -> DataFrame:
        ops = parse_envelope(feed).select("topic", F.col("event.op").alias("op"))
        return ops.groupBy("topic", "op").agg(F.count("*").alias("events"))

    parts = split_topics(_feed(spark, sf)).values()
    return reduce(DataFrame.unionByName, [operations(p) for p in parts])


# --- mapping -----------------------------------------------------------------


def _map_query(source: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = mapping.map_source(SOURCE_FEEDS[source](spark, sf), source)
        return rows.select("offset", "source_table", *SOURCES[source].owned)

    return run


def _sink_query(source: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = mapping.changes(SOURCE_FEEDS[source](spark, sf), sources=[source])
        return rows.select("offset", *SOURCES[source].written)

    return run


for _name in SOURCES:
    QUERIES[f"map_{_name}"] = _map_query(_name)
    QUERIES[f"sink_{_name}"] = _sink_query(_name)


@query
def map_unknown_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    rows = passthrough(unmapped_feed(_rows(spark, sf, "customer")))
    return rows.select("offset", "table_name", F.explode("image").alias("field", "value"))


@query
def image_select(spark: SparkSession, sf: str) -> DataFrame:
    image = F.col("image")
    return select_images(_feed(spark, sf)).select(
        "topic", "offset", "op", "table_name",
        image.isNotNull().alias("has_image"),
        image.activity_id.alias("activity_id"),
        image.job_id.alias("job_id"),
        image.client_id.alias("client_id"),
        image.bcworkerid.alias("bcworkerid"),
    )


@query
def matching_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.matching_key(_feed(spark, sf))
    return rows.select(
        "topic", "offset", F.explode_outer("matching_key").alias("key_column", "key_value")
    )


@query
def route_case_insensitive(spark: SparkSession, sf: str) -> DataFrame:
    rows = parse_envelope(SOURCE_FEEDS["jobs"](spark, sf))
    return rows.groupBy(
        F.col("event.raw_table").alias("table_name"), "event.source_table"
    ).agg(F.count("*").alias("events"))


@query
def bind_by_name(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.audited_rows(_wide_feed(spark, sf), sink="full_row")
    return rows.select("offset", *TARGET_COLUMNS, "reason")


@query
def parse_datetime(spark: SparkSession, sf: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    spelling = key % 16
    number = F.unix_date(day.cast("date")).cast("bigint")
    text = (
        F.when(spelling == 0, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(spelling == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(spelling == 2, number.cast("string"))
        .when(spelling == 3, (number * 86_400_000 + key).cast("string"))
        .when(spelling == 4, F.date_format(day, "yyyy-MM-dd"))
        .when(spelling == 5, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(spelling == 6, F.date_format(day, "yyyy-MM-31 23:59:59"))
        .when(spelling == 7, F.date_format(day, "yyyy-MM-dd 24:00:00"))
        .when(spelling == 8, F.date_format(day, "yyyy-MM-dd 24:00:01"))
        .when(spelling == 9, F.concat(F.lit("\t "), F.date_format(day, "yyyy-MM-dd HH:mm:ss"), F.lit("\n")))
        .when(spelling == 10, F.concat(F.lit("-"), number.cast("string")))
        .when(spelling == 11, F.lit("99999"))
        .when(spelling == 12, F.lit("100000"))
        .when(spelling == 13, F.lit("99999999999999999999"))
        .when(spelling == 14, F.date_format(day, "yyyy-13-dd HH:mm:ss"))
    )
    orders = read_table(spark, sf, "orders")
    texts = orders.select("o_orderkey", text.alias("text"))
    return texts.select("o_orderkey", F.expr(to_datetime("text")).alias("parsed"))


@query
def parse_decimal(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("event_id")
    amount = F.col("value").cast("decimal(12,2)").cast("string")
    spelling = key % 14
    text = (
        F.when(spelling == 0, amount)
        .when(spelling == 1, F.concat(F.lit("\t "), amount, F.lit(" ")))
        .when(spelling == 2, F.concat(F.lit("-"), amount))
        .when(spelling == 3, F.concat(amount, F.lit("e2")))
        .when(spelling == 4, F.concat(F.lit("+."), key.cast("string")))
        .when(spelling == 5, F.concat(key.cast("string"), F.lit(".")))
        .when(spelling == 6, F.concat(key.cast("string"), F.lit(",000")))
        .when(spelling == 7, F.concat(F.lit("E"), key.cast("string")))
        .when(spelling == 8, F.lit("   "))
        .when(spelling == 9, F.lit("123456789.00"))
        .when(spelling == 10, F.concat(key.cast("string"), F.lit(".005")))
        .when(spelling == 11, F.lit("1e-30"))
        .when(spelling == 12, F.lit("1e99999999999"))
    )
    events = read_table(spark, sf, "events")
    texts = events.select("event_id", text.alias("text"))
    return texts.select("event_id", F.expr(to_decimal("text")).alias("parsed"))


# --- sinks and rejects -------------------------------------------------------


@query
def sink_revenue_keyless(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.keyless_revenue(SOURCE_FEEDS["standard_revenue"](spark, sf))
    return rows.select("offset", *SOURCES["standard_revenue"].owned, "reason")


@query
def sink_full_row_upsert(spark: SparkSession, sf: str) -> DataFrame:
    feed = _feed(spark, sf).unionByName(_wide_feed(spark, sf))
    return merging.merge(mapping.changes(feed, sink="full_row"), "full_row")


@query
def sink_unified_rows(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.changes(_feed(spark, sf)).select("offset", "source_table", *TARGET_COLUMNS)


@query
def sink_rejects(spark: SparkSession, sf: str) -> DataFrame:
    feed = _feed(spark, sf).unionByName(_wide_feed(spark, sf))
    return reduce(DataFrame.unionByName, [
        mapping.rejected(mapping.audited_rows(feed, sink)).select(
            F.lit(sink).alias("sink"), "topic", "offset", "reason"
        )
        for sink in ("selective", "full_row")
    ])


def _audited_feed(spark: SparkSession, sf: str) -> DataFrame:
    tagged = keyed_by_customer_feed(_rows(spark, sf, "orders"))
    return _feed(spark, sf).unionByName(_wide_feed(spark, sf)).unionByName(tagged)


@query
def drop_audit(spark: SparkSession, sf: str) -> DataFrame:
    feed = _audited_feed(spark, sf)
    return mapping.drop_audit(mapping.audited_rows(feed))


# --- merging -----------------------------------------------------------------


@query
def merge_append(spark: SparkSession, sf: str) -> DataFrame:
    return merging.merge(mapping.changes(_feed(spark, sf)), "append")


@query
def merge_replace_row(spark: SparkSession, sf: str) -> DataFrame:
    return _target(spark, sf)


@query
def merge_replace_row_composite(spark: SparkSession, sf: str) -> DataFrame:
    changes = mapping.changes(_feed(spark, sf))
    return merging.merge(changes, "replace_row", keys=COMPOSITE_KEY)


@query
def merge_replace_row_by_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered by the time of the source, which here runs against the offsets."""
    feed = _feed(spark, sf).withColumn("value", F.regexp_replace("value", '"ts_ms":', '"ts_ms":-'))
    changes = mapping.changes(feed, event_time=True)
    return merging.merge(changes, "replace_row", order=("ts_ms", *mapping.ORDER))


@query
def merge_partial(spark: SparkSession, sf: str) -> DataFrame:
    feed = keyed_by_customer_feed(_rows(spark, sf, "orders"))
    return merging.merge(mapping.changes(feed, literals=False), "partial")


@query
def merge_match_update(spark: SparkSession, sf: str) -> DataFrame:
    changes = {
        name: mapping.changes(feed(spark, sf), literals=False, sources=[name])
        for name, feed in SOURCE_FEEDS.items()
    }
    return merging.merge(changes, "match_update")


@query
def compact_match_update(spark: SparkSession, sf: str) -> DataFrame:
    changes = mapping.changes(_feed(spark, sf), literals=False)
    return merging.merge(merging.compact(changes), "match_update")


@query
def compact_composite(spark: SparkSession, sf: str) -> DataFrame:
    changes = merging.compact(mapping.changes(_feed(spark, sf)))
    return merging.merge(changes, "replace_row", keys=COMPOSITE_KEY)


@query
def match_update_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """What changes match comes before and after what they match on."""
    earlier = None
    for names in (["jobs", "clients_to_exclude"], ["job_activity"], ["standard_revenue"]):
        batch = reduce(DataFrame.unionByName, [
            mapping.changes(SOURCE_FEEDS[name](spark, sf), literals=False, sources=[name])
            for name in names
        ])
        if names == ["standard_revenue"]:
            return merging.merge(batch, "match_update", target=earlier)
        earlier = merging.compact(batch if earlier is None else earlier.unionByName(batch))


@query
def match_existing_two_part(spark: SparkSession, sf: str) -> DataFrame:
    """A merged table whose changes are gone, after a batch of revenue changes: rows that have a
    client match on worker and client, others on the worker."""

    def changes(name: str, chosen: str = "true") -> DataFrame:
        return mapping.changes(SOURCE_FEEDS[name](spark, sf).filter(chosen), literals=False, sources=[name])

    earlier = {name: changes(name, "offset % 2 = 0" if name == "standard_revenue" else "true") for name in SOURCE_FEEDS}
    path = work_folder(spark, "target")
    write_target(merging.merge(earlier, "match_update"), path)
    return merging.match_existing(read_target(spark, path), changes("standard_revenue", "offset % 2 = 1"))


# --- reading and editing the target -------------------------------------------


@query
def target_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return target_row(spark, _stored_target(spark, sf), {"activity_id": "101"})


@query
def target_count(spark: SparkSession, sf: str) -> DataFrame:
    return target.count(_read_back(spark, sf))


@query
def target_like_count(spark: SparkSession, sf: str) -> DataFrame:
    where = target.like_any(["JOB_1%", "BC_%", "client_%", "12_"])
    return target.count(_read_back(spark, sf), where)


@query
def target_in_list(spark: SparkSession, sf: str) -> DataFrame:
    ids = ["101", "JOB_12", "BC7", "client_record"]
    rows = target_rows(spark, _stored_target(spark, sf), [{"activity_id": i} for i in ids])
    return target.report(rows, ids, "test_record")


@query
def target_sample(spark: SparkSession, sf: str) -> DataFrame:
    return target.sample(_read_back(spark, sf))


@query
def target_delete_where(spark: SparkSession, sf: str) -> DataFrame:
    where = (
        (F.col("activity_id") == "client_record")
        | target.like_any(["BC1%", "JOB_%"])
        | target.in_list(["1", "2", "3"])
        | (F.col("company_name") == "CLIENT_7")
    )
    return target.delete_where(_read_back(spark, sf), where)


# Literal rows, in insertion order; each names a subset of the target's columns.
INSERTED = (
    "SELECT 1 AS position, 'test_activity_1' AS activity_id, 'test_job_1' AS job_id, "
    "'Test Company A' AS company_name, 'John Doe' AS candidate, NULL AS job_title",
    "SELECT 2, 'test_activity_1', 'test_job_1_updated', 'Test Company A Updated', 'Jane Doe', NULL",
    "SELECT 3, '101', 'job_456', 'Company ABC', 'Bob Johnson', 'Data Engineer'",
    "SELECT 4, 'client_record', 'client_record', 'Excluded Company', NULL, NULL",
)


@query
def target_insert_values(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql(" UNION ALL ".join(INSERTED))
    later = F.timestamp_seconds(F.lit(4_000_000_000))
    changes = target.insert_values(
        mapping.changes(_feed(spark, sf)), rows, "job_activity", later
    )
    return merging.merge(changes, "replace_row")


# --- streaming ---------------------------------------------------------------


def _stored(feed: DataFrame, spark: SparkSession) -> str:
    """The feed written out as stored messages, several files of them."""
    path = work_folder(spark, "topics")
    feed.select(*TOPIC_COLUMNS).write.options(**EVENT_FILES).parquet(path)
    return path


def _ingested(
    spark: SparkSession, topics: str, log: str, literals: bool = True, files: int | None = None
) -> DataFrame:
    feed = stream_change_files(spark, topics, files_per_batch=files)
    with spread_reads(spark):
        run = ingest(
            feed, log, work_folder(spark, "checkpoint"), literals=literals,
            name=log.rsplit("/", 1)[-1], interval=None,
        )
        run.awaitTermination()
    return read_log(spark, log)


@query
def stream_replace_row(spark: SparkSession, sf: str) -> DataFrame:
    topics = _stored(_feed(spark, sf), spark)
    changes = _ingested(spark, topics, work_folder(spark, "log"))
    return merging.merge(changes, "replace_row")


@query
def ingest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Events per outcome as the ingest counted them while it wrote the log."""
    feed = _audited_feed(spark, sf)
    log = work_folder(spark, "log")
    _ingested(spark, _stored(feed, spark), log)
    return read_metrics(spark, log).groupBy("reason").agg(F.sum("events").cast("bigint").alias("events"))


@query
def ingest_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a listener's progress table and the ingest's own metrics count them."""
    log, topics = work_folder(spark, "log"), _stored(_audited_feed(spark, sf), spark)
    table = ProgressTable(spark, work_folder(spark, "progress"))
    spark.streams.addListener(table)
    try:
        run = ingest(
            stream_change_files(spark, topics), log, work_folder(spark, "checkpoint"),
            name=log.rsplit("/", 1)[-1], interval=None,
        )
        run.awaitTermination()
        table.wait(str(run.runId))
    finally:
        spark.streams.removeListener(table)
    counted = read_metrics(spark, log).select("events", F.lit(0).cast("bigint").alias("told"))
    told = table.read().select(F.lit(0).cast("bigint").alias("events"), F.col("rows").alias("told"))
    return counted.unionByName(told).agg(*(F.sum(c).cast("bigint").alias(c) for c in counted.columns))


@query
def redrive_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A feed is ingested under a mapping that leaves most events without a key; those are
    worked again under the right one. The result is that of a clean first run."""
    topics, log = _stored(_feed(spark, sf), spark), work_folder(spark, "log")
    with spread_reads(spark):
        run = ingest(
            stream_change_files(spark, topics), log, work_folder(spark, "checkpoint"), sink="full_row",
            name=log.rsplit("/", 1)[-1], interval=None,
        )
        run.awaitTermination()
    for _ in range(2):
        redrive(spark, log, "redriven")
    return merging.merge(read_log(spark, log), "replace_row")


@query
def resume_from_offset(spark: SparkSession, sf: str) -> DataFrame:
    """Sums over what a second run reads of a stored topic: from where the first one ended."""
    path = work_folder(spark, "offsets")
    append_messages(_feed(spark, sf), path)
    # the first run ends at offset 100 of each topic
    ended = dict.fromkeys(end_positions(spark, path), 100)
    events = select_images(read_offsets(spark, path, starting=ended))
    return events.groupBy("topic").agg(
        F.count("*").alias("events"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count_if(F.col("op") == "u").alias("updates"),
    )


@query
def stream_state_partial(spark: SparkSession, sf: str) -> DataFrame:
    """Column-wise merging in the state store; the stream is stopped half way and restarted."""
    feed = keyed_by_customer_feed(_rows(spark, sf, "orders"))
    topics, path, checkpoint = work_folder(spark, "topics"), work_folder(spark, "maintained"), work_folder(spark, "checkpoint")
    for half in (0, 1):
        part = feed.filter(f"offset % 2 = {half}").select(*TOPIC_COLUMNS)
        part.write.mode("append").parquet(topics)
        run = maintain_partial(
            stream_change_files(spark, topics), path, checkpoint, name=path.rsplit("/", 1)[-1], interval=None
        )
        run.awaitTermination()
    return read_maintained(spark, path)


@query
def stream_replay_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """The feed is worked off twice, in different batches, into one log; the
    log is compacted before it is merged."""
    topics = _stored(_feed(spark, sf), spark)
    log, compacted = work_folder(spark, "log"), work_folder(spark, "log")
    cores = spark.sparkContext.defaultParallelism
    _ingested(spark, topics, log, files=cores)
    _ingested(spark, topics, log, files=2 * cores)
    compact_log(spark, log, compacted)
    return merging.merge(read_log(spark, compacted), "replace_row")


@query
def stream_partial(spark: SparkSession, sf: str) -> DataFrame:
    feed = keyed_by_customer_feed(_rows(spark, sf, "orders"))
    topics = _stored(feed, spark)
    changes = _ingested(spark, topics, work_folder(spark, "log"), literals=False)
    return merging.merge(changes, "partial")


def _halves(feed: DataFrame, spark: SparkSession) -> tuple[str, str]:
    """The feed as two stored parts, in which keys have changes in both."""
    return tuple(_stored(feed.filter(f"offset % 2 = {half}"), spark) for half in (0, 1))


# A bucket of a maintained target is read by one task: one for so many events, or the default count.
EVENTS_PER_BUCKET = 1_000_000


def _buckets(events: int) -> int:
    return max(BUCKETS, -(-events // EVENTS_PER_BUCKET))


def _refreshed(spark: SparkSession, feed: DataFrame, mode: str, literals: bool) -> DataFrame:
    first, second = _halves(feed, spark)
    log, path = work_folder(spark, "log"), work_folder(spark, "maintained")
    buckets = _buckets(read_change_files(spark, first).count() + read_change_files(spark, second).count())
    for topics in (second, first, second):  # the later half comes first, and again
        _ingested(spark, topics, log, literals)
        refresh_target(spark, log, path, mode, buckets=buckets)
    return read_maintained(spark, path)


@query
def refresh_replace_row(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, _feed(spark, sf), "replace_row", True)


@query
def refresh_partial(spark: SparkSession, sf: str) -> DataFrame:
    feed = keyed_by_customer_feed(_rows(spark, sf, "orders"))
    return _refreshed(spark, feed, "partial", False)


@query
def refresh_match_update(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed(spark, _feed(spark, sf), "match_update", False)


class _Killed(Exception):
    pass


def _stopped_once(write: Callable[[DataFrame, int], None], at: int) -> Callable[[DataFrame, int], None]:
    """A writer that stops once in the middle of batch ``at``: its data are written, the commit is not."""
    stopped = []

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id != at or stopped:
            return write(batch, batch_id)
        stopped.append(batch_id)

        def stop(*_):
            raise _Killed

        whole, maintained.commit = maintained.commit, stop
        try:
            write(batch, batch_id)
        finally:
            maintained.commit = whole

    return run


def _maintained(spark: SparkSession, feed: DataFrame, mode: str, literals: bool) -> DataFrame:
    """A feed worked into a target in three batches: one is stopped before its commit and
    delivered again by the restarted stream, and the first is delivered again at the end."""
    topics, path, checkpoint = work_folder(spark, "topics"), work_folder(spark, "maintained"), work_folder(spark, "checkpoint")
    files = spark.sparkContext.defaultParallelism  # of a batch, so that all cores write and read it
    feed.select(*TOPIC_COLUMNS).repartition(3 * files, "topic", "offset").write.parquet(topics)
    buckets = _buckets(read_change_files(spark, topics).count())
    write = target_writer(path, "run", mode, buckets=buckets, literals=literals)
    stopping = _stopped_once(write, 1)
    for _ in range(2):
        run = apply_batches(
            stream_change_files(spark, topics, files_per_batch=files), stopping, checkpoint,
            name=path.rsplit("/", 1)[-1], interval=None,
        )
        try:
            run.awaitTermination()
        except StreamingQueryException as error:
            if "_Killed" not in str(error):
                raise
    write(read_change_files(spark, topics), 0)  # what has been worked in changes nothing
    return read_maintained(spark, path)


@query
def stream_maintained(spark: SparkSession, sf: str) -> DataFrame:
    return _maintained(spark, _feed(spark, sf), "replace_row", True)


@query
def stream_maintained_match_update(spark: SparkSession, sf: str) -> DataFrame:
    return _maintained(spark, _feed(spark, sf), "match_update", False)


@query
def target_delete_then_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted rows stay away after a replay; later changes of their keys come back."""
    first, second = _halves(_feed(spark, sf), spark)
    log, path = work_folder(spark, "log"), work_folder(spark, "maintained")
    buckets = _buckets(read_change_files(spark, first).count() + read_change_files(spark, second).count())
    _ingested(spark, first, log)
    refresh_target(spark, log, path, buckets=buckets)
    delete_maintained(spark, path, target.like_any(["JOB_1%", "client_%", "1%"]))
    for topics in (first, second):
        _ingested(spark, topics, log)
        refresh_target(spark, log, path, buckets=buckets)
    return read_maintained(spark, path)


# --- generated events --------------------------------------------------------


def _ids(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return _rows(spark, sf, table).select(F.col(KEYS[table]).alias("i"))


@query
def gen_batch(spark: SparkSession, sf: str) -> DataFrame:
    return generator.batch_events(_ids(spark, sf, "orders"))


@query
def gen_performance(spark: SparkSession, sf: str) -> DataFrame:
    return generator.performance_events(_ids(spark, sf, "orders"))


@query
def golden_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    return generator.scenario_events(_ids(spark, sf, "part"))


@query
def gen_target_rows(spark: SparkSession, sf: str) -> DataFrame:
    return generator.target_rows(_ids(spark, sf, "customer"))
