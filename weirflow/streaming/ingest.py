"""Running a feed continuously.

There is no event time and no watermark: a change may arrive as late as it
likes, because merging looks only at the order columns. A feed is kept as a change log,
or worked into a maintained target at once; column-wise merging can also be left to
Spark's state store, which then has one row per key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from weirflow.operators import mapping
from weirflow.operators.merge import partial
from weirflow.schema import TARGET_COLUMNS, TARGET_KEY
from weirflow.session import spread_reads
from weirflow.sinks.maintained import apply_changes, target_writer
from weirflow.sinks.parquet import BUCKETS, log_writer, read_log
from weirflow.sources.topics import TOPIC_COLUMNS

INTERVAL = "60 seconds"


def apply_batches(
    feed: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str = "change_ingest",
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` on every micro-batch of a feed.

    A batch may be delivered again after a failure, under the same id; ``write``
    must then give the same result. ``interval=None`` works off what is
    available and stops.
    """
    writer = (
        feed.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def run_of(checkpoint: str) -> str:
    """The name of a run. The checkpoint is what makes it: batches are numbered within it."""
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:12]


def maintain(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "replace_row",
    keys: Sequence[str] = TARGET_KEY,
    buckets: int = BUCKETS,
    sink: str = "selective",
    literals: bool = True,
    name: str = "target_maintenance",
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Work a feed into a maintained target as it arrives.

    Each micro-batch is one transaction with the number of the batch in it, so that after a
    failure at any point the batch delivered again is worked in exactly once.
    """
    write = target_writer(path, run_of(checkpoint), mode, keys, buckets, sink, literals)
    return apply_batches(feed, write, checkpoint, name, interval)


def maintain_partial(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = TARGET_KEY,
    buckets: int = BUCKETS,
    name: str = "partial_state",
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Merge a feed column by column in Spark's state store, and keep the target of it.

    The state has one row per key, however many changes it had. Each batch puts out the keys
    that it changed, whole, and these replace the rows of the maintained target; their position is
    the number of the batch.
    """
    run = run_of(checkpoint)
    state = partial(mapping.changes(feed, literals=False), keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(
            *TARGET_COLUMNS, F.lit("merged").alias("source_table"), F.timestamp_millis(F.lit(batch_id)).alias("timestamp"),
            F.lit("state").alias("topic"), F.lit(0).alias("partition"), F.lit(batch_id).cast("bigint").alias("offset"),
        )
        apply_changes(rows, path, run, batch_id, "replace_row", keys, buckets)

    writer = (
        state.writeStream.queryName(name).outputMode("update")
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def redrive(
    spark: SparkSession,
    log: str,
    name: str,
    sink: str = "selective",
    literals: bool = True,
    outcomes: Sequence[str] = ("bad_value", "null_key"),
    corrected: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Work a log's rejected events again, under another mapping or with ``corrected`` texts.

    They enter the log as a run of their own, named ``name``, at the position that they had: merging
    gives what it would have given had they not been rejected. Redriving twice changes nothing.
    """
    rejects = read_log(spark, log, outcome=None).filter(F.col("outcome").isin(*outcomes))
    feed = rejects.filter(F.col("run") != name).select(*TOPIC_COLUMNS)
    with spread_reads(spark):
        log_writer(log, name, sink, literals)(corrected(feed) if corrected else feed, 0)


def ingest(
    feed: DataFrame,
    log: str,
    checkpoint: str,
    sink: str = "selective",
    literals: bool = True,
    name: str = "change_ingest",
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Write a feed to a change log, from which the target can be merged."""
    write = log_writer(log, run_of(checkpoint), sink, literals)
    return apply_batches(feed, write, checkpoint, name, interval)
