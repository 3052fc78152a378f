"""Change logs and target tables as Parquet folders."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from weirflow.operators.mapping import ORDER, audited_rows
from weirflow.operators.merge import compact
from weirflow.schema import SOURCE_NAMES, TARGET_COLUMNS, TARGET_KEY, target_type
from weirflow.sources.topics import EVENT_FILES

ACCEPTED = "accepted"
OUTCOMES = (
    ACCEPTED, "parse_error", "delete", "no_image", "no_table", "empty_image",
    "unknown_table", "bad_value", "null_key",
)
METRICS = "reason STRING, events BIGINT, seconds DOUBLE"

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    *[T.StructField(c, target_type(c)) for c in TARGET_COLUMNS],
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("source_table", T.StringType()),
])

# Hash buckets of a stored target table.
BUCKETS = 10


def log_writer(
    log: str, run: str, sink: str = "selective", literals: bool = True
) -> Callable[[DataFrame, int], None]:
    """A function that writes one micro-batch of a feed to a change log.

    Each event is parsed once and nothing is shuffled. Events that do not reach
    the target are kept with their text under their own outcome. Writing a
    batch of the same run again replaces it, so a retry leaves the log as it
    was. A new run adds to the log; merging is not changed by repeated changes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        text = batch.withColumn("text", F.col("value"))
        rows = audited_rows(text, sink, literals, event_time=True)
        outcome = F.coalesce(F.col("reason"), F.lit(ACCEPTED))
        seen = Observation()
        counts = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
        started = time.time()
        (
            rows.withColumn("outcome", outcome)
            .observe(seen, F.count("*").alias("events"), *counts)
            .withColumn("value", F.when(F.col("reason").isNotNull(), F.col("text")))
            .select([c for c in LOG_SCHEMA.names if c not in ("run", "batch_id")])
            .write.mode("overwrite").options(**EVENT_FILES)
            .partitionBy("outcome", "source_table")
            .parquet(f"{log}/run={run}/batch_id={batch_id}")
        )
        counted = seen.get
        seconds = time.time() - started
        metrics = [(o, int(counted[o]), seconds) for o in OUTCOMES if counted[o]]
        (
            batch.sparkSession.createDataFrame(metrics, METRICS).coalesce(1)
            .write.mode("overwrite").parquet(f"{log}/_metrics/run={run}/batch_id={batch_id}")
        )

    return write


def read_metrics(spark: SparkSession, log: str) -> DataFrame:
    """Events per outcome and seconds of each batch, counted while it was written."""
    return spark.read.schema(METRICS).option("basePath", f"{log}/_metrics").parquet(f"{log}/_metrics/run=*")


def found_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in any store Spark can read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(status.getPath()) for status in store.globStatus(path) or [])


def finished_batches(spark: SparkSession, log: str) -> dict[tuple[str, int], str]:
    """Folder of each batch that is written in full: its success marker comes last."""
    folders = [p.removesuffix("/_SUCCESS") for p in found_paths(spark, f"{log}/run=*/batch_id=*/_SUCCESS")]
    found = {}
    for folder in folders:
        run, batch = folder.rsplit("/", 2)[1:]
        found[run.removeprefix("run="), int(batch.removeprefix("batch_id="))] = folder
    return found


def finished_after(spark: SparkSession, log: str, marks: Mapping[str, int]) -> list[tuple[str, int]]:
    """Finished batches of each run that come after its mark, up to the first that is not finished.

    The batches of a run are numbered from 0; those up to the mark are not looked at.
    """
    found = []
    for folder in found_paths(spark, f"{log}/run=*"):
        run = folder.rsplit("run=", 1)[1]
        batch = marks.get(run, -1) + 1
        while found_paths(spark, f"{folder}/batch_id={batch}/_SUCCESS"):
            found.append((run, batch))
            batch += 1
    return found


def read_log(
    spark: SparkSession,
    log: str,
    sources: Sequence[str] | None = None,
    outcome: str | None = ACCEPTED,
    batches: Sequence[tuple[str, int]] | None = None,
) -> DataFrame:
    """Changes kept in a log, of finished batches only. Only the folders of the
    named sources, batches and of the outcome are read (``outcome=None``: of all);
    ``batches`` are to be finished ones."""
    if batches is None:
        folders = list(finished_batches(spark, log).values())
    else:
        folders = [f"{log}/run={run}/batch_id={batch}" for run, batch in batches]
    if not folders:
        return spark.createDataFrame([], LOG_SCHEMA)
    rows = spark.read.schema(LOG_SCHEMA).option("basePath", log).parquet(*folders)
    if outcome is not None:
        rows = rows.filter(F.col("outcome") == outcome)
    if sources is not None:
        rows = rows.filter(F.col("source_table").isin(*sources))
    return rows


def changes_by_source(spark: SparkSession, log: str) -> dict[str, DataFrame]:
    """The accepted changes of a log, one frame per source."""
    return {name: read_log(spark, log, [name]) for name in SOURCE_NAMES}


def compact_log(
    spark: SparkSession,
    log: str,
    into: str,
    keys: Sequence[str] = TARGET_KEY,
    order: Sequence[str] = ORDER,
) -> None:
    """Write the accepted changes that still matter as a new log (see
    :func:`~weirflow.operators.merge.compact`). Merging the new log gives what merging the old one
    does; later changes can be merged on top of it."""
    (
        compact(read_log(spark, log), keys, order)
        .drop("run", "batch_id")
        .write.mode("overwrite")
        .partitionBy("outcome", "source_table")
        .parquet(f"{into}/run=compacted/batch_id=0")
    )


def _bucket(keys: Sequence[str], buckets: int):
    # the hash that also partitions a shuffle by these keys: rows of one shuffle
    # partition share a bucket when the partition count is a multiple of buckets
    return F.pmod(F.hash(*keys), F.lit(buckets))


SPEC = T.StructType([
    T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("buckets", T.IntegerType()),
])


def write_target(
    rows: DataFrame, path: str, keys: Sequence[str] = TARGET_KEY, buckets: int = BUCKETS
) -> None:
    """Write a merged table, hash-distributed over bucket folders by its key.

    No shuffle is added to that of the merge. Key columns and bucket count are
    kept beside the table, for readers. Write each version to a path of its own
    and switch readers afterwards.
    """
    spark = rows.sparkSession
    spark.createDataFrame([(list(keys), buckets)], SPEC).write.mode("overwrite").parquet(f"{path}.spec")
    writer = rows.withColumn("bucket", _bucket(keys, buckets)).write.mode("overwrite").partitionBy("bucket")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)


def _read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    fields = [T.StructField(c, target_type(c)) for c in TARGET_COLUMNS]
    schema = T.StructType([*fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    return _read_bucketed(spark, path).select(*TARGET_COLUMNS)


def target_rows(spark: SparkSession, path: str, keys: Sequence[dict[str, str]]) -> DataFrame:
    """The rows of some keys, each given as all key columns. Only their buckets' folders are
    read, and of those, by Bloom filters, few row groups; the table itself tells its key
    columns and bucket count."""
    spec = spark.read.schema(SPEC).parquet(f"{path}.spec").first()
    for key in keys:
        if set(key) != set(spec["keys"]):
            raise ValueError(f"the key columns of this table are {spec['keys']}, not {list(key)}")
    wanted = spark.createDataFrame(
        [tuple(key[c] for c in spec["keys"]) for key in keys], ", ".join(f"{c} STRING" for c in spec["keys"])
    )
    numbers = wanted.select(_bucket(spec["keys"], spec["buckets"]).alias("b")).distinct()
    rows = _read_bucketed(spark, path).filter(F.col("bucket").isin([r["b"] for r in numbers.collect()]))
    same = [reduce(and_, [F.col(c).eqNullSafe(key[c]) for c in spec["keys"]]) for key in keys]
    return rows.filter(reduce(or_, same, F.lit(False))).select(*TARGET_COLUMNS)


def target_row(spark: SparkSession, path: str, key: dict[str, str]) -> DataFrame:
    """The rows of one key; see :func:`target_rows`."""
    return target_rows(spark, path, [key])
