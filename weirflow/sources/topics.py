"""Change topics: Kafka, files of events, or any DataFrame shaped like a topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirflow.schema import DEFAULT_TOPICS

TOPIC_COLUMNS = ("value", "topic", "partition", "offset", "timestamp")

# Layout of stored topics: one row per message.
TOPIC_SCHEMA = (
    "value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)


def read_topics(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = DEFAULT_TOPICS,
    starting: str = "earliest",
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """All topics as one feed of text values, from the earliest offset.

    Needs the Kafka connector of the running Spark version on the class path.
    """
    reader = spark.readStream if streaming else spark.read
    messages = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return messages.select(
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
    )


def split_topics(
    feed: DataFrame, topics: Sequence[str] = DEFAULT_TOPICS
) -> dict[str, DataFrame]:
    """One feed per topic."""
    return {topic: feed.filter(F.col("topic") == topic) for topic in topics}


def as_topic(rows: DataFrame, topic: str, value: Column | str, offset: Column | str) -> DataFrame:
    """Shape rows as messages of one topic. ``offset`` must be unique; it also
    serves as the message time, in milliseconds."""
    value = F.col(value) if isinstance(value, str) else value
    offset = F.col(offset) if isinstance(offset, str) else offset
    return rows.select(
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.timestamp_millis(offset.cast("bigint")).alias("timestamp"),
    )


# How files of events are written: in row groups small enough that a file can be split between
# read tasks, and the texts, which hardly repeat, without a dictionary.
EVENT_FILES = {"parquet.block.size": str(8 << 20), "parquet.enable.dictionary#value": "false"}


def read_change_files(spark: SparkSession, path: str) -> DataFrame:
    """A stored feed, laid out as :data:`TOPIC_SCHEMA`."""
    return spark.read.schema(TOPIC_SCHEMA).parquet(path)


# Files of a micro-batch for each core of the cluster.
FILES_PER_CORE = 4


def stream_change_files(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """A stored feed as a stream of its files, by default with a few files for
    each core in a batch. Give ``bytes_per_batch`` where file sizes vary."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        files = files_per_batch or FILES_PER_CORE * spark.sparkContext.defaultParallelism
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)
