"""Stored topics that can be read by offset.

Messages are appended in files that each hold one stretch of one topic partition, and an
index tells the first and last offset of every file. A range of offsets is read from the files
that overlap it; others are not opened. The index is a small table of its own, one row per
file, filtered by Spark; only the names of the files in the range reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.sources.topics import TOPIC_COLUMNS, TOPIC_SCHEMA

#: Start or end per (topic, partition).
Positions = Mapping[tuple[str, int], int]

INDEX = (
    "file STRING, topic STRING, partition INT, first_offset BIGINT, last_offset BIGINT, messages BIGINT"
)
ROWS_PER_FILE = 1_000_000


def append_messages(feed: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Append a feed's messages to a stored topic.

    Messages are range-partitioned by topic, partition and offset, so that a file's stretch is
    short. The index rows are written last: a file without them is not read.
    """
    spark = feed.sparkSession
    folder = f"{path}/data/{uuid.uuid4().hex}"
    order = ("topic", "partition", "offset")
    (
        feed.select(*TOPIC_COLUMNS, F.col("topic").alias("of_topic"), F.col("partition").alias("of_partition"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .write.partitionBy("of_topic", "of_partition").option("maxRecordsPerFile", rows_per_file).parquet(folder)
    )
    written = spark.read.schema(TOPIC_SCHEMA).parquet(folder)
    (
        written.groupBy(F.col("_metadata.file_path").alias("file"), "topic", "partition")
        .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count("*").alias("messages"))
        .coalesce(1).write.mode("append").parquet(f"{path}/offsets")
    )


def offset_index(spark: SparkSession, path: str) -> DataFrame:
    """Per file: topic, partition, first and last offset, number of messages."""
    return spark.read.schema(INDEX).parquet(f"{path}/offsets")


def end_positions(spark: SparkSession, path: str) -> dict[tuple[str, int], int]:
    """Per (topic, partition) the offset after the last message: where a next run starts."""
    ends = offset_index(spark, path).groupBy("topic", "partition").agg(F.max("last_offset").alias("last"))
    return {(r["topic"], r["partition"]): r["last"] + 1 for r in ends.collect()}  # one row per partition


def _positions(spark: SparkSession, positions: Positions, name: str) -> DataFrame:
    return spark.createDataFrame(
        [(topic, partition, at) for (topic, partition), at in positions.items()],
        f"topic STRING, partition INT, {name} BIGINT",
    )


def read_offsets(
    spark: SparkSession, path: str, starting: Positions | None = None, ending: Positions | None = None
) -> DataFrame:
    """Messages from ``starting`` on and before ``ending``; partitions that one does not name are unbounded there."""
    wanted = offset_index(spark, path)
    bounds = (("starting", starting or {}), ("ending", ending or {}))
    for name, positions in bounds:
        wanted = wanted.join(F.broadcast(_positions(spark, positions, name)), ["topic", "partition"], "left")
    files = wanted.filter(
        "(starting IS NULL OR last_offset >= starting) AND (ending IS NULL OR first_offset < ending)"
    ).select("file")
    names = [r["file"] for r in files.collect()]
    if not names:
        return spark.createDataFrame([], T.StructType(spark.createDataFrame([], TOPIC_SCHEMA).schema.fields))
    rows = spark.read.schema(TOPIC_SCHEMA).parquet(*names)
    for name, positions in bounds:
        if positions:
            rows = rows.join(F.broadcast(_positions(spark, positions, name)), ["topic", "partition"], "left")
            inside = F.col("offset") >= F.col(name) if name == "starting" else F.col("offset") < F.col(name)
            rows = rows.filter(F.col(name).isNull() | inside)
    return rows.select(*TOPIC_COLUMNS)
