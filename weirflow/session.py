"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # change times are zone-less or UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime join choice by measured size, partition coalescing, skew splitting
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows are wide and JSON text expands in memory: keep read tasks modest
    "spark.sql.files.maxPartitionBytes": "128m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weirflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Read tasks for each core where events are parsed: enough to even out sources that cost more per byte.
TASKS_PER_CORE = 4
READ_TASKS = "spark.sql.files.minPartitionNum"


@contextmanager
def spread_reads(spark: SparkSession) -> Iterator[None]:
    """What runs in here reads its files in several tasks for each core, unless the session
    says how many. Spark by itself makes about one, and all wait for the slowest."""
    if spark.conf.get(READ_TASKS, None) is not None:
        yield
        return
    spark.conf.set(READ_TASKS, str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(READ_TASKS)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path for written intermediate tables and checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``, where every
    executor, and a restarted one, can read it. A machine-local folder is used
    only by a local session that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="weirflow-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
