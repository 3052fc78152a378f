"""Reading tables and cutting lineage, shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.session import work_folder

SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back.

    Later steps start from files that every executor can read, so a lost executor
    never repeats what lies before, and the planner knows the size.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A stored table up to this many narrow rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame) -> DataFrame:
    """A stored table of a few narrow columns, marked for broadcast if its counted rows allow."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the first variation of it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def fold(column: str, count: int):
    """The remainder of the crc32 of an id's text: a fixed split of documents."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % count
