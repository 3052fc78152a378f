"""Exact deduplication against a persistent digest index (native).

The index is a table of ``(digest, keep_id)``, bucketed and sorted by the SHA-256 of
the text with each run of white space as one space. A batch is reduced to one row per
digest before any shuffle of it, the rows whose digest the index lacks are found by a
sort-merge anti-join, and they are appended. Documents then take the ``keep_id`` of
their digest. Digests that hold more than one partition's share of the rows are joined
by broadcast: of those there are fewer than partitions, whatever the data.

Defined results: a null text equals the empty text; of equal texts the smallest
``doc_id`` stays, and one that the index already has stays before any new one; rows
that repeat a ``doc_id`` with the same text are one document and share its decision;
a row without ``doc_id`` stays only if no row of its text has one; an empty table adds
nothing; other columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm.common import free_name, shuffle_width, small_side, stored
from weirflow.session import work_folder


def normalised(text):
    """The text with each run of white space as one space; null as empty."""
    # single spaces are left alone: the same result with far fewer replacements
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def digest(text):
    return F.unhex(F.sha2(normalised(text), 256))


@dataclass
class DigestIndex:
    """A bucketed table of the digests seen so far and the document each was first seen in."""

    spark: SparkSession
    name: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, name: str, path: str, buckets: int | None = None) -> DigestIndex:
        """The index in folder ``path``, created if there is none.

        ``buckets`` counts only on creation; it is kept beside the index and read back,
        so that another session cannot open it with a wrong count.
        """
        spec = f"{path}_spec"
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spec)
        exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        if exists:
            buckets = spark.read.schema("buckets INT").parquet(spec).first()["buckets"]
        else:
            buckets = buckets or shuffle_width(spark)
            spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(spec)
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        return cls(spark, name, buckets)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        (
            rows.select("digest", F.col("keep_id").cast("bigint").alias("keep_id"))
            .repartition(self.buckets, "digest")  # one task writes one bucket
            .write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest")
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Per row of ``docs``: doc_id, digest, keep_id, group_size, kept; new digests join the index."""
    spark = docs.sparkSession
    seen = stored(docs.select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    groups = stored(
        seen.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups"
    )
    index.append(groups.hint("merge").join(index.table(), "digest", "left_anti"))
    owners = (
        groups.select("digest", "group_size").hint("merge")
        .join(index.table(), "digest")
        .select("digest", "group_size", "keep_id")
    )
    owners = stored(owners, "owners")
    share = owners.agg((F.sum("group_size") / shuffle_width(spark)).alias("share")).first()["share"] or 0.0
    hot = owners.filter(F.col("group_size") > max(share, 1.0))  # fewer rows than partitions
    few = hot.select(
        "digest", F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size")
    )
    marked = seen.join(F.broadcast(few), "digest", "left")
    in_hot = marked.filter("hot_size IS NOT NULL").select(
        "doc_id", "digest", F.col("hot_id").alias("keep_id"), F.col("hot_size").alias("group_size")
    )
    rest = marked.filter("hot_size IS NULL").select("doc_id", "digest").join(
        owners.filter(F.col("group_size") <= max(share, 1.0)), "digest"
    ).select("doc_id", "digest", "keep_id", "group_size")
    return in_hot.unionByName(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def fresh_index(spark: SparkSession) -> DigestIndex:
    """A new, empty index in the shared work folder."""
    return DigestIndex.open(spark, f"digests_{uuid.uuid4().hex}", work_folder(spark, "digest-index"))


def without_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    copy_id, copy_digest = free_name(docs, "_copy_id"), free_name(docs, "_copy_digest")
    copies = stored(
        deduplicate(docs, index).filter(~F.col("kept"))
        .select(F.col("doc_id").alias(copy_id), F.col("digest").alias(copy_digest)),
        "copies",
    )
    return docs.join(
        small_side(copies),
        docs["doc_id"].eqNullSafe(F.col(copy_id)) & (digest(docs["text"]) == F.col(copy_digest)),
        "left_anti",
    )
