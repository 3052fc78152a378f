"""The corpus pipeline: from raw documents to token digests, each stage written and read again.

Every stage works on all rows that its predecessor kept. The first four only drop rows and
keep the columns of ``documents``; the last returns one row per document that is left.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from weirflow.llm import decontamination, exact_dedup, near_dup, sentencepiece_codec, toxicity
from weirflow.llm.common import stored, table
from weirflow.llm.queries import tokenizer


#: Bytes and rows of texts that go to a Python worker at once; executors hold several such batches for each task.
BATCH_BYTES, BATCH_ROWS = "4m", "1000"


def in_small_batches(stage):
    """The stage with Arrow batches bounded in bytes and rows, where the session leaves Spark's defaults.

    Workers live through all stages, so that what the largest batch took stays with them.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, bound in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
            name = f"spark.sql.execution.arrow.{key}"
            if not spark.sparkContext.getConf().contains(name):
                spark.conf.set(name, bound)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labelled rows of ``docs``, does not call toxic."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@in_small_batches
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each set of equal texts."""
    return exact_dedup.without_copies(docs, exact_dedup.fresh_index(spark))


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each component of near copies."""
    return near_dup.one_of_each(docs)


@in_small_batches
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return sentencepiece_codec.digests(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: SQL has neither the learned grammar nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
