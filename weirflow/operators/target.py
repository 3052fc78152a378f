"""Reading and editing the merged target table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.operators.mapping import bind_columns
from weirflow.schema import TARGET_COLUMNS


def lookup(target: DataFrame, activity_id: str) -> DataFrame:
    """The rows of one key."""
    return target.filter(F.col("activity_id") == activity_id)


def in_list(ids: Sequence[str]) -> Column:
    return F.col("activity_id").isin(*ids)


def like_any(patterns: Sequence[str]) -> Column:
    """True where the key is like one of the patterns; ``_`` is a wildcard."""
    return reduce(
        lambda a, b: a | b, [F.col("activity_id").like(p) for p in patterns]
    )


def report(target: DataFrame, ids: Sequence[str], record_type: str) -> DataFrame:
    """Selected columns of some keys with a constant label, in key order."""
    return (
        target.filter(in_list(ids))
        .select(
            "activity_id", "job_id", "company_name", "candidate", "job_title",
            "excluded_reason", "bcworkerid", "adjustedstbillrate",
            F.lit(record_type).alias("record_type"),
        )
        .orderBy("activity_id")
    )


def sample(target: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in key order."""
    return target.orderBy("activity_id").limit(rows)


def count(target: DataFrame, where: Column | None = None, name: str = "total_records") -> DataFrame:
    rows = target if where is None else target.filter(where)
    return rows.agg(F.count("*").alias(name))


def delete_where(target: DataFrame, where: Column) -> DataFrame:
    """What is left after deleting the rows for which ``where`` is true."""
    return target.filter(~F.coalesce(where, F.lit(False)))


def insert_values(
    changes: DataFrame, rows: DataFrame, source_table: str, after: Column
) -> DataFrame:
    """Changes plus literal rows, given in any subset of the target's columns.

    ``after`` is their time, a timestamp later than that of every change they
    are to replace; their order among themselves is the column ``position``.
    """
    bound = bind_columns(rows, "position").select(
        after.alias("timestamp"),
        F.lit("insert").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("position").cast("bigint").alias("offset"),
        F.lit(source_table).alias("source_table"),
        *TARGET_COLUMNS,
    )
    return changes.select(bound.columns).unionByName(bound)
