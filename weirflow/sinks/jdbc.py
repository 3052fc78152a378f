"""Writing merged rows to a database table over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from weirflow.schema import TARGET_COLUMNS, TARGET_KEY

# Open connections at a time, whatever the number of partitions.
CONNECTIONS = 16
ROWS_PER_BATCH = 10_000


def write_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    connections: int = CONNECTIONS,
    **options: str,
) -> None:
    """Append rows, one per key, in batched inserts.

    Into a table whose inserts replace rows of the same key this is the upsert.
    Elsewhere write to a staging table, ``mode="overwrite"``, and run
    :func:`upsert_statement` in the database.
    """
    (
        rows.select(*TARGET_COLUMNS)
        # a shuffle of its own: only the write is as narrow as the connections
        .repartition(connections)
        .write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", ROWS_PER_BATCH)
        .option("truncate", "true")
        .options(**options)
        .save()
    )


def upsert_statement(
    table: str,
    staging: str,
    keys: Sequence[str] = TARGET_KEY,
    columns: Sequence[str] = TARGET_COLUMNS,
) -> str:
    """SQL that moves staged rows into the table, overwriting every column but
    the key where the key exists."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = VALUES({c})" for c in columns if c not in keys)
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"ON DUPLICATE KEY UPDATE {updates}"
    )
