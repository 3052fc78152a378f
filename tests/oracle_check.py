"""Compare a query with its SQL oracle, row by row and type by type."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


# Spark type -> the oracle type that holds the same values
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "decimal(10,2)": "DECIMAL(10,2)",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs, at most a few lines; empty if nothing does."""
    result = con.sql(sql)
    expected_types = dict(zip(result.columns, map(str, result.types)))
    types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if types != expected_types:
        found.append(f"types: {types} != {expected_types}")
    names = sorted(types)
    if names != sorted(expected_types):
        return found
    got = Counter(map(tuple, df.select(*names).collect()))
    order = [result.columns.index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    for label, rows in (("only here", got - want), ("only oracle", want - got)):
        if rows:
            found.append(f"{label}: {sum(rows.values())} rows, e.g. {next(iter(rows))}")
    return found
