from weirflow.sinks.jdbc import upsert_statement, write_jdbc
from weirflow.sinks.commits import expire
from weirflow.sinks.maintained import (
    apply_changes,
    delete_maintained,
    fold,
    maintained_row,
    maintained_rows,
    read_maintained,
    refresh_target,
    target_writer,
)
from weirflow.sinks.parquet import (
    compact_log,
    log_writer,
    read_log,
    read_metrics,
    read_target,
    target_row,
    target_rows,
    write_target,
)

__all__ = [
    "apply_changes",
    "compact_log",
    "delete_maintained",
    "expire",
    "fold",
    "log_writer",
    "maintained_row",
    "maintained_rows",
    "read_log",
    "read_maintained",
    "read_metrics",
    "read_target",
    "refresh_target",
    "target_row",
    "target_rows",
    "target_writer",
    "upsert_statement",
    "write_jdbc",
    "write_target",
]
