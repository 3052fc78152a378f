from weirflow.functions.convert import (
    java_trim,
    jdbc_timestamp,
    parse_datetime,
    parse_decimal,
    plain_decimal,
)

__all__ = [
    "java_trim",
    "jdbc_timestamp",
    "parse_datetime",
    "parse_decimal",
    "plain_decimal",
]
