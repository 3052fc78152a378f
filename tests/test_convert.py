from datetime import datetime
from decimal import Decimal

import pytest

from weirflow.functions.convert import standard_decimal, standard_timestamp
from weirflow.functions import (
    jdbc_timestamp,
    parse_datetime,
    parse_decimal,
    plain_decimal,
)

DATETIMES = [
    ("2024-01-01 09:00:00", datetime(2024, 1, 1, 9)),
    ("2024-01-01T09:00:00", datetime(2024, 1, 1, 9)),
    ("\t2024-01-01 09:00:00 ", datetime(2024, 1, 1, 9)),
    ("19723", datetime(2024, 1, 1)),
    ("99999", datetime(2243, 10, 16)),
    ("100000", datetime(1970, 1, 1, 0, 1, 40)),
    ("1704067200000", datetime(2024, 1, 1)),
    ("1704067200123", datetime(2024, 1, 1, 0, 0, 0, 123000)),
    ("2024-02-30 00:00:00", datetime(2024, 2, 29)),
    ("2023-02-31 10:00:00", datetime(2023, 2, 28, 10)),
    ("2024-04-31 00:00:00", datetime(2024, 4, 30)),
    ("2024-01-01 24:00:00", datetime(2024, 1, 2)),
    ("2024-12-31 24:00:00", datetime(2025, 1, 1)),
    *[(text, None) for text in (
        "2024-01-01", "2024-01-01 09:00:00.5", "2024-01-01T09:00:00Z",
        "2024-02-32 00:00:00", "2024-13-01 00:00:00", "2024-00-01 00:00:00",
        "2024-01-01 24:00:01", "2024-01-01 25:00:00", "2024-01-01 10:60:00",
        "0000-01-01 00:00:00", "-5", "abc", "", None, "99999999999999999999",
        "2024-01-01 09:00:00 ", "T2024-01-01 09:00:00",
    )],
]
DECIMALS = [
    ("75.50", "75.50"), (" 75.50 ", "75.50"), ("75.5", "75.50"), (".5", "0.50"),
    ("+5", "5.00"), ("-1.005", "-1.01"), ("1e3", "1000.00"), ("12.345", "12.35"),
    ("1.0E7", "10000000.00"), ("99999999", "99999999.00"),
    ("E8WS", "0.00"), ("5.", "0.00"), ("1,000", "0.00"), ("abc", "0.00"), ("--1", "0.00"),
    ("1e99999999999", "0.00"), ("1e-30", "0.00"),
    ("", None), (" \t", None), (None, None), ("123456789.00", None), ("1e30", None),
]
JDBC = [
    ("2024-01-01 09:00:00", datetime(2024, 1, 1, 9)),
    ("2024-1-1 9:5:7", datetime(2024, 1, 1, 9, 5, 7)),
    ("2024-01-01 09:00:00.25", datetime(2024, 1, 1, 9, 0, 0, 250000)),
    ("2023-02-30 23:59:75", datetime(2023, 3, 3, 0, 0, 15)),
    *[(text, None) for text in (
        "2024-01-01T09:00:00", "2024-01-01", "2024-13-01 00:00:00", "2024-01-32 00:00:00",
        "2024-01-01  09:00:00", "24-01-01 09:00:00", "19723", None,
    )],
]
PLAIN = [
    ("12.345", "12.35"), ("5.", "5.00"), (".5", "0.50"), ("1e2", "100.00"),
    (" 5", None), ("abc", None), ("", None), (None, None), ("123456789", None),
]


@pytest.mark.parametrize("convert, cases, value", [
    (parse_datetime, DATETIMES, lambda v: v),
    (parse_decimal, DECIMALS, lambda v: v and Decimal(v)),
    (jdbc_timestamp, JDBC, lambda v: v),
    (plain_decimal, PLAIN, lambda v: v and Decimal(v)),
])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_conversion(spark, convert, cases, value, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame(
            [(n, text) for n, (text, _) in enumerate(cases)], "n INT, text STRING"
        ).repartition(2)
        got = {r.n: r.v for r in rows.selectExpr("n", f"{convert('text')} AS v").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    for n, (text, expected) in enumerate(cases):
        assert got[n] == value(expected), text


def test_usual_forms_are_read_as_all_forms_are(spark):
    """And the text is split once, not anew for every part of the moment."""
    moments = ["2024-01-01 09:00:00", "2024-02-30 09:00:00", "0999-01-01 00:00:00", "2024-01-01 24:00:00",
               "2024-01-01 9:0:0.25", " 2024-01-01 09:00:00", "x", "", None]
    numbers = ["1.25", "-7", "1234567.89", "12345678", "1.255", "5.", ".5", "1e2", " 1", "x", "", None]
    for texts, all_forms, usual in (
        (moments, jdbc_timestamp, standard_timestamp), (numbers, plain_decimal, standard_decimal)
    ):
        rows = spark.createDataFrame([(t,) for t in texts], "t STRING").selectExpr(
            "t", f"{all_forms('t')} AS x", f"{usual('t')} AS y"
        ).collect()
        assert all(r.y is None or r.y == r.x for r in rows) and rows[0].y is not None
    assert jdbc_timestamp("t").count("split(") == 1
