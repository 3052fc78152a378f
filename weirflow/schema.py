"""The wide target table and the source tables that feed it.

Everything that depends on a particular table is declared here as data; the
operators only read these declarations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The target's columns in output order.
TARGET_COLUMNS = (
    "activity_id", "job_id", "jobdiva_no", "candidate", "company_name",
    "assignment_start_date", "assignment_end_date", "job_title", "location",
    "excluded_reason", "sr_assignment_start", "sr_assignment_end",
    "standard_revenue_report_month", "clienterpid", "bcworkerid",
    "adjustedstbillrate", "adjustedstpayrate", "adjgphrst", "adjrevenue",
    "stbillrate",
)
TIMESTAMP_COLUMNS = (
    "assignment_start_date", "assignment_end_date",
    "sr_assignment_start", "sr_assignment_end",
)
DECIMAL_COLUMNS = (
    "adjustedstbillrate", "adjustedstpayrate", "adjgphrst", "adjrevenue",
    "stbillrate",
)
TARGET_KEY = ("activity_id",)
COMPOSITE_KEY = ("activity_id", "job_id", "company_name")

MONEY = T.DecimalType(10, 2)

# Column that carries the source tag inside a row image.
TAG_FIELD = "__source_table__"


def target_type(column: str) -> T.DataType:
    if column in TIMESTAMP_COLUMNS:
        return T.TimestampNTZType()
    if column in DECIMAL_COLUMNS:
        return MONEY
    return T.StringType()


TARGET_SCHEMA = T.StructType(
    [T.StructField(c, target_type(c), c not in TARGET_KEY) for c in TARGET_COLUMNS]
)


@dataclass(frozen=True)
class SourceTable:
    """How one source table maps onto the target.

    ``columns``      target column -> field of the row image
    ``placeholders`` target column -> literal, or ``@column`` to copy a column;
                     applied by the sink because the source has no such value
    ``match_on``     target columns that identify the rows a change updates
    """

    name: str
    columns: dict[str, str]
    placeholders: dict[str, str]
    match_on: tuple[str, ...]

    @property
    def owned(self) -> tuple[str, ...]:
        return tuple(self.columns)

    @property
    def written(self) -> tuple[str, ...]:
        names = {*self.columns, *self.placeholders}
        return tuple(c for c in TARGET_COLUMNS if c in names)


# Field mapping, placeholder keys and matching keys per source.
SOURCES = {
    s.name: s
    for s in (
        SourceTable(
            name="job_activity",
            columns={
                "activity_id": "activity_id",
                "job_id": "job_id",
                "jobdiva_no": "jobdiva_no",
                "candidate": "candidate_name",
                "company_name": "company_name",
                "assignment_start_date": "assignment_start_date",
                "assignment_end_date": "assignment_end_date",
                "bcworkerid": "bcworkerid",
            },
            placeholders={},
            match_on=("activity_id",),
        ),
        SourceTable(
            name="jobs",
            columns={
                "job_id": "job_id",
                "job_title": "job_title",
                "location": "location",
            },
            placeholders={"activity_id": "@job_id", "company_name": "job_record"},
            match_on=("job_id",),
        ),
        SourceTable(
            name="clients_to_exclude",
            columns={
                "company_name": "client_id",
                "excluded_reason": "exclusion_reason",
            },
            placeholders={"activity_id": "client_record", "job_id": "client_record"},
            match_on=("company_name",),
        ),
        SourceTable(
            name="standard_revenue",
            columns={
                "sr_assignment_start": "assignment_start_date",
                "sr_assignment_end": "assignment_end_date",
                "standard_revenue_report_month": "standard_revenue_report_month",
                "clienterpid": "clienterpid",
                "bcworkerid": "bcworkerid",
                "adjustedstbillrate": "adjusted_st_bill_rate",
                "adjustedstpayrate": "adjusted_st_pay_rate",
                "adjgphrst": "adj_gph_rst",
                "adjrevenue": "adj_revenue",
                "stbillrate": "st_bill_rate",
            },
            placeholders={
                "activity_id": "@bcworkerid",
                "job_id": "revenue_record",
                "company_name": "revenue_record",
            },
            match_on=("bcworkerid", "clienterpid"),
        ),
    )
}
SOURCE_NAMES = tuple(SOURCES)

# One change topic per source table.
TOPIC_PREFIX = "pgserver1.public."
DEFAULT_TOPICS = tuple(TOPIC_PREFIX + name for name in sorted(SOURCES))

# Operations that mark a delete; every other text, or none, is an upsert.
DELETE_OPS = ("d", "DELETE")

CORRUPT_FIELD = "_corrupt"


def image_fields() -> list[str]:
    """Fields read from a row image: every mapped source field, and the target
    columns and tag that an unmapped table may carry under their own names."""
    fields = [f for s in SOURCES.values() for f in s.columns.values()]
    return list(dict.fromkeys([*fields, *TARGET_COLUMNS, TAG_FIELD]))


def envelope_schema(before: bool = False) -> T.StructType:
    """A change event. Every leaf is text: one odd value must not make the
    whole event unreadable.

    Without ``before`` only one field of the earlier image is read, enough to
    see that it is an object.
    """
    text = T.StringType()
    image = T.StructType([T.StructField(f, text) for f in image_fields()])
    source = T.StructType([T.StructField("table", text), T.StructField("ts_ms", text)])
    return T.StructType([
        T.StructField("op", text),
        T.StructField("source", source),
        T.StructField("before", image if before else T.StructType(image.fields[:1])),
        T.StructField("after", image),
        T.StructField(CORRUPT_FIELD, text),
    ])


# A change event whose table has no mapping, with its images as maps.
OPEN_ENVELOPE_SCHEMA = (
    f"op STRING, source STRUCT<table: STRING, ts_ms: STRING>, before MAP<STRING, STRING>, "
    f"after MAP<STRING, STRING>, {CORRUPT_FIELD} STRING"
)
