"""Synthetic events by rule.

Each generator takes a frame with a column ``i`` of distinct numbers and makes
events for every ``i``; all other values follow from ``i``, so a run can be
repeated and checked. Size and parallelism are those of the given frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.schema import MONEY

# The domains that generated fields are taken from.
FIRST_NAMES = ("John", "Jane", "Mike", "Sarah", "David", "Lisa", "Chris", "Amy", "Tom", "Emma")
LAST_NAMES = (
    "Smith", "Johnson", "Williams", "Brown", "Jones",
    "Garcia", "Miller", "Davis", "Rodriguez", "Martinez",
)
COMPANIES = (
    "TechCorp", "DataSoft", "CloudSys", "Analytics Inc", "BigData Co",
    "AI Solutions", "DataFlow", "StreamTech", "Pipeline Corp", "RealTime Systems",
)
JOB_TITLES = (
    "Software Engineer", "Data Scientist", "DevOps Engineer", "Product Manager",
    "Data Engineer", "Backend Developer", "Frontend Developer",
    "Full Stack Developer", "Data Analyst", "System Architect",
)
LOCATIONS = (
    "San Francisco, CA", "New York, NY", "Seattle, WA", "Austin, TX", "Boston, MA",
    "Chicago, IL", "Denver, CO", "Los Angeles, CA", "Miami, FL", "Portland, OR",
)
EXCLUSION_REASONS = (
    "Payment issues", "Contract disputes", "Quality concerns", "Timeline conflicts",
    "Budget overruns", "Communication problems", "Scope creep",
    "Resource constraints", "Technical incompatibility", "Business policy violation",
)


def _pick(values: tuple[str, ...], number: Column) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def _padded(prefix: str, number: Column, width: int = 3) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number)


def _name(i: Column) -> Column:
    return F.concat_ws(" ", _pick(FIRST_NAMES, i), _pick(LAST_NAMES, i * 3))


def _moment(i: Column) -> Column:
    """A minute of 2024 on one of the first 28 days of a month."""
    return F.format_string(
        "2024-%02d-%02d %02d:%02d:00", i % 12 + 1, i % 28 + 1, i % 24, i % 60
    )


def _amount(low: int, span: int, i: Column) -> Column:
    """Two decimals from ``low`` up to, not including, ``low + span``."""
    cents = F.pmod(i * 37, F.lit(span * 100)) + low * 100
    return (cents.cast("decimal(18,2)") / 100).cast(MONEY)


def _event(op: str, table: str, **fields: Column) -> Column:
    return F.to_json(F.struct(
        F.lit(op).alias("op"),
        F.struct(F.lit(table).alias("table")).alias("source"),
        F.struct(*[value.alias(name) for name, value in fields.items()]).alias("after"),
    ))


def job_activity_event(activity_id: Column, op: str, i: Column) -> Column:
    return _event(
        op, "job_activity",
        activity_id=activity_id,
        job_id=_padded("JOB_", i * 7 % 1000),
        jobdiva_no=_padded("JD", i * 11 % 1000),
        candidate_name=_name(i),
        company_name=_pick(COMPANIES, i),
        assignment_start_date=_moment(i),
        assignment_end_date=_moment(i + 5),
        bcworkerid=_padded("BC", i * 13 % 1000),
    )


def jobs_event(job_id: Column, op: str, i: Column) -> Column:
    return _event(
        op, "jobs",
        job_id=job_id,
        job_title=_pick(JOB_TITLES, i),
        location=_pick(LOCATIONS, i),
    )


def revenue_event(bcworkerid: Column, op: str, i: Column) -> Column:
    return _event(
        op, "standard_revenue",
        bcworkerid=bcworkerid,
        clienterpid=_padded("CLIENT", i * 17 % 1000),
        adjusted_st_bill_rate=_amount(50, 50, i).cast("string"),
        adjusted_st_pay_rate=_amount(30, 30, i).cast("string"),
        adj_gph_rst=_amount(0, 20, i).cast("string"),
        adj_revenue=_amount(1000, 2000, i).cast("string"),
        st_bill_rate=_amount(45, 40, i).cast("string"),
        standard_revenue_report_month=F.format_string("2024-%02d", i % 12 + 1),
        assignment_start_date=_moment(i),
        assignment_end_date=_moment(i + 5),
    )


def exclusion_event(client_id: Column, op: str, i: Column) -> Column:
    return _event(
        op, "clients_to_exclude",
        client_id=client_id,
        exclusion_reason=_pick(EXCLUSION_REASONS, i),
    )


def _exploded(ids: DataFrame, *events: Column) -> DataFrame:
    """One row per event, NULL events left out: ``i, step, value``."""
    return ids.select("i", F.posexplode(F.array(*events)).alias("step", "value")).filter(
        F.col("value").isNotNull()
    )


def batch_events(ids: DataFrame) -> DataFrame:
    """Per ``i`` an activity, a job and a revenue event, and an exclusion for
    every fifth."""
    i = F.col("i")
    return _exploded(
        ids,
        job_activity_event(_padded("test_activity_", i), "c", i),
        jobs_event(_padded("JOB_", i), "c", i),
        revenue_event(_padded("BC", i), "c", i),
        F.when(i % 5 == 0, exclusion_event(_padded("CLIENT_", i), "c", i)),
    )


def performance_events(ids: DataFrame) -> DataFrame:
    """Per ``i`` an activity event, and a job update for every tenth."""
    i = F.col("i")
    return _exploded(
        ids,
        job_activity_event(_padded("perf_test_", i, 6), "c", i),
        F.when(i % 10 == 0, jobs_event(_padded("JOB_", i % 100), "u", i)),
    )


def scenario_events(ids: DataFrame) -> DataFrame:
    """Per ``i`` four events that touch the four sources in turn, numbered from
    one: an insert and three updates."""
    i = F.col("i")
    return _exploded(
        ids,
        job_activity_event(F.concat(F.lit("upsert_test_"), i.cast("string")), "c", i),
        jobs_event(_padded("JOB_", i), "u", i),
        revenue_event(_padded("BC", i), "u", i),
        exclusion_event(_padded("CLIENT", i), "u", i),
    )


def target_rows(ids: DataFrame) -> DataFrame:
    """Per ``i`` an already mapped row."""
    i = F.col("i")
    key = i.cast("string")
    return ids.select(
        key.alias("activity_id"),
        F.concat(F.lit("TEST_JOB_"), key).alias("job_id"),
        _padded("JD", i * 11 % 1000).alias("jobdiva_no"),
        _name(i).alias("candidate"),
        _pick(COMPANIES, i).alias("company_name"),
        _moment(i).try_cast("timestamp_ntz").alias("assignment_start_date"),
        _moment(i + 5).try_cast("timestamp_ntz").alias("assignment_end_date"),
        _pick(JOB_TITLES, i).alias("job_title"),
        _pick(LOCATIONS, i).alias("location"),
        _padded("BC", i * 13 % 1000).alias("bcworkerid"),
        _amount(50, 50, i).alias("adjustedstbillrate"),
        _amount(30, 30, i).alias("adjustedstpayrate"),
        _amount(1000, 2000, i).alias("adjrevenue"),
    )
