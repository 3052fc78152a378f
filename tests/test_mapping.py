"""Events and the rows they are to become, written out by hand."""

import json
from datetime import datetime
from decimal import Decimal

import pytest

from weirflow.operators import mapping
from weirflow.operators.envelope import image_select, passthrough
from weirflow.schema import TARGET_COLUMNS


def event(table, op="c", after=None, **more):
    return json.dumps({"op": op, "source": {"table": table}, "after": after or {}, **more})


ACTIVITY = {
    "activity_id": "12345", "job_id": "JOB001", "jobdiva_no": "JD001",
    "candidate_name": "John Doe", "company_name": "TechCorp",
    "assignment_start_date": "2024-01-01 09:00:00",
    "assignment_end_date": "2024-12-31 17:00:00", "bcworkerid": "BC001",
}
REVENUE = {
    "bcworkerid": "BC001", "clienterpid": "CLIENT123", "adjusted_st_bill_rate": "75.50",
    "adjusted_st_pay_rate": "45.00", "adj_revenue": "5000.00",
    "standard_revenue_report_month": "2024-01",
}


def rows(frame):
    return [r.asDict() for r in frame.orderBy("offset").collect()]


def filled(row):
    return {c: row[c] for c in TARGET_COLUMNS if row[c] is not None}


def test_each_source_writes_its_columns_and_keys(feed):
    got = rows(mapping.changes(feed(
        event("job_activity", after=ACTIVITY),
        event("JOBS", "u", {"job_id": 123, "job_title": "Engineer", "location": None}),
        event("clients_to_exclude", after={"client_id": "Bad", "exclusion_reason": "Payment issues"}),
        event("standard_revenue", "u", REVENUE),
    )))
    assert [r["source_table"] for r in got] == [
        "job_activity", "jobs", "clients_to_exclude", "standard_revenue"
    ]
    assert filled(got[0]) == {
        "activity_id": "12345", "job_id": "JOB001", "jobdiva_no": "JD001",
        "candidate": "John Doe", "company_name": "TechCorp", "bcworkerid": "BC001",
        "assignment_start_date": datetime(2024, 1, 1, 9),
        "assignment_end_date": datetime(2024, 12, 31, 17),
    }
    assert filled(got[1]) == {
        "activity_id": "123", "job_id": "123", "company_name": "job_record",
        "job_title": "Engineer",
    }
    assert filled(got[2]) == {
        "activity_id": "client_record", "job_id": "client_record", "company_name": "Bad",
        "excluded_reason": "Payment issues",
    }
    assert filled(got[3]) == {
        "activity_id": "BC001", "job_id": "revenue_record", "company_name": "revenue_record",
        "bcworkerid": "BC001", "clienterpid": "CLIENT123",
        "standard_revenue_report_month": "2024-01", "adjustedstbillrate": Decimal("75.50"),
        "adjustedstpayrate": Decimal("45.00"), "adjrevenue": Decimal("5000.00"),
    }


DROPPED = [
    ("{ invalid json }", "parse_error"),
    ("{'op':'c'}", "parse_error"),
    ('{"op":"c","source":{"table":"jobs"},"after":{"job_id":NaN}}', "parse_error"),
    ('{"op":"c","source":"jobs","after":{"job_id":"1"}}', "parse_error"),
    ('{"op":"c","source":{"table":"jobs"},"after":"x"}', "parse_error"),
    ('{"op":"c","source":{"table":"jobs"},"before":"x","after":{"job_id":"1"}}', "parse_error"),
    (event("jobs", "d", before={"job_id": "1"}), "delete"),
    (event("jobs", "DELETE"), "delete"),
    ('{"op":"u","source":{"table":"jobs"},"after":null}', "no_image"),
    ('{"schema":{},"payload":{"op":"c"}}', "no_image"),
    ("{}", "no_image"),
    ("", "no_image"),
    (None, "no_image"),
    ('{"op":"c","after":{"job_id":"1"}}', "no_table"),
    (event("other"), "empty_image"),
    ('{"op":"c","source":{"table":"other"},"after":{  } }', "empty_image"),
    (event("other", after={"a": 1}), "unknown_table"),
    (event("job_activity"), "null_key"),
    (event("jobs", after={"job_title": "x"}), "null_key"),
    (event("standard_revenue", after={**REVENUE, "adj_revenue": "123456789.00"}), "bad_value"),
    (event("other", after={"__source_table__": "standard_revenue", "bcworkerid": "B",
                           "adjrevenue": "x"}), "bad_value"),
    # not dropped
    (event("jobs", "D", {"job_id": "1"}), None),
    (event("jobs", "delete", {"job_id": "1"}), None),
    (event("jobs", None, {"job_id": "1"}), None),
    ('{"source":{"table":"jobs"},"after":{"job_id":"1"}} trailing', None),
    (event("clients_to_exclude"), None),
    (event("other", after={"__source_table__": "Jobs", "job_id": "1"}), None),
]


def test_reasons_and_accounting(feed):
    messages = feed(*[text for text, _ in DROPPED])
    audited = mapping.audited_rows(messages)
    got = {r["offset"]: r["reason"] for r in audited.collect()}
    for n, (text, reason) in enumerate(DROPPED):
        assert got[n] == reason, text
    counts = {r.reason: r.events for r in mapping.drop_audit(audited).collect()}
    assert sum(counts.values()) == len(DROPPED)
    assert counts["accepted"] == mapping.changes(messages).count() == 6
    assert mapping.rejected(audited).count() == 4


def test_rows_bound_by_name(feed):
    got = rows(mapping.changes(feed(
        event("other", after={
            "__source_table__": "standard_revenue", "bcworkerid": "B1", "candidate": "dropped",
            "adjrevenue": 5, "sr_assignment_start": "2024-1-2 3:04:05",
        }),
    )))
    assert filled(got[0]) == {
        "activity_id": "B1", "job_id": "revenue_record", "company_name": "revenue_record",
        "bcworkerid": "B1", "adjrevenue": Decimal("5.00"),
        "sr_assignment_start": datetime(2024, 1, 2, 3, 4, 5),
    }
    full = rows(mapping.changes(feed(
        event("other", after={"activity_id": "x", "candidate": "kept"}),
        event("jobs", after={"job_id": "1"}),
    ), sink="full_row"))
    assert [filled(r) for r in full] == [{"activity_id": "x", "candidate": "kept"}]


def test_naming_sources_gives_the_same_rows(feed):
    messages = feed(*[text for text, _ in DROPPED], event("job_activity", after=ACTIVITY))
    whole = mapping.changes(messages)
    for name in ("job_activity", "jobs", "clients_to_exclude", "standard_revenue"):
        part = mapping.changes(messages, sources=[name])
        assert rows(part) == rows(whole.filter(f"source_table = '{name}'"))


def test_images_and_keys(feed):
    messages = feed(
        event("jobs", "d", before={"job_id": "1"}),
        event("standard_revenue", after={"bcworkerid": "B"}),
        event("other", after={"a": 1, "b": None}),
    )
    images = rows(image_select(messages))
    assert [i["table_name"] for i in images] == ["jobs", "standard_revenue", "other"]
    assert images[0]["image"].job_id == "1"
    keys = [r["matching_key"] for r in rows(mapping.matching_key(messages))]
    assert keys == [{"job_id": "1"}, {"bcworkerid": "B"}, {}]
    assert rows(passthrough(messages))[0]["image"] == {"a": "1", "b": None}


def test_unknown_names_are_refused(feed):
    with pytest.raises(ValueError):
        mapping.audited_rows(feed("{}"), sink="other")


def test_passthrough_keeps_the_last_of_a_repeated_field_and_drops_what_is_unusable(feed):
    got = rows(passthrough(feed(
        '{"op": "c", "source": {"table": "Extra"}, "after": {"a": 1, "b": "x", "a": null, "c": {"d": 2}, "b": "y"}}',
        '{"op": "d", "source": {"table": "extra"}, "before": {"a": 1}, "after": {"a": 1}}',
        '{"op": "c", "source": {"table": "extra"}, "after": {}}',
        '{"op": "c", "source": {"table": "extra"}, "after": null}',
        '{"op": "c", "source": {}, "after": {"a": 1}}',
        '{"op": "c", "source": {"table": "JOBS"}, "after": {"a": 1}}',
        "{ invalid json }", '{"op": "c", "source": {"table": "extra"}, "after": 5}',
        '{"op": "c", "source": {"table": "extra"}, "before": 5, "after": {"a": 1}}',
    )))
    assert [(r["offset"], r["table_name"], r["image"]) for r in got] == [
        (0, "extra", {"a": None, "b": "y", "c": '{"d":2}'})
    ]
