"""Merge rules on hand-written changes, their algebra, and skewed keys."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weirflow.operators import merge as merging, target
from weirflow.operators.mapping import bind_columns
from weirflow.operators.skew import hot_keys, spread_join
from weirflow.schema import COMPOSITE_KEY, TARGET_COLUMNS, TARGET_SCHEMA

ORDER = ("ord",)
FIELDS = ("source_table", "activity_id", "job_id", "company_name", "candidate", "job_title",
          "excluded_reason", "bcworkerid", "clienterpid", "standard_revenue_report_month")


def changes(spark, *rows):
    """Changes in order, each a source and some of the columns."""
    values = [
        (n, source, *[columns.get(f) for f in FIELDS[1:]])
        for n, (source, columns) in enumerate(rows)
    ]
    schema = "ord BIGINT, " + ", ".join(f"{f} STRING" for f in FIELDS)
    return bind_columns(spark.createDataFrame(values, schema), "ord", "source_table")


def table(frame):
    """Rows without their NULLs, in key order."""
    rows = [{k: v for k, v in r.asDict().items() if v is not None} for r in frame.collect()]
    return sorted(rows, key=lambda r: sorted(r.items()))


def A(key, **more):
    return "job_activity", {"activity_id": key, "candidate": "Jo", "company_name": "Co", **more}


def J(key, title, **more):
    return "jobs", {"activity_id": key, "job_title": title, **more}


def test_result_has_the_target_schema(spark):
    rows = changes(spark, A("1"))
    for mode in merging.MODES:
        got = merging.merge(rows, mode, order=ORDER).schema
        assert [(f.name, f.dataType) for f in got] == [
            (f.name, f.dataType) for f in TARGET_SCHEMA
        ], mode


def test_rules_differ_in_what_a_second_change_keeps(spark):
    rows = changes(spark, A("1"), J("1", "Dev"))
    kept = {"activity_id": "1", "candidate": "Jo", "company_name": "Co"}
    assert table(merging.merge(rows, "partial", order=ORDER)) == [{**kept, "job_title": "Dev"}]
    assert table(merging.merge(rows, "replace_row", order=ORDER)) == [
        {"activity_id": "1", "job_title": "Dev"}
    ]
    assert merging.merge(rows, "append", order=ORDER).count() == 2


def test_null_is_a_value(spark):
    rows = changes(spark, J("1", "Dev"), J("1", None), A("1", candidate=None))
    assert table(merging.merge(rows, "partial", order=ORDER)) == [
        {"activity_id": "1", "company_name": "Co"}
    ]


def test_key_sets(spark):
    rows = changes(spark, A("1", job_id="a"), A("1", job_id="b"), A("1", job_id="b", candidate="X"))
    assert merging.merge(rows, "replace_row", order=ORDER).count() == 1
    got = merging.merge(rows, "replace_row", COMPOSITE_KEY, ORDER)
    assert sorted((r.job_id, r.candidate) for r in got.collect()) == [("a", "Jo"), ("b", "X")]


@pytest.mark.parametrize("mode", ["replace_row", "partial"])
def test_replay_order_and_batches_do_not_matter(spark, mode):
    pick = random.Random(7)
    rows = []
    for n in range(300):
        key = "hot" if n % 3 == 0 else str(pick.randrange(40))
        rows.append(pick.choice([A(key, candidate=f"c{n}"), J(key, pick.choice([None, f"t{n}"]))]))
    whole = changes(spark, *rows)
    expected = table(merging.merge(whole, mode, order=ORDER))
    first, second = whole.filter("ord % 5 < 3"), whole.filter("ord % 5 >= 2")
    for again in (
        merging.merge(whole.union(whole), mode, order=ORDER),
        merging.merge(whole.orderBy("candidate").repartition(3), mode, order=ORDER),
        merging.merge(second, mode, order=ORDER, target=merging.compact(first, order=ORDER)),
        merging.merge(first, mode, order=ORDER, target=merging.compact(second, order=ORDER)),
    ):
        assert table(again) == expected
    # brute force
    state = {}
    for source, columns in rows:
        key = columns["activity_id"]
        own = {"job_activity": ("candidate", "company_name"), "jobs": ("job_title",)}[source]
        row = {} if mode == "replace_row" else dict(state.get(key, {}))
        row.update({c: columns.get(c) for c in own})
        state[key] = row
    assert expected == sorted(
        ({"activity_id": k, **{c: v for c, v in r.items() if v is not None}} for k, r in state.items()),
        key=lambda r: sorted(r.items()),
    )


def test_match_update(spark):
    rows = changes(
        spark,
        A("1", job_id="J1", bcworkerid="B1"), A("2", job_id="J1", bcworkerid="B2"), A("3"),
        ("jobs", {"job_id": "J1", "job_title": "old"}),
        ("jobs", {"job_id": "J1", "job_title": "Dev"}),
        ("jobs", {"job_id": "J9", "job_title": "nobody"}),
        ("jobs", {"job_title": "no key"}),
        ("clients_to_exclude", {"company_name": "Co", "excluded_reason": "Why"}),
        ("standard_revenue", {"bcworkerid": "B1", "clienterpid": "C1"}),
    )
    base = {"candidate": "Jo", "company_name": "Co", "excluded_reason": "Why"}
    expected = [
        {"activity_id": "1", "job_id": "J1", "job_title": "Dev", "bcworkerid": "B1",
         "clienterpid": "C1", **base},
        {"activity_id": "2", "job_id": "J1", "job_title": "Dev", "bcworkerid": "B2", **base},
        {"activity_id": "3", **base},
    ]
    first = merging.merge(rows, "match_update", order=ORDER)
    assert table(first) == sorted(expected, key=lambda r: sorted(r.items()))
    # a later batch on the merged table: only the same or no client matches
    later = changes(
        spark,
        A("1", job_id="J2", bcworkerid="B1"),
        ("standard_revenue", {"bcworkerid": "B1", "clienterpid": "C1",
                              "standard_revenue_report_month": "own"}),
        ("standard_revenue", {"bcworkerid": "B1", "clienterpid": "C2",
                              "standard_revenue_report_month": "other"}),
    )
    got = {r.activity_id: r for r in merging.match_existing(
        first, later, ORDER).collect()}
    assert len(got) == 3
    assert (got["1"].job_id, got["1"].job_title) == ("J2", "Dev")
    assert (got["1"].clienterpid, got["1"].standard_revenue_report_month) == ("C1", "own")
    last = changes(spark, ("standard_revenue", {"bcworkerid": "B1",
                                                "standard_revenue_report_month": "any"}))
    got = {r.activity_id: r for r in merging.match_existing(
        first, last, ORDER).collect()}
    assert (got["1"].clienterpid, got["1"].standard_revenue_report_month) == (None, "any")


def test_match_update_does_not_depend_on_batches(spark):
    rows = changes(
        spark,
        ("jobs", {"job_id": "J1", "job_title": "Dev"}),
        ("clients_to_exclude", {"company_name": "Co", "excluded_reason": "Why"}),
        A("1", job_id="J1", bcworkerid="B1"), A("1", job_id="J2", bcworkerid="B1"), A("2", job_id="J1"),
        ("standard_revenue", {"bcworkerid": "B1", "clienterpid": "C1"}),
        ("standard_revenue", {"bcworkerid": "B1", "standard_revenue_report_month": "m"}),
    )
    expected = table(merging.merge(rows, "match_update", order=ORDER))
    assert len(expected) == 2
    for cut in range(1, 7):
        early, late = rows.filter(f"ord < {cut}"), rows.filter(f"ord >= {cut}")
        for kept, batch in ((early, late), (late, early)):
            target = merging.compact(kept, order=ORDER)
            assert table(merging.merge(batch, "match_update", order=ORDER, target=target)) == expected


@pytest.mark.parametrize("keys", [("activity_id",), COMPOSITE_KEY])
@pytest.mark.parametrize("mode", [m for m in merging.MODES if m != "append"])
def test_compaction_loses_nothing(spark, mode, keys):
    pick = random.Random(11)
    rows = []
    for n in range(400):
        rows.append(pick.choice([
            A(str(n % 9), job_id=f"J{n % 5}", company_name=f"C{n % 7}", bcworkerid=f"B{n % 4}"),
            ("clients_to_exclude", {"activity_id": "client_record", "job_id": "client_record",
                                    "company_name": f"C{n % 7}", "excluded_reason": f"r{n}"}),
            ("jobs", {"activity_id": f"J{n % 5}", "job_id": f"J{n % 5}", "job_title": f"t{n}"}),
            ("standard_revenue", {"activity_id": f"B{n % 4}", "bcworkerid": f"B{n % 4}",
                                  "clienterpid": pick.choice([None, "E1", "E2"]),
                                  "standard_revenue_report_month": f"m{n}"}),
        ]))
    whole = changes(spark, *rows)
    small = merging.compact(whole, keys, ORDER)
    assert small.count() < whole.count()
    assert table(merging.merge(small, mode, keys, ORDER)) == table(merging.merge(whole, mode, keys, ORDER))
    cut = merging.compact(whole.filter("ord % 3 = 0"), keys, ORDER)
    later = merging.merge(whole.filter("ord % 3 > 0"), mode, keys, ORDER, target=cut)
    assert table(later) == table(merging.merge(whole, mode, keys, ORDER))


def test_hot_and_missing_keys_are_spread(spark):
    left = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS pk",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL "
        "ELSE CAST(id % 50 AS STRING) END AS k",
    )
    right = spark.range(60).selectExpr(
        "IF(id = 59, 'hot', CAST(id AS STRING)) AS k", "id AS v"
    )
    [hot] = hot_keys(left, [("k",)], share=0.02)
    named = [r.k for r in hot.collect()]
    assert "hot" in named and len(named) <= 50
    joined = spread_join(left, right, ["k"], spread_by="pk", hot=hot)
    expected = left.join(right, "k", "left")
    assert sorted(map(str, joined.select("pk", "k", "v").collect())) == sorted(
        map(str, expected.select("pk", "k", "v").collect()))


def test_hot_keys_that_differ_when_looked_at_again_lose_no_match(spark):
    chosen = F.udf(lambda k: os.urandom(1)[0] < 128, "boolean").asNondeterministic()
    keys = spark.range(200).selectExpr("CAST(id AS STRING) AS k")
    left, right = keys.selectExpr("k AS pk", "k"), keys.selectExpr("k", "CAST(k AS INT) AS v")
    joined = spread_join(left, right, ["k"], spread_by="pk", hot=keys.filter(chosen("k")))
    assert sorted(r.v for r in joined.collect() if r.v is not None) == list(range(200))


def test_target_reads_and_edits(spark):
    rows = merging.merge(
        changes(spark, A("test_activity_1"), A("testX"), A("keep", company_name=None)),
        "replace_row", order=ORDER,
    )
    assert target.count(rows).first().total_records == 3
    assert target.count(rows, target.like_any(["test_%"])).first().total_records == 2
    assert target.lookup(rows, "keep").count() == 1
    left = target.delete_where(rows, rows.company_name == "Co")
    assert [r.activity_id for r in left.collect()] == ["keep"]
    report = target.report(rows, ["keep", "none"], "test_record").collect()
    assert [(r.activity_id, r.record_type) for r in report] == [("keep", "test_record")]
