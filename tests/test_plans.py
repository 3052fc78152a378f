"""What the physical plans must and must not contain."""

import re

import pytest
from sample_tables import SMALL

from weirflow.functions.convert import decimal_overflow, java_trim
from weirflow.operators.envelope import parse_envelope
from weirflow.plans import QUERIES
from weirflow.sources import change_feed, read_table


def plan(spark, name):
    frame = QUERIES[name](spark, SMALL)
    return frame._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "refresh_", "target_", "ingest_")))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_products(spark, name):
    text = plan(spark, name)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                     "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_text_is_parsed_once(spark):
    for name in ("sink_jobs", "map_unknown_passthrough"):
        text = plan(spark, name)
        assert text.count("from_json(") == 1 and "get_json_object(value" not in text.split("from_json(")[0]


def test_last_change_is_reduced_before_the_shuffle(spark):
    for name in ("merge_replace_row", "merge_replace_row_composite", "sink_full_row_upsert"):
        text = plan(spark, name)
        partial, exchange = text.index("row_number(), 1, Partial"), text.index("Exchange hash")
        assert text.index("row_number(), 1, Final") < exchange < partial
    assert "partial_max_by" in plan(spark, "merge_partial")


def test_only_used_columns_are_read(spark):
    text = plan(spark, "merge_partial")
    assert "o_orderdate" not in text


def test_a_merge_has_one_shuffle(spark):
    assert plan(spark, "merge_replace_row").count("Exchange") == 1


def test_match_update_shuffles_each_side_once(spark):
    frame = QUERIES["merge_match_update"](spark, SMALL)
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shuffles = [line for line in text.split("\n") if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    for key in ("activity_id", "job_id", "company_name", "bcworkerid"):
        assert sum(f"hashpartitioning({key}#" in line for line in shuffles) <= 1, key
    assert "__salt" not in text


@pytest.mark.parametrize("name, joins", [("merge_match_update", 3), ("match_existing_two_part", 4)])
def test_only_changes_of_hot_keys_are_broadcast(spark, name, joins):
    frame = QUERIES[name](spark, SMALL)
    assert frame._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == joins
    frame.collect()  # and no more when the shuffles have been measured
    text = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("BroadcastHashJoin") <= joins


def code_sizes(frame):
    """Bytes of the largest method that Spark generates for each part of a plan."""
    debug = getattr(getattr(frame.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    text = debug.codegenString(frame._jdf.queryExecution().executedPlan())
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_methods_of_a_feed_are_small_enough_to_be_compiled(spark):
    feed = change_feed(lambda name: read_table(spark, SMALL, name))
    sizes = code_sizes(feed)
    assert sizes and max(sizes) < 8000  # the JVM interprets larger ones


def test_routing_is_generated_code(spark, feed):
    text = parse_envelope(feed("{}"))._jdf.queryExecution().executedPlan().toString()
    (parse,) = [line for line in text.split("\n") if "from_json(" in line]
    assert "parse_error" in text and "parse_error" not in parse  # it was in the lambda of the parse


def test_whether_a_decimal_fits(spark):
    values = ["12.34", "99999999", "  123456789.00\t", " " * 9, "1e8", "1e7", "123456789", "not a number", None]
    rows = spark.createDataFrame([(v,) for v in values], "raw STRING")
    found = rows.selectExpr("raw", f"{java_trim('raw')} AS clean").selectExpr(f"{decimal_overflow('raw', 'clean')} AS x")
    assert [bool(r.x) for r in found.collect()] == [False, False, True, False, True, False, True, False, False]
