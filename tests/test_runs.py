"""Offset ranges, progress, rejects worked again, state-store merging."""

import re

import pytest
from pyspark.sql import functions as F
from sample_tables import SMALL
from test_mapping import event

from weirflow.operators import mapping, merge as merging
from weirflow.plans import queries
from weirflow.schema import TARGET_COLUMNS
from weirflow.sinks import log_writer, read_log, read_maintained, target_rows, write_target
from weirflow.sinks.parquet import finished_after
from weirflow.sources import read_change_files, stream_change_files
from weirflow.sources.offsets import append_messages, end_positions, offset_index, read_offsets
from weirflow.streaming import ProgressTable, ingest, maintain_partial, redrive


def rows(frame):
    return sorted(map(str, frame.select(*TARGET_COLUMNS).collect()))


@pytest.fixture
def messages(feed):
    return feed(*[event("jobs", after={"job_id": f"J{n % 5}", "job_title": f"t{n}"}) for n in range(40)])


def test_a_batch_of_a_maintained_target_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "work_folder", lambda spark, purpose: str(tmp_path / purpose))
    queries.stream_maintained(spark, SMALL)
    files = list((tmp_path / "topics").glob("*.parquet"))
    assert len(files) == 3 * spark.sparkContext.defaultParallelism


def test_buckets_grow_with_the_events():
    assert queries._buckets(0) == queries._buckets(10_000_000) == 10
    assert queries._buckets(100_000_001) == 101


def test_offset_ranges_open_only_their_files(spark, messages, tmp_path):
    path = str(tmp_path / "topic")
    append_messages(messages.filter("offset < 30"), path, rows_per_file=5)
    ends = end_positions(spark, path)
    assert ends == {("t", 0): 30}
    append_messages(messages.filter("offset >= 30"), path, rows_per_file=5)
    append_messages(messages.filter("offset < 3").withColumn("topic", F.lit("u")), path)
    assert offset_index(spark, path).agg(F.sum("messages")).first()[0] == 43

    def found(**bounds):
        read = read_offsets(spark, path, **bounds)
        return sorted((r.topic, r.offset) for r in read.collect()), len(read.inputFiles())

    everything, files = found()
    assert len(everything) == 43
    later, some = found(starting={**ends, ("u", 0): 3})
    assert later == [("t", n) for n in range(30, 40)] and some < files / 2
    assert found(starting={("t", 0): 7, ("u", 0): 9}, ending={("t", 0): 9})[0] == [("t", 7), ("t", 8)]
    assert found(ending={("t", 0): 0, ("u", 0): 0}) == ([], 0)
    empty = read_offsets(spark, path, ending={("t", 0): 0, ("u", 0): 0})
    assert empty.columns == ["value", "topic", "partition", "offset", "timestamp"]


def test_progress_counts_what_the_ingest_counts(spark, messages, tmp_path):
    topics, log = str(tmp_path / "topics"), str(tmp_path / "log")
    messages.repartition(3).write.parquet(topics)
    table = ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(table)
    try:
        run = ingest(stream_change_files(spark, topics, 1), log, str(tmp_path / "c"), name="told", interval=None)
        run.awaitTermination()
        assert table.wait(str(run.runId))
    finally:
        spark.streams.removeListener(table)
    told = table.read().orderBy("batch_id").collect()
    assert [r.batch_id for r in told] == [0, 1, 2] and sum(r.rows for r in told) == 40
    assert all(r.query == "told" and r.batch_millis >= r.write_millis > 0 and r.rows_done_per_second > 0 for r in told)


def test_rejects_are_worked_again_at_their_place(spark, feed, tmp_path):
    log = str(tmp_path / "log")
    values = [
        event("jobs", after={"job_id": "J1", "job_title": "old"}), event("jobs", after={"job_id": "J1", "job_title": "new"}),
        event("standard_revenue", after={"bcworkerid": "B1", "adj_revenue": "123456789.00"}),
    ]
    first, rest = feed(*values).filter("offset = 0"), feed(*values).filter("offset > 0")
    log_writer(log, "a", "full_row")(first, 0)  # no key: rejected
    log_writer(log, "a")(rest, 1)
    assert merging.merge(read_log(spark, log)).count() == 1
    for _ in range(2):
        redrive(spark, log, "again")
    # the event that came first does not win because it is worked last
    assert [r.job_title for r in merging.merge(read_log(spark, log)).collect()] == ["new"]
    redrive(spark, log, "corrected", corrected=lambda f: f.withColumn("value", F.regexp_replace("value", "123456789", "12")))
    assert rows(merging.merge(read_log(spark, log))) == rows(merging.merge(mapping.changes(
        feed(*values).withColumn("value", F.regexp_replace("value", "123456789", "12")))))


def test_partial_state_survives_a_restart(spark, messages, tmp_path):
    topics, path, checkpoint = (str(tmp_path / n) for n in ("topics", "target", "checkpoint"))
    for half in (1, 0):
        messages.filter(f"offset % 2 = {half}").repartition(2).write.mode("append").parquet(topics)
        maintain_partial(stream_change_files(spark, topics, 1), path, checkpoint, interval=None).awaitTermination()
    batch = merging.partial(mapping.changes(read_change_files(spark, topics), literals=False))
    assert rows(read_maintained(spark, path)) == rows(batch)


def test_batches_after_a_mark(spark, messages, tmp_path):
    log = str(tmp_path / "log")
    assert finished_after(spark, log, {}) == []
    for batch in (0, 1, 3):  # 2 is not finished
        log_writer(log, "a")(messages.limit(1), batch)
    log_writer(log, "b")(messages.limit(1), 0)
    assert finished_after(spark, log, {}) == [("a", 0), ("a", 1), ("b", 0)]
    assert finished_after(spark, log, {"a": 0, "b": 0}) == [("a", 1)]


def test_key_lists_read_as_many_buckets_as_keys(spark, messages, tmp_path):
    path = str(tmp_path / "target")
    write_target(merging.merge(mapping.changes(messages)), path, buckets=64)
    keys = [{"activity_id": f"J{n}"} for n in (1, 3, 77)]
    found = target_rows(spark, path, keys)
    assert sorted(r.activity_id for r in found.collect()) == ["J1", "J3"]
    [scan] = [x for x in found._jdf.queryExecution().executedPlan().toString().split(", ") if x.startswith("PartitionFilters: [bucket")]
    assert scan.count("bucket") and len(set(re.findall(r"\d+", scan.split(" IN ")[-1]))) <= 3
    with pytest.raises(ValueError):
        target_rows(spark, path, [{"job_id": "J1"}])
