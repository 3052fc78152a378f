import glob
import os
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from weirflow.operators import mapping, merge as merging
from weirflow.schema import TARGET_COLUMNS
from weirflow.session import READ_TASKS, spread_reads, work_folder
from weirflow.sinks import (
    compact_log, log_writer, maintained_row, read_log, read_maintained, read_target, refresh_target,
    target_row, upsert_statement, write_target,
)
from weirflow.sinks.maintained import manifest
from weirflow.sinks.parquet import changes_by_source
from weirflow.sources import read_change_files, split_topics, stream_change_files
from weirflow.streaming import ingest

from test_mapping import DROPPED, event


def rows(frame):
    return sorted(map(str, frame.select(*TARGET_COLUMNS).collect()))


@pytest.fixture
def topics(spark, feed, tmp_path):
    messages = feed(*[text for text, _ in DROPPED], *[
        event("jobs", after={"job_id": f"J{n % 7}", "job_title": f"t{n}"}) for n in range(40)
    ])
    path = str(tmp_path / "topics")
    messages.repartition(5).write.parquet(path)
    return path


def runs_of(log):
    return [name for name in os.listdir(log) if name.startswith("run=")]


def run(spark, topics, log, tmp_path, name, files):
    query = ingest(
        stream_change_files(spark, topics, files), log, str(tmp_path / name), name=name, interval=None
    )
    query.awaitTermination()


def test_stream_equals_batch_and_replay_changes_nothing(spark, topics, tmp_path):
    log = str(tmp_path / "log")
    expected = rows(merging.merge(mapping.changes(read_change_files(spark, topics))))
    run(spark, topics, log, tmp_path, "first", 2)
    # a batch delivered again replaces itself
    [one] = runs_of(log)
    assert len([f for f in os.listdir(f"{log}/{one}") if f.startswith("batch_id=")]) > 1
    retry = log_writer(log, one.removeprefix("run="))
    first_batch = read_log(spark, log, outcome=None).filter("batch_id = 0")
    offsets = [r.offset for r in first_batch.collect()]
    messages = read_change_files(spark, topics)
    retry(messages.filter(messages["offset"].isin(offsets)), 0)
    assert rows(merging.merge(read_log(spark, log))) == expected
    everything = read_log(spark, log, outcome=None)
    assert everything.count() == len(DROPPED) + 40
    kept = everything.filter("outcome = 'parse_error'").select("value").collect()
    assert "{ invalid json }" in [r.value for r in kept]
    run(spark, topics, log, tmp_path, "again", 3)
    assert read_log(spark, log, outcome=None).count() == 2 * (len(DROPPED) + 40)
    assert rows(merging.merge(read_log(spark, log))) == expected
    compact_log(spark, log, str(tmp_path / "small"))
    small = read_log(spark, str(tmp_path / "small"))
    assert rows(merging.merge(small)) == expected
    assert small.count() < read_log(spark, log).count()
    assert changes_by_source(spark, log)["clients_to_exclude"].count() == 2


def test_unfinished_batches_are_not_read(spark, topics, tmp_path):
    log = str(tmp_path / "log")
    assert read_log(spark, log).count() == 0
    run(spark, topics, log, tmp_path, "first", 2)
    whole = read_log(spark, log, outcome=None).count()
    [one] = runs_of(log)
    os.remove(f"{log}/{one}/batch_id=0/_SUCCESS")  # as if it were being written
    assert 0 < read_log(spark, log, outcome=None).count() < whole


def test_refresh_reads_only_touched_buckets(spark, topics, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "target")
    run(spark, topics, log, tmp_path, "first", 2)
    batches = refresh_target(spark, log, path)
    assert batches > 1 and refresh_target(spark, log, path) == 0
    expected = rows(merging.merge(mapping.changes(read_change_files(spark, topics))))
    assert rows(read_maintained(spark, path)) == expected
    before = manifest(spark, path)
    one = maintained_row(spark, path, {"activity_id": "J3"})
    assert [r.job_title for r in one.collect()] == ["t38"]
    assert {name.split("bucket=")[1].split("/")[0] for name in one.inputFiles()} == {
        str(b) for b in before.versions if f"bucket={b}/" in "".join(one.inputFiles())
    } and len({name.rsplit("/", 1)[0] for name in one.inputFiles()}) == 1
    # one more change rewrites its own bucket alone
    later = read_change_files(spark, topics).filter("value LIKE '%J3%'").limit(1)
    log_writer(log, "later")(later, 0)
    assert refresh_target(spark, log, path) == 1
    after = manifest(spark, path)
    assert sum(after.versions[b] != before.versions.get(b) for b in after.versions) == 1
    with pytest.raises(ValueError):
        refresh_target(spark, log, path, mode="partial")


def test_partial_merge_as_a_stateful_stream(spark, topics):
    stream = mapping.changes(stream_change_files(spark, topics, 2), literals=False)
    query = (
        merging.partial(stream).writeStream.outputMode("complete").format("memory")
        .queryName("partial_state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = merging.partial(mapping.changes(read_change_files(spark, topics), literals=False))
    assert rows(spark.table("partial_state")) == rows(batch)


def test_target_buckets(spark, topics, tmp_path):
    merged = merging.merge(mapping.changes(read_change_files(spark, topics)))
    path = str(tmp_path / "target")
    write_target(merged, path, buckets=64)
    assert rows(read_target(spark, path)) == rows(merged)
    one = target_row(spark, path, {"activity_id": "J3"})
    assert [r.job_title for r in one.collect()] == ["t38"]
    assert len(one.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        target_row(spark, path, {"activity_id": "J3", "job_id": "J3"})
    assert all(name.startswith(("bucket=", "_", ".")) for name in os.listdir(path))


def test_topics_and_folders(spark, feed):
    parts = split_topics(feed("{}", "{}"), ["t", "u"])
    assert [parts[t].count() for t in ("t", "u")] == [2, 0]
    assert work_folder(spark, "x") != work_folder(spark, "x")
    shared = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: "/shared/work/"))
    assert work_folder(shared, "log").startswith("/shared/work/log-")
    unset = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(ValueError):
        work_folder(unset, "log")


def test_upsert_statement():
    sql = upsert_statement("t", "s", columns=("activity_id", "job_id"))
    assert sql == (
        "INSERT INTO t (activity_id, job_id) SELECT activity_id, job_id FROM s "
        "ON DUPLICATE KEY UPDATE job_id = VALUES(job_id)"
    )


def test_files_of_events_can_be_split_between_tasks(spark, feed, tmp_path):
    """A log's files have several row groups, and its events are read in more tasks than there are cores."""
    long = F.concat(*[F.sha2(F.concat("id", F.lit(f" {n}")), 512) for n in range(10)])
    texts = spark.range(0, 40_000, 1, 1).select(
        long.alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.timestamp_millis("id").alias("timestamp"),
    )
    log = str(tmp_path / "log")
    log_writer(log, "a")(texts, 0)
    (file,) = glob.glob(f"{log}/run=a/batch_id=0/outcome=parse_error/*/*.parquet")
    (groups,) = duckdb.execute("SELECT count(DISTINCT row_group_id) FROM parquet_metadata(?)", [file]).fetchone()
    assert groups > 3

    def tasks():
        return read_log(spark, log, outcome="parse_error").select("value").rdd.getNumPartitions()

    few = tasks()
    with spread_reads(spark):
        assert few <= spark.sparkContext.defaultParallelism < tasks()
    assert spark.conf.get(READ_TASKS, None) is None and tasks() == few
    assert read_log(spark, log, outcome="parse_error").select("value").distinct().count() == 40_000
