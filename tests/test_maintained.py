"""The maintained target: transactions, layers, deletes, matching keys."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_mapping import event

from weirflow.operators import mapping, merge as merging
from weirflow.schema import TARGET_COLUMNS
from weirflow.sinks import commits, maintained
from weirflow.sinks.commits import Conflict, Snapshot


def rows(frame):
    return sorted(map(str, frame.select(*TARGET_COLUMNS).collect()))


def feed_rows(feed, start, *values):
    return feed(*values).withColumn("offset", F.col("offset") + start).withColumn(
        "timestamp", F.timestamp_millis(F.col("offset"))
    )


def random_events(seed, count):
    rng = random.Random(seed)
    out = []
    for n in range(count):
        out.append(rng.choice([
            lambda: event("job_activity", after={
                "activity_id": f"A{rng.randrange(9)}", "job_id": rng.choice(["J1", "J2", "J3", None]),
                "company_name": rng.choice(["C1", "C2", None]), "bcworkerid": rng.choice(["W1", "W2", None]), "candidate_name": f"c{n}",
            }),
            lambda: event("jobs", after={"job_id": f"J{rng.randrange(4)}", "job_title": f"t{n}"}),
            lambda: event("clients_to_exclude", after={"client_id": f"C{rng.randrange(3)}", "exclusion_reason": f"r{n}"}),
            lambda: event("standard_revenue", after={"bcworkerid": f"W{rng.randrange(3)}", "adj_revenue": f"{n}.5"}),
        ])())
    return out


def apply(frame, path, batch, mode="replace_row", run="r"):
    return maintained.apply_changes(frame, path, run, batch, mode, buckets=4)


@pytest.mark.parametrize("mode", ["replace_row", "partial", "match_update"])
def test_batches_in_any_order_equal_one_merge(spark, feed, tmp_path, mode):
    literals = mode == "replace_row"
    parts = [feed_rows(feed, 100 * k, *random_events(k, 25)) for k in range(4)]
    changes = [mapping.changes(p, literals=literals) for p in parts]
    whole = changes[0]
    for c in changes[1:]:
        whole = whole.unionByName(c)
    expected = rows(merging.merge(whole, mode))
    path = str(tmp_path / "target")
    for batch, k in enumerate([2, 0, 3, 1]):
        assert apply(changes[k], path, batch, mode)
    assert not apply(changes[0], path, 3, mode)  # replayed
    known = commits.latest(spark, path)
    assert known.marks == {"r": 3} and max(map(len, known.versions.values())) > 1
    target = maintained.read_maintained(spark, path)
    assert rows(target) == expected
    assert "Exchange" not in target._jdf.queryExecution().executedPlan().toString()
    # folded, the same; one layer is left
    assert maintained.fold(spark, path, layers=2) > 0
    known = commits.latest(spark, path)
    assert all(len(ls) == 1 for by in known.layers.values() for ls in by.values())
    assert rows(maintained.read_maintained(spark, path)) == expected
    # and so with a later batch on top
    assert apply(changes[2], path, 0, mode, run="again")
    assert rows(maintained.read_maintained(spark, path)) == expected
    one = maintained.maintained_rows(spark, path, [{"activity_id": "A1"}, {"activity_id": "A2"}, {"activity_id": "no"}])
    assert set(rows(one)) == {r for r in expected if "activity_id='A1'" in r or "activity_id='A2'" in r}
    assert len({f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()}) <= 3


def test_a_batch_stopped_before_its_commit_leaves_nothing(spark, feed, tmp_path, monkeypatch):
    path = str(tmp_path / "target")
    first = mapping.changes(feed(event("jobs", after={"job_id": "J1", "job_title": "a"})))
    later = mapping.changes(feed_rows(feed, 9, event("jobs", after={"job_id": "J1", "job_title": "b"})))
    apply(first, path, 0)
    before = rows(maintained.read_maintained(spark, path))

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(maintained, "commit", stop)
        with pytest.raises(RuntimeError):
            apply(later, path, 1)
    assert rows(maintained.read_maintained(spark, path)) == before
    layers = sum(len(names) for _, names, _ in os.walk(f"{path}/layers/rows") if names and len(names[0]) == 32)
    assert layers == 2  # one of nobody
    assert commits.expire(spark, path, hours=0) == 1
    assert apply(later, path, 1)
    assert [r.job_title for r in maintained.read_maintained(spark, path).collect()] == ["b"]


def test_of_two_writers_one_commits_and_the_other_begins_again(spark, feed, tmp_path, monkeypatch):
    path = str(tmp_path / "target")
    one, two = (
        mapping.changes(feed_rows(feed, k, event("jobs", after={"job_id": f"J{k}", "job_title": "t"}))) for k in (1, 2)
    )
    begun = Snapshot(0, "replace_row", ("activity_id",), 4)
    commits.commit(spark, path, begun)
    with pytest.raises(Conflict):
        commits.commit(spark, path, begun)
    plain, between = maintained._worked_in, []

    def overtaken(changes, *rest):
        made = plain(changes, *rest)
        if not between:
            between.append(True)
            assert apply(two, path, 0, run="other")
        return made

    monkeypatch.setattr(maintained, "_worked_in", overtaken)
    assert apply(one, path, 0, run="mine")
    known = commits.latest(spark, path)
    assert known.marks == {"mine": 0, "other": 0} and known.number == 3
    assert [r.activity_id for r in maintained.read_maintained(spark, path).orderBy("activity_id").collect()] == ["J1", "J2"]


def test_old_snapshots_expire(spark, feed, tmp_path):
    path = str(tmp_path / "target")
    for n in range(4):
        apply(mapping.changes(feed_rows(feed, n, event("jobs", after={"job_id": "J1", "job_title": f"t{n}"}))), path, n)
    maintained.fold(spark, path, layers=2)
    assert commits.expire(spark, path, keep=1) == 0  # too young: a writer might need them
    assert commits.commit_numbers(spark, path) == [5]
    assert commits.expire(spark, path, keep=1, hours=0) == 4
    assert [r.job_title for r in maintained.read_maintained(spark, path).collect()] == ["t3"]


def test_a_commit_does_not_grow_with_the_batches():
    known, sizes = Snapshot(0, "replace_row", ("activity_id",), 4), []
    for batch in range(1000):
        known = known.with_layer("rows", f"{batch:032x}", [0, 1, 2, 3]).with_mark("run", batch)
        if len(known.versions[0]) >= maintained.LAYERS:
            known = known.with_folded("rows", f"{batch:032x}", [0, 1, 2, 3], [0, 1, 2, 3])
        sizes.append(len(known.text()))
    assert max(sizes[500:]) <= max(sizes[:20]) + 2
    assert Snapshot.of(0, known.text()) == known


def data_files(path):
    return {
        os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
        for d, _, names in os.walk(f"{path}/layers") for f in names if f.endswith(".parquet")
    }


@pytest.mark.parametrize("mode", ["replace_row", "match_update"])
def test_deletes_rewrite_nothing(spark, feed, tmp_path, mode):
    path = str(tmp_path / "target")
    changes = mapping.changes(
        feed(*[event("job_activity", after={"activity_id": f"A{n}", "job_id": "J1"}) for n in range(8)],
             event("jobs", after={"job_id": "J1", "job_title": "t"})), literals=mode != "match_update",
    )
    apply(changes, path, 0, mode)
    before = data_files(path)
    maintained.delete_maintained(spark, path, F.col("activity_id").isin("A1", "A2", "absent"))
    after = data_files(path)
    assert before.items() <= after.items() and len(after) > len(before)

    def ids():
        found = maintained.read_maintained(spark, path).select("activity_id").collect()
        return sorted(r.activity_id for r in found if r.activity_id.startswith("A"))

    left = [f"A{n}" for n in range(8) if n not in (1, 2)]
    assert ids() == left
    apply(changes, path, 0, mode, run="replayed")
    assert ids() == left
    maintained.fold(spark, path, layers=2)
    assert ids() == left
    apply(changes, path, 0, mode, run="once more")  # marks outlive folding
    assert ids() == left
    apply(mapping.changes(feed_rows(feed, 50, event("job_activity", after={"activity_id": "A1", "job_id": "J1"})),
                          literals=mode != "match_update"), path, 1, mode)
    assert ids() == sorted([*left, "A1"])
    title = maintained.maintained_row(spark, path, {"activity_id": "A1"}).first().job_title
    assert title == ("t" if mode == "match_update" else None)
    maintained.delete_maintained(spark, path, F.col("activity_id") == "absent")
    assert ids() == sorted([*left, "A1"])


def test_matching_changes_touch_only_buckets_with_matches(spark, feed, tmp_path):
    path = str(tmp_path / "target")
    activity = [event("job_activity", after={"activity_id": f"A{n}", "job_id": f"J{n % 8}"}) for n in range(16)]
    apply(mapping.changes(feed(*activity), literals=False), path, 0, "match_update")
    before = commits.latest(spark, path)
    files = data_files(path)
    news = feed_rows(feed, 100, event("jobs", after={"job_id": "J3", "job_title": "new"}), event("jobs", after={"job_id": "J99", "job_title": "none"}))
    apply(mapping.changes(news, literals=False), path, 1, "match_update")
    after = commits.latest(spark, path)
    ids = spark.createDataFrame([("A3",), ("A11",)], "activity_id STRING")
    holding = {r.b for r in ids.select(maintained.bucket_of(["activity_id"], 4).alias("b")).collect()}
    assert {b for b in after.versions if after.versions[b] != before.versions[b]} == holding
    assert files.items() <= data_files(path).items()
    got = {r.activity_id: r.job_title for r in maintained.read_maintained(spark, path).collect()}
    assert got == {f"A{n}": "new" if n % 8 == 3 else None for n in range(16)}
    # a row that gets another key takes what is known for it, and loses what it had
    moved = feed_rows(feed, 200, event("job_activity", after={"activity_id": "A3", "job_id": "J99"}))
    apply(mapping.changes(moved, literals=False), path, 2, "match_update")
    got = {r.activity_id: r.job_title for r in maintained.read_maintained(spark, path).collect()}
    assert got["A3"] == "none" and got["A11"] == "new"


def test_what_is_refused(spark, feed, tmp_path):
    path = str(tmp_path / "target")
    changes = mapping.changes(feed(event("jobs", after={"job_id": "J1", "job_title": "t"})))
    for mode, keys in (("append", ("activity_id",)), ("match_update", ("activity_id", "job_id"))):
        with pytest.raises(ValueError):
            maintained.apply_changes(changes, path, "r", 0, mode, keys)
    apply(changes, path, 0)
    with pytest.raises(ValueError):
        apply(changes, path, 1, "partial")
    with pytest.raises(ValueError):
        maintained.maintained_row(spark, path, {"job_id": "J1"})
