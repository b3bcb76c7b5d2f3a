from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lexigram.functions.messages import encode
from lexigram.plans import stand_ins as given
from lexigram.streaming import completion, once
from lexigram.streaming import tasks as stream

START = datetime(2024, 5, 1)


@pytest.fixture
def queue(spark, tmp_path):
    """Appends one file of ``(second, client, content)`` messages to the queue folder."""

    def post(*messages):
        rows = [(START + timedelta(seconds=s), c, content) for s, c, content in messages]
        table = spark.createDataFrame(rows, "ts timestamp, client string, content string")
        table.select("ts", encode(F.col("client"), F.col("content")).alias("value")).coalesce(1).write.mode(
            "append"
        ).parquet(str(tmp_path / "queue"))
        return str(tmp_path / "queue")

    return post


def done(task):
    return f"ToText\t{task}\tDoneLocalId{task}"


def test_results_and_repeats_across_batches(spark, queue, tmp_path):
    queue((0, "a", done("t1")), (1, "a", "ToText\tt2\tError: x"), (2, "b", done("t1")), (3, "a", "UPLOAD DONE-2"))
    path = queue((30, "a", done("t1")), (31, "b", done("t2")), (31, "b", done("t2")))
    results = stream.task_results(stream.read_messages(spark, path, files_per_batch=1))
    every = stream.run_append(results, str(tmp_path / "all"), str(tmp_path / "all-state"))
    assert every.count() == 6
    assert {(r.task, r.status) for r in every.where("client = 'a'").collect()} == {("t1", "done"), ("t2", "error")}

    out, state = str(tmp_path / "once"), str(tmp_path / "once-state")
    once = stream.without_repeats(results)
    tasks = lambda rows: sorted((r.client, r.task) for r in rows.collect())
    assert tasks(stream.run_append(once, out, state)) == [("a", "t1"), ("a", "t2"), ("b", "t1"), ("b", "t2")]

    # The same query resumes: the earlier deliveries are still known, only the new task is added.
    queue((60, "a", done("t1")), (61, "b", done("t3")))
    resumed = stream.without_repeats(stream.task_results(stream.read_messages(spark, path, 1)))
    assert tasks(stream.run_append(resumed, out, state))[-1] == ("b", "t3")
    assert stream.run_append(resumed, out, state).count() == 5


def test_progress_and_unresolved_clients(spark, queue, tmp_path):
    queue((0, "a", done("t1")), (1, "b", done("t1")), (1, "c", done("t1")), (2, "a", "UPLOAD DONE-2"))
    path = queue((30, "a", done("t1")), (31, "a", done("t2")), (32, "b", "UPLOAD DONE-3"), (33, "b", "UPLOAD DONE-3"))
    progress = stream.progress(stream.read_messages(spark, path, files_per_batch=1))
    latest = stream.run_latest(progress, "client", str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r.client: (r.done, r.total, r.complete) for r in stream.completed(latest).collect()}
    assert got == {"a": (2, 2, True), "b": (1, 3, False), "c": (1, None, False)}
    left = {r.client: (r.done, r.missing) for r in stream.unresolved(latest).collect()}
    assert left == {"b": (1, 2), "c": (1, None)}


def test_results_do_not_depend_on_batches(spark, sf_dir, tmp_path):
    """The whole queue, a month of events in no order over 8 files, as one micro-batch and file by file."""
    queue = str(tmp_path / "queue")
    given.task_messages(spark, sf_dir).repartition(8).write.parquet(queue)
    seen = []
    for files in (None, 1):
        at = lambda name, files=files: str(tmp_path / f"{name}-{files}")
        read = lambda files=files: stream.read_messages(spark, queue, files)
        once = stream.run_append(stream.without_repeats(stream.task_results(read())), at("once"), at("once-state"))
        progress = stream.progress(read())
        latest = stream.run_latest(progress, "client", at("latest"), at("latest-state"), keep=3)
        rejected = stream.run_append(stream.rejected_messages(read()), at("bad"), at("bad-state"))
        tables = (once.drop("ts"), stream.completed(latest), stream.unresolved(latest), rejected.drop("ts"))
        seen.append([sorted(map(str, t.collect())) for t in tables])
    assert seen[0] == seen[1] and all(seen[0])
    kept = sorted(p.name for p in (tmp_path / "latest-1").iterdir())
    assert sum(n.startswith("snapshot-") for n in kept) == 2 and sum(n.startswith("batch-") for n in kept) <= 6


def test_records_without_a_task_disturb_nothing(spark, queue, tmp_path):
    path = queue((0, "a", "ToText"), (1, "a", done("t1")), (2, "a", "UPLOAD DONE-1"), (3, "a", "ToText\tt2\t"), (4, None, "x"))
    path = queue((5, "b", "ToText\tt1\t"), (6, "b", done("t1")))
    progress = stream.progress(stream.read_messages(spark, path, files_per_batch=1))
    latest = stream.run_latest(progress, "client", str(tmp_path / "out"), str(tmp_path / "state"))
    assert {r.client: (r.done, r.total, r.complete) for r in stream.completed(latest).collect()} == {
        "a": (1, 1, True),
        "b": (1, None, False),
    }
    results = stream.without_repeats(stream.task_results(stream.read_messages(spark, path, files_per_batch=1)))
    rows = stream.run_append(results, str(tmp_path / "rows"), str(tmp_path / "rows-state")).collect()
    assert sorted((r.client, r.task, r.status) for r in rows) == [
        ("a", "t1", "done"),
        ("a", "t2", "open"),
        ("b", "t1", "done"),
        ("b", "t1", "open"),
    ]
    bad = stream.rejected_messages(spark.read.schema(stream.MESSAGE_SCHEMA).parquet(path)).collect()
    assert sorted(r.reason for r in bad) == ["fewer than 3 fields", "not a message"]


def test_each_key_once_without_state(spark, queue, tmp_path, monkeypatch):
    monkeypatch.setattr(once, "WORDS", 1)  # 64 bits per bucket: filters let much through, results stay exact
    keys = ["client", "task"]
    run = lambda out, path: once.run_once(
        stream.task_results(stream.read_messages(spark, path, 1)), keys, str(tmp_path / out), str(tmp_path / f"{out}-state"), 2
    )
    sent = []
    for batch in range(5):
        rows = [(batch, c, done(f"t{k}")) for c in "ab" for k in range(batch * 20, batch * 20 + 30)] * 2
        sent += rows
        path = queue(*rows)
    first = run("out", path)
    pairs = sorted((r.client, r.task) for r in first.collect())
    assert pairs == sorted({(c, x.split("\t")[1]) for _, c, x in sent})
    assert first.columns == ["ts", "client", "op", "task", "result", "status"]
    assert len(list((tmp_path / "out" / "filters").glob("snapshot-*"))) == 2
    again = run("out", queue((9, "a", done("t0")), (9, "a", done("new"))))
    assert sorted((r.client, r.task) for r in again.collect()) == sorted([*pairs, ("a", "new")])


def test_only_buckets_that_may_hold_a_row_are_read(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(500).selectExpr("id as k").withColumn("bucket", once._bucket(["k"]))
    rows.write.partitionBy("bucket").parquet(f"{out}/rows/batch=0")
    once._filter_of(rows.select("bucket", F.inline(once._bits(["k"])))).write.parquet(f"{out}/filters/batch-0")
    new = spark.range(1000, 1200).selectExpr("id as k")
    assert once.unseen(new, ["k"], out, 1) is new  # nothing to read
    mixed = once.unseen(spark.range(499, 600).selectExpr("id as k"), ["k"], out, 1)
    assert sorted(r.k for r in mixed.collect()) == list(range(500, 600))
    assert "bucket" in mixed._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]


def test_outcomes_by_timer(spark, queue, tmp_path):
    path = queue((0, "a", "UPLOAD DONE-2"), (1, "a", done("t1")), (2, "b", done("t1")), (3, "c", "UPLOAD DONE-3"), (4, "c", done("t1")))
    queue((5, "a", done("t1")), (6, "a", done("t2")))
    queue((200, "d", done("t1")))  # the watermark passes b and c
    queue((210, "c", done("t2")), (211, "c", done("t3")))
    run = lambda: stream.run_append(
        completion.outcomes(stream.read_messages(spark, path, 1), 60, "10 seconds"), str(tmp_path / "out"), str(tmp_path / "state")
    )
    rows = sorted(tuple(r) for r in run().collect())
    assert ("a", "complete", 2, 0) in rows and ("b", "unresolved", 1, None) in rows
    assert ("c", "complete", 3, 0) in rows and not any(r[0] == "d" for r in rows)
    assert [r for r in rows if r[0] == "a"] == [("a", "complete", 2, 0)]
    queue((400, "e", done("t1")))
    assert ("d", "unresolved", 1, None) in {tuple(r) for r in run().collect()}


def test_a_repeat_is_a_sign_of_life(spark, queue, tmp_path):
    """Whichever delivery of a task is kept, the last one starts the hour; a client idle for just that long is flushed."""
    sent = [(2 + late, c, done("t1")) for c, lates in (("a", (0, 30)), ("b", (30, 0)), ("c", (29, 0))) for late in lates]
    path = queue((1, "a", "UPLOAD DONE-2"), *sent, (5, "o", done("t1")), (32, "o", "ToText\tt2\t"), (101, "z", done("t1")))
    rows = completion.outcomes(stream.read_messages(spark, path), 60, "10 seconds")
    got = stream.run_append(rows, str(tmp_path / "out"), str(tmp_path / "state")).collect()
    assert sorted(tuple(r) for r in got) == [("c", "unresolved", 1, None)]
    queue((102, "z", done("t2")))
    got = stream.run_append(rows, str(tmp_path / "out"), str(tmp_path / "state")).collect()
    assert sorted(r.client for r in got) == ["a", "b", "c", "o"]
