"""Routing, attempts, failures, callbacks, parameters and telemetry."""

import json

from pyspark.sql import functions as F

from layerlint.functions.text import build_url
from layerlint.operators import metrics, tasks


def test_routing(spark):
    jobs = spark.createDataFrame([("Ingestion_New",), ("Export",), ("Bogus",)], "job_type string")
    got = [(r.handler, r.route_error) for r in tasks.route_jobs(jobs).collect()]
    assert got == [("ingestion", None), ("export", None), (None, "Bogus job type is invalid")]
    assert [r.handler for r in tasks.route_jobs(jobs, "export").collect()] == [None, "export", None]


def test_attempts(spark):
    rows = spark.createDataFrame([(1, "validation", 2), (2, "validation", 3), (3, "other", 0)], "task_id int, task_type string, attempts int")
    assert [(r.gate_error, r.gate_message) for r in tasks.attempts_gate(rows).collect()] == [
        (None, None), ("ReachedMaxTaskAttemptsError", "task 2 reached max attempts, rejects as unrecoverable"),
        ("UnrecoverableTaskError", "task type other is not configured")]


def test_triage(spark):
    rows = spark.createDataFrame([
        ("Error", "failed to process job", ""), ("ReachedMaxTaskAttemptsError", "m", "Task failed"), ("ReachedMaxTaskAttemptsError", "m", ""),
        ("ShapefileNotFoundError", "x", "old"), (None, None, "old"),
    ], "error_type string, message string, previous_reason string")
    assert [(r.recoverable, r.reason) for r in tasks.triage_failures(rows).collect()] == [
        (True, "failed to process job"), (False, "Task failed"), (False, "m"), (False, "x"), (True, "unknown error occurred")]


def test_callbacks(spark):
    schema = ("job_id int, task_id int, job_type string, resource_id string, product_type string, version string, task_type string, status string, "
              "recoverable boolean, is_valid boolean, report struct<fileName:string,url:string,fileSize:bigint>, callback_urls array<string>, error_type string")
    job, task = (1, 2), ("r", "Orthophoto", "1.0")
    base = (*job, "Ingestion_New", *task, "validation")
    rows = spark.createDataFrame([
        (*base, "Completed", None, None, ("f", "u", 3), ["a", "b"], None), (*base, "Failed", True, None, None, ["c"], "Error"),
        (*base, "Failed", False, None, None, ["d"], "Error"), (*base, "Completed", None, True, None, None, None),
        # no handler yet, or one that does not call back
        (*base, "Failed", False, None, None, ["e"], "ReachedMaxTaskAttemptsError"),
        (*job, "Ingestion_New", *task, "other", "Failed", False, None, None, ["f"], "UnrecoverableTaskError"),
        (*job, "Export", *task, "validation", "Completed", None, None, None, ["g"], None),
        (*job, "Bogus", *task, "validation", "Failed", False, None, None, ["h"], "Error"),
    ], schema)
    got = {r.url: json.loads(r.payload) for r in tasks.callback_rows(rows).collect()}
    assert set(got) == {"a", "b", "d"}
    assert got["a"]["message"] == "validation task completed with errors"
    assert got["a"]["data"] == {"isValid": False, "links": [{"fileName": "f", "url": "u", "fileSize": 3}]}
    assert got["d"]["error"] == "validation task failed" and "data" not in got["d"] and "message" not in got["d"]


def test_merge_state(spark):
    state = "struct<chunk:int,path:string>"
    rows = spark.createDataFrame([((1, "a"), (2, None)), (None, (3, "b")), ((4, "c"), None)], f"saved {state}, new {state}")
    got = rows.select(tasks.merge_state(F.col("saved"), F.col("new"), ["chunk", "path"]).alias("s")).collect()
    assert [tuple(r.s) for r in got] == [(2, "a"), (3, "b"), (4, "c")]


def test_task_states_fold_updates_by_version(spark):
    state = "struct<chunk:int,progress:struct<percentage:double>>"
    updates = [(1, 1, 5, (None, (49.5,))), (1, 1, 3, (3, (20.0,))), (1, 1, 4, (4, None)), (1, 1, None, (9, (99.0,))), (1, 2, 1, None), (1, 3, 1, (1, None)), (None, 4, 1, (2, (0.4,)))]
    saved = [(1, 1, (1, (1.0,))), (1, 2, (6, (50.5,))), (2, 9, None)]
    rows = spark.createDataFrame(updates, f"job_id int, task_id int, version int, state {state}").repartition(4)
    kept = spark.createDataFrame(saved, f"job_id int, task_id int, state {state}")
    got = {(r.job_id, r.task_id): (r.state and r.state.chunk, r.percentage) for r in tasks.task_states(kept, rows, ["chunk", "progress"]).collect()}
    assert got == {(1, 1): (4, 50), (1, 2): (6, 51), (1, 3): (1, None), (2, 9): (None, None), (None, 4): (2, 0)}
    assert tasks.task_states(kept.limit(0), rows.limit(0), ["chunk", "progress"]).count() == 0


def test_url(spark):
    rows = spark.createDataFrame([("http://h:1", "a/b"), ("http://h/x/", "//a")], "b string, r string")
    assert [r.u for r in rows.select(build_url(F.col("b"), F.col("r")).alias("u")).collect()] == ["http://h:1/a/b", "http://h/x/a"]


def quantile(spark, counts, bounds, q):
    return spark.createDataFrame([(counts,)], "c array<bigint>").select(metrics.quantile_of_counts(F.col("c"), bounds, q).alias("q")).first().q


def test_quantile(spark):
    assert quantile(spark, [0, 10, 10, 10], [1, 2, 4], 0.5) == 1.5
    assert quantile(spark, [4, 4, 8, 8], [1, 2, 4], 0.25) == 0.5
    assert quantile(spark, [0, 0, 5, 10], [1, 2, 4], 0.99) == 4.0


def test_chunk_sizes(spark):
    sizes = [0, 100, 101, 500, 1000, 2000, 5000, 10000, 10001]
    rows = spark.createDataFrame([(n,) for n in sizes], "n int").select(metrics.chunk_size_range(F.col("n")).alias("r")).collect()
    assert [r.r for r in rows] == ["0-100", "0-100", "101-500", "101-500", "501-1000", "1001-2000", "2001-5000", "5001-10000", "10001+"]


def test_active_tasks_meet_at_one_moment(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", 10.0), ("2024-01-01 00:00:10", 5.0)], "t string, duration_s double")
    events = rows.select(F.col("t").cast("timestamp").alias("ts"), "duration_s", F.lit("j").alias("job_type"), F.lit("t").alias("task_type"))
    for block in (1_000_000, 10**12):
        got = metrics.active_tasks(events, block_micros=block).orderBy("at_micros").collect()
        assert [r.active for r in got] == [1, 1, 0]


def test_running_tasks_stay_active_and_urls_keep_their_query(spark):
    events = spark.createDataFrame([("2024-01-01 00:00:00", None, "a", "b"), ("2024-01-01 00:00:00", 1.0, "a", "b")], "ts string, duration_s double, job_type string, task_type string")
    assert [r.active for r in metrics.active_tasks(events).orderBy("at_micros").collect()] == [2, 1]
    assert spark.range(1).select(build_url(F.lit("http://h/a?x=1"), F.lit("b"))).first()[0] == "http://h/a/b?x=1"
