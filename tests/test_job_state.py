"""Counters of a stream whose state ends with the job: verdicts, idleness across midnight, and a restart in between."""

import datetime

import pytest
from pyspark.sql import functions as F

from layerlint.operators.schema import check_features
from layerlint.streaming import validation
from layerlint.streaming.validation import counted_jobs, counted_jobs_stream, ended_counts

FEATURE = "job_id string, chunk_id int, ordinal long, id string, vertices int, update_date string, sensors string, source_res string, ep90 string, " \
          "cities string, countries string, publish_res string, classify string, source_name string, ts timestamp"
EVENING = datetime.datetime(2024, 5, 1, 23, 50)


def rows(job, n, minutes, first=0):
    return [(job, 0, first + i, "1", 9000 if i % 5 == 0 else 5, "2024-01-01" if i % 3 else "bad", "s", "1", "5", "c", "d", "2", "cl", "sn",
             EVENING + datetime.timedelta(minutes=minutes + i / 100)) for i in range(n)]


@pytest.fixture
def feed(spark, tmp_path):
    """Folders of a feature and a verdict stream, and one run over what is new in them."""
    features, ends, out, state = (str(tmp_path / x) for x in ("features", "ends", "out", "state"))
    spark.createDataFrame([], FEATURE).write.parquet(features)
    spark.createDataFrame([], "job_id string, ts timestamp").write.parquet(ends)

    def run(new=(), verdicts=()):
        spark.createDataFrame(list(new), FEATURE).coalesce(1).write.mode("append").parquet(features)
        done = [(job, EVENING + datetime.timedelta(minutes=m)) for job, m in verdicts]
        spark.createDataFrame(done, "job_id string, ts timestamp").coalesce(1).write.mode("append").parquet(ends)
        counted = counted_jobs(
            spark.readStream.schema(FEATURE).parquet(features), spark.readStream.schema("job_id string, ts timestamp").parquet(ends), "5 minutes", 900, parts=2)
        query = counted_jobs_stream(counted, out, state)
        query.awaitTermination()
        left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return {r["job_id"]: tuple(r)[1:] for r in ended_counts(spark.read.parquet(out)).collect()}, left

    def batch():
        found = check_features(spark.read.parquet(features)).groupBy("job_id").agg(
            F.count(F.lit(1)), F.sum(F.col("skipped").cast("long")), F.sum(F.col("broken").cast("long")))
        return {r[0]: tuple(r)[1:] for r in found.collect()}

    return run, batch


def test_state_ends_with_the_job(feed):
    run, batch = feed
    got, left = run(rows("a", 30, 0) + rows("007", 12, 0))
    assert {k: v[:3] for k, v in got.items()} == batch() and left == 4 and not got["a"][3]
    # a new query goes on from the checkpoint; one job gets its verdict, the other one a few more features
    got, left = run(rows("007", 8, 12, 12), [("a", 12)])
    assert {k: v[:3] for k, v in got.items()} == batch() and left == 2 and got["a"][3] and not got["007"][3]
    # half an hour later, past midnight: the idle job ends though nothing says so, and the new one is counted
    got, left = run(rows("b", 3, 60), [("b", 61)])
    assert {k: v[:3] for k, v in got.items()} == batch() and all(v[3] for v in got.values()) and left == 0
    # features after the end are another life of the job
    got, left = run(rows("a", 5, 62, 30), [("a", 63), ("unknown", 63)])
    assert {k: v[:3] for k, v in got.items()} == batch() and got["a"][0] == 35 and got["a"][3] and left == 0


def test_open_jobs_share_states(spark, tmp_path, monkeypatch):
    """States do not grow with the jobs, and jobs of one state end and go on each by itself."""
    monkeypatch.setattr(validation, "SLOTS", 4, raising=False)
    features, ends, out, state = (str(tmp_path / x) for x in ("features", "ends", "out", "state"))
    schema, big = FEATURE.replace("job_id string", "job_id long"), 2 ** 60
    jobs = [None, big + 1, big + 2, *range(9)]
    # one file per batch: when the last one comes, all but the job of the second have long been idle, and one of these goes on
    for new in ([r for job in jobs for r in rows(job, 7, 0)], rows(8, 3, 60, 7), rows(8, 3, 61, 10) + rows(0, 2, 61, 7)):
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(features)
    spark.createDataFrame([(1, EVENING)], "job_id long, ts timestamp").write.parquet(ends)
    counted = counted_jobs(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(features), spark.readStream.schema("job_id long, ts timestamp").parquet(ends),
        "5 minutes", 900, parts=2)
    query = counted_jobs_stream(counted, out, state)
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 4
    stored = spark.read.parquet(out)
    batch = check_features(spark.read.parquet(features)).groupBy("job_id").agg(F.count(F.lit(1)), F.count_if("skipped"), F.count_if("broken"))
    assert {tuple(r)[:4]: r["ended"] for r in ended_counts(stored).collect()} == {tuple(r): r["job_id"] not in (0, 8) for r in batch.collect()}
    # every part has one life, told to be over once: at the verdict, or when the last batch shows that it is idle
    ended = stored.filter("ended").groupBy("job_id").agg(F.min("batch"), F.max("batch"), F.count_distinct("part")).collect()
    parts = {r["job_id"]: r["n"] for r in stored.groupBy("job_id").agg(F.count_distinct("part", "life").alias("n")).collect()}
    last = stored.agg(F.max("batch")).first()[0]
    assert {tuple(r) for r in ended} >= {(job, last if job != 1 else 0, last if job != 1 else 0, parts[job]) for job in jobs if job not in (0, 8)}
