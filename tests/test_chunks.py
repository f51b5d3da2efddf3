"""Greedy chunk assignment against a loop, for block sizes that force several rounds of chaining."""

import json
import random

import pytest
from pyspark.errors import PySparkException

from layerlint.config import Limits
from layerlint.operators import chunks
from layerlint.operators.mapping import PART_COLUMNS


def packed(features, limit):
    fill, chunk, out = {}, {}, set()
    for job, ordinal, vertices in sorted(features):
        counted = 0 if vertices > limit else vertices
        if fill.get(job, 0) + counted > limit:
            chunk[job], fill[job] = chunk.get(job, 0) + 1, 0
        fill[job] = fill.get(job, 0) + counted
        out.add((job, ordinal, chunk.get(job, 0)))
    return out


@pytest.mark.parametrize("block, fan_in, limit, top", [(10**6, 256, 50, 20), (7, 256, 50, 60), (5, 2, 50, 12), (3, 3, 40, 45), (8, 2, 1, 2)])
def test_assign_chunks(spark, monkeypatch, block, fan_in, limit, top):
    monkeypatch.setattr(chunks, "FAN_IN", fan_in)
    rnd = random.Random(block)
    sizes = {0: 150, 1: 40, 2: 1}
    features = [(job, ordinal, rnd.randrange(0, top + 1)) for job, n in sizes.items() for ordinal in range(n)]
    frame = spark.createDataFrame(features, "job_id long, ordinal long, vertices int").repartition(5)
    got = chunks.assign_chunks(frame, Limits(max_vertices=limit), block_size=block)
    assert {tuple(r) for r in got.collect()} == packed(features, limit)


def test_over_limit_feature_joins_the_open_chunk(spark):
    frame = spark.createDataFrame([(1, 0, 9), (1, 1, 5), (1, 2, 4), (1, 3, 99), (1, 4, 4)], "job_id long, ordinal long, vertices int")
    got = chunks.assign_chunks(frame, Limits(max_vertices=9)).orderBy("ordinal").collect()
    assert [r.chunk_id for r in got] == [0, 1, 1, 1, 2]


def test_resume(spark):
    frame = spark.createDataFrame([(j, o, 1) for j in (1, 2, 3) for o in range(137)], "job_id long, ordinal long, vertices int")
    state = spark.createDataFrame([(1, 135), (2, None)], "job_id long, last_processed_feature long")
    left = {r.job_id: r["count"] for r in chunks.resume_features(frame, state).groupBy("job_id").count().collect()}
    assert left == {1: 1, 2: 137, 3: 137}


def test_features_without_job_or_position_fail(spark):
    for row in ((None, 0, 1), (1, None, 1)):
        frame = spark.createDataFrame([(1, 0, 1), row], "job_id long, ordinal long, vertices int")
        with pytest.raises(PySparkException, match="no job or no position"):
            chunks.assign_chunks(frame).collect()
    assert chunks.assign_chunks(spark.createDataFrame([], "job_id string, ordinal long, vertices int")).count() == 0


def test_pages_of_a_chunk_without_vertices(spark):
    rows = spark.range(1, 30_011).selectExpr(
        "'j' as job_id", "0 as chunk_id", "id as ordinal", "cast(id as string) as id", *[f"cast(null as string) as {c}" for c in PART_COLUMNS if c != "id"])
    jobs = spark.createDataFrame([("j", "Ingestion_New", "c", "r", "O", "1.0")], "job_id string, job_type string, catalog_id string, resource_id string, product_type string, version string")
    pages = chunks.chunk_payload(rows.repartition(7), jobs).orderBy("page").collect()
    assert [(p.page, p.parts) for p in pages] == [(0, 10_000), (1, 10_000), (2, 10_000), (3, 10)]
    ids = [int(x["properties"]["id"]) for p in pages for x in json.loads(p.payload)["partsData"]]
    assert ids == list(range(1, 30_011)) and {json.loads(p.payload)["catalogId"] for p in pages} == {"c"}
