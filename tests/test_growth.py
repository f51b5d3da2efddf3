"""Work that must not grow faster than the input."""

import contextlib
import io
from pathlib import Path

from pyspark.sql import functions as F

from layerlint.operators.mapping import map_part_properties
from layerlint.operators.schema import PARSED, valid_features
from layerlint.operators.skew import split_join
from layerlint.streaming.validation import latest_counts, running_counts_stream


def test_states_follow_the_cores(spark, tmp_path):
    partitions = 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(60).select((F.col("id") % 5).alias("job_id"), F.col("id").alias("ordinal"), F.lit(1).alias("vertices"), F.lit("x").alias("id"))
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        running_counts_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(partitions)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len([p for p in Path(f"{tmp_path}/checkpoint/state/0").iterdir() if p.name.isdigit()]) == partitions // 2
    assert sorted((r["job_id"], r["features"]) for r in latest_counts(spark.read.parquet(f"{tmp_path}/out")).collect()) == [(j, 12) for j in range(5)]


def test_hot_keys_are_looked_for_in_hot_values_only(spark):
    left = spark.createDataFrame([(j, i % 3, i) for j, n in ((0, 30), (1, 4), (None, 30)) for i in range(n)], "j int, k int, i int")
    right = spark.createDataFrame([(0, 0, "a"), (0, 2, "b"), (1, 1, "c"), (None, 0, "d")], "j int, k int, v string")
    got = split_join(left, right, ["j", "k"], "inner", 6)
    with contextlib.redirect_stdout(out := io.StringIO()):
        got.explain()
    assert "LeftSemi" in out.getvalue()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, ["j", "k"]).collect()))


def test_readings_are_kept(spark):
    rows = spark.createDataFrame([(1, 0, 0, "f", 5, "s", "2020-01-02", "a,b", "3", "2", "4", "C", "c1", None)], """job_id bigint, ordinal bigint, chunk_id int, id string,
        vertices int, source_name string, update_date string, sensors string, ep90 string, source_res string, publish_res string, classify string, cities string, countries string""")
    jobs = spark.createDataFrame([(1, 0.703125)], "job_id bigint, ingestion_resolution double")
    valid = valid_features(rows, readings=True)
    assert set(PARSED.values()) <= set(valid.columns) and valid_features(rows).columns == rows.columns
    assert map_part_properties(valid, jobs).collect() == map_part_properties(valid_features(rows), jobs).collect() != []
