"""Validation of features that arrive as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from layerlint import constants as K
from layerlint.config import LIMITS, Limits
from layerlint.operators.schema import check_features, feature_errors

Transform = Callable[[DataFrame], DataFrame]


def validate_stream(features: DataFrame, path: str, checkpoint: str, limits: Limits = LIMITS, **trigger) -> StreamingQuery:
    """Check each arriving set of features and store its errors.

    ``trigger`` is that of the stream (``processingTime="1 minute"``); unless given, it ends after what is there. A batch writes its own partition and replaces it when repeated, so a restart leaves no duplicates. Rows of a job that
    holds most of a batch are spread over several tasks.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        (
            feature_errors(batch, limits).withColumn("batch", F.lit(batch_id)).hint("rebalance")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        )

    return (
        features.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def running_counts(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Features and vertex and metadata errors per job, kept up to date as features arrive. State is one row per job."""
    return check_features(features, limits).groupBy("job_id").agg(
        F.count(F.lit(1)).alias("features"), F.count_if("skipped").alias("vertices"), F.count_if("broken").alias("metadata"),
    )


def running_error_counts(errors: DataFrame, watermark: str | None = None, time: str = "ts") -> DataFrame:
    """The seven counters per job over a stream of error rows.

    With a watermark, counters are kept per job and day and dropped once the day has passed, which ends the state of
    finished jobs.
    """
    counts = [F.count_if(F.col("type") == t).alias(counter) for t, _, counter in K.ERROR_TYPES]
    if watermark is None:
        return errors.groupBy("job_id").agg(*counts)
    return errors.withWatermark(time, watermark).groupBy("job_id", F.window(time, "1 day").alias("day")).agg(*counts)


PARTS = 16  # a job's rows go to so many parts, so that a job with most rows is not one task
# Parts of all jobs are dealt to so many states: each call of the fold and each state costs milliseconds, however few rows it has.
# A checkpoint goes with the number.
SLOTS = 512
_COUNTS = ("features", "vertices", "metadata")
_DONE = 4  # code of a verdict; other rows have a bit for each fault
_KEY = ["job", "part"]
# life and deadline are those of an open part, began and latest the times of rows, fresh tells that this batch has rows
_MERGED = {"life": "min", "deadline": "min", "began": "min", "latest": "max", **{c: "sum" for c in _COUNTS}, "done": "max", "fresh": "max"}
_OUT = "job {0}, part int, life bigint, features bigint, vertices bigint, metadata bigint, ended boolean"


def counted_jobs(features: DataFrame, ends: DataFrame, delay: str, idle_seconds: int, limits: Limits = LIMITS, parts: int = PARTS) -> DataFrame:
    """Counters per job over a stream whose state ends with the job.

    ``features`` has ``ts`` and ``ordinal`` besides the checked columns; ``ends`` has a row (job_id, ts) when a job gets its
    verdict. A job's state is dropped at that row, or once the watermark (``delay`` behind the latest time) has passed its last
    feature by ``idle_seconds``, whatever the day. Features that come later begin another ``life`` of the job, named by its
    first time; ``ended_counts`` adds lives and parts up, so nothing is lost by an early end. Rows (job_id, part, life,
    counters so far, ended) come out in update mode. Open parts are kept together in a bounded number of states, each a table
    with a row per part, and a state without rows is dropped.
    """
    job = features.schema["job_id"].dataType.simpleString()
    # numbers with a null would go to Python as floats; a part below zero says that the job is null
    sent, stand_in = ("bigint", F.lit(0)) if job in ("tinyint", "smallint", "int", "bigint") else ("string", F.lit(""))
    part = F.pmod(F.xxhash64("ordinal"), F.lit(parts)).cast("int")
    # one number per row says what it is: each column that goes to the fold costs time
    bits = [F.when(F.col(c), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(("skipped", "broken"))]
    ours = check_features(features, limits).select("job_id", part.alias("part"), F.col("ts").cast("timestamp").alias("ts"), (bits[0] + bits[1]).alias("code"))
    marks = ends.select(
        F.col("job_id").cast(job), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.col("ts").cast("timestamp").alias("ts"), F.lit(_DONE).alias("code"),
    )

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        open_parts = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else None
        if not state.hasTimedOut:
            for frame in frames:
                open_parts = _merged(_arrived(frame), open_parts)
        if open_parts is None:
            return
        open_parts = open_parts.filter(pc.is_valid(pc.coalesce(open_parts["life"], open_parts["began"])))  # others are ends without features
        life, fresh = pc.coalesce(open_parts["life"], open_parts["began"]), open_parts["fresh"].to_numpy()
        latest = np.maximum(open_parts["latest"].to_numpy(), 0)
        deadline = np.where(fresh, np.maximum(latest // 1000 + idle_seconds * 1000, watermark + 1), pc.fill_null(open_parts["deadline"], 0).to_numpy())
        ended = open_parts["done"].to_numpy() | (~fresh & (deadline < watermark))
        told = open_parts.select([*_KEY, *_COUNTS]).append_column("life", life).append_column("ended", pa.array(ended)).filter(pa.array(fresh | ended))
        nothing = np.zeros(len(life), bool)
        left = pa.table({
            **{c: open_parts[c] for c in [*_KEY, *_COUNTS]}, "life": life, "deadline": deadline, "began": pa.nulls(len(life), pa.int64()), "latest": latest,
            "done": nothing, "fresh": nothing,
        }).filter(pa.array(~ended))
        if len(left):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, left.schema) as out:
                out.write_table(left.combine_chunks())
            state.update((sink.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(pc.min(left["deadline"]).as_py())
        elif state.exists:
            state.remove()
        yield told.select(names).to_pandas()

    out = _OUT.format(sent)
    names = ["job", "part", "life", *_COUNTS, "ended"]
    events = ours.unionByName(marks).withWatermark("ts", delay)
    slots = events.select(
        F.pmod(F.xxhash64("job_id", "part"), F.lit(SLOTS)).cast("int").alias("slot"), F.coalesce(F.col("job_id").cast(sent), stand_in).alias("job"),
        F.when(F.col("job_id").isNull(), -1 - F.col("part")).otherwise(F.col("part")).alias("part"), "ts", "code",
    )
    folded = slots.groupBy("slot").applyInPandasWithState(fold, out, "parts binary", "update", GroupStateTimeout.EventTimeTimeout)
    given = F.col("part") >= 0
    return folded.select(
        F.when(given, F.col("job")).cast(job).alias("job_id"), F.when(given, F.col("part")).otherwise(-1 - F.col("part")).alias("part"),
        F.timestamp_micros("life").alias("life"), *_COUNTS, "ended",
    )


def _arrived(frame: pd.DataFrame) -> pa.Table:
    """Rows of a batch as parts of one row each."""
    code = frame["code"].to_numpy()
    done = code == _DONE
    times = pa.array(frame["ts"].to_numpy().astype("datetime64[us]").astype("int64"), mask=done)
    none = pa.nulls(len(code), pa.int64())
    return pa.table({
        "job": pa.array(frame["job"]), "part": pa.array(frame["part"]), "features": (~done).astype("int64"), "vertices": (code & 1).astype("int64"),
        "metadata": (code >> 1 & 1).astype("int64"), "life": none, "deadline": none, "began": times, "latest": times, "done": done, "fresh": np.ones(len(code), bool),
    })


def _merged(arrived: pa.Table, others: pa.Table | None) -> pa.Table:
    """One row per part."""
    both = arrived if others is None else pa.concat_tables([arrived, others.select(arrived.column_names)])
    found = both.group_by(_KEY, use_threads=False).aggregate(list(_MERGED.items()))
    return found.select([*_KEY, *[f"{c}_{how}" for c, how in _MERGED.items()]]).rename_columns([*_KEY, *_MERGED])


def counted_jobs_stream(counted: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Store what ``counted_jobs`` gives out; a batch that is repeated after a restart replaces itself."""
    return _stored(counted, path, checkpoint, trigger)


def ended_counts(stored: DataFrame) -> DataFrame:
    """Counters per job from the stored rows: the latest of each part and life, added up. ``ended`` if no life of the job is open."""
    lives = stored.groupBy("job_id", "part", "life").agg(*[F.max(c).alias(c) for c in _COUNTS], F.max("ended").alias("ended"))
    return lives.groupBy("job_id").agg(*[F.sum(c).alias(c) for c in _COUNTS], F.min("ended").alias("ended"))


@contextmanager
def states_by_cores(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in two partitions per core, or fewer if the session has fewer.

    Every batch reads, commits and writes files for each state partition, however few of the jobs it touches. A started stream has
    its own copy of the settings, and a restarted one keeps the number of its checkpoint.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _stored(rows: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    def store(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        )

    with states_by_cores(rows.sparkSession):
        return rows.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def running_counts_stream(features: DataFrame, path: str, checkpoint: str, limits: Limits = LIMITS, **trigger) -> StreamingQuery:
    """Store the counters of the jobs each batch touches; ``latest_counts`` reads the current ones."""

    return _stored(running_counts(features, limits), path, checkpoint, trigger)


def latest_counts(stored: DataFrame) -> DataFrame:
    """Counters only grow, so the largest of each are the latest."""
    return stored.groupBy("job_id").agg(*[F.max(c).alias(c) for c in ("features", "vertices", "metadata")])
