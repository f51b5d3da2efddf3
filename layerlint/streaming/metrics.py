"""Task metrics over live events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from layerlint.operators.metrics import TASK_LABELS, pod_rates, status_rates, windowed


def with_event_time(events: DataFrame, delay: str) -> DataFrame:
    """Events with a watermark on ``ts``; files give a time without zone, which counts as UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def live_status_rates(events: DataFrame, delay: str = "10 minutes", length: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Shares, throughput and mean duration per window of a stream."""
    return status_rates(with_event_time(events, delay), length, slide)


def live_pod_rates(events: DataFrame, delay: str = "10 minutes", length: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    return pod_rates(with_event_time(events, delay), length, slide)


def live_task_counters(events: DataFrame, delay: str = "10 minutes", length: str = "5 minutes") -> DataFrame:
    """Processed, succeeded and failed tasks by job type, task type and pod per window of a stream.

    State is one row per window and labels that is still open; it ends when the watermark passes the window.
    """
    counted = with_event_time(events, delay).groupBy(windowed(length).alias("w"), *TASK_LABELS, "pod").agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(F.col("status") == "Completed").alias("success"), F.count_if(F.col("status") == "Failed").alias("failure"),
    )
    return counted.select(F.col("w.start").alias("window_start"), *TASK_LABELS, "pod", "processed", "success", "failure")


def store_closed_windows(windows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append each window once, when the watermark has passed its end. Without a trigger the stream ends after what is there."""
    return (
        windows.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )
