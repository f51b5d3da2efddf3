"""Task and chunk telemetry over raw events.

Rates are counts over a window divided by its length. Histograms keep one counter per bound in a single combinable
aggregation, so events are never multiplied by the number of bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from layerlint import constants as K
from layerlint.operators.prefix import running

TASK_LABELS = ["job_type", "task_type"]
MICROS_PER_MINUTE = 60_000_000


def _bound_text(bound: float) -> str:
    return str(int(bound)) if float(bound).is_integer() else repr(float(bound))


def label_filter(events: DataFrame, **patterns: str) -> DataFrame:
    """Keep events whose labels match the given patterns as a whole."""
    for label, pattern in patterns.items():
        events = events.filter(F.col(label).cast("string").rlike(f"^(?:{pattern})$"))
    return events


def label_values(events: DataFrame, label: str) -> DataFrame:
    return events.select(label).distinct()


def _completed() -> Column:
    return F.col("status") == "Completed"


def _failed() -> Column:
    return F.col("status") == "Failed"


def error_type() -> Column:
    return F.coalesce("error_type", F.lit("UnknownError"))


def task_counters(events: DataFrame) -> DataFrame:
    """Processed and succeeded tasks by job and task type."""
    return events.groupBy(*TASK_LABELS).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(_completed()).alias("success"), F.count_if(_failed()).alias("failure"),
    )


def failure_counters(events: DataFrame) -> DataFrame:
    """Failed tasks by job type, task type and error type."""
    return events.filter(_failed()).groupBy(*TASK_LABELS, error_type().alias("error_type")).agg(F.count(F.lit(1)).alias("failure"))


def bucket_counts(value: Column, bounds: Sequence[float]) -> Column:
    """Aggregate: cumulative counts of values at or below each bound, the last one being the total."""
    return F.array(*[F.count_if(value <= float(b)) for b in bounds], F.count(value))


def histogram(rows: DataFrame, labels: Sequence[str | Column], value: Column, bounds: Sequence[float]) -> DataFrame:
    """Rows (labels, le, count) with cumulative counts; ``sum`` and ``total`` repeat on each row."""
    names = F.array(*[F.lit(_bound_text(b)) for b in bounds], F.lit("+Inf"))
    grouped = rows.groupBy(*labels).agg(
        bucket_counts(value, bounds).alias("counts"), F.sum(value).alias("sum"), F.count(value).alias("total"),
    )
    keys = [c for c in grouped.columns if c not in ("counts", "sum", "total")]
    return grouped.select(*keys, "sum", "total", F.inline(F.arrays_zip(names.alias("le"), F.col("counts").alias("count"))))


def duration_histogram(events: DataFrame) -> DataFrame:
    """Task durations by job type, task type and status."""
    return histogram(events, [*TASK_LABELS, "status"], F.col("duration_s"), K.TASK_SECONDS)


def operation_durations(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Read, process and total times in seconds, one row per operation."""
    return rows.select(
        *keep, F.expr("stack(3, 'read', read_ms / 1000D, 'process', process_ms / 1000D, 'total', total_ms / 1000D) AS (operation, seconds)")
    )


def chunk_metrics(chunks: DataFrame) -> DataFrame:
    """Durations of chunks by operation."""
    return histogram(operation_durations(chunks), ["operation"], F.col("seconds"), K.CHUNK_SECONDS)


def features_per_chunk(chunks: DataFrame) -> DataFrame:
    return histogram(chunks, [], F.col("features"), K.CHUNK_FEATURES)


def chunk_size_range(features: Column) -> Column:
    """Label of the size range a chunk falls in."""
    label = F.lit(K.CHUNK_SIZE_RANGES[-1][1])
    for top, name in reversed(K.CHUNK_SIZE_RANGES[:-1]):
        label = F.when(features <= top, F.lit(name)).otherwise(label)
    return label


def duration_by_chunk_size(chunks: DataFrame) -> DataFrame:
    sized = chunks.select(chunk_size_range(F.col("features")).alias("chunk_size_range"), (F.col("total_ms") / 1000.0).alias("seconds"))
    return histogram(sized, ["chunk_size_range"], F.col("seconds"), K.CHUNK_SECONDS)


def file_metrics(files: DataFrame) -> DataFrame:
    """Durations of whole files by operation."""
    return histogram(operation_durations(files), ["operation"], F.col("seconds"), K.FILE_SECONDS)


def features_per_file(files: DataFrame) -> DataFrame:
    return histogram(files, [], F.col("features"), K.FILE_FEATURES)


def windowed(length: str, slide: str | None = None) -> Column:
    return F.window("ts", length, slide) if slide else F.window("ts", length)


def _seconds(length: str) -> float:
    amount, unit = length.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def status_rates(events: DataFrame, length: str = "5 minutes", slide: str | None = None, labels: Sequence[str] = ()) -> DataFrame:
    """Success and failure shares in percent, throughput and mean duration per window."""
    total = F.count(F.lit(1))
    return (
        events.groupBy(windowed(length, slide).alias("w"), *labels).agg(
            total.alias("processed"),
            (F.count_if(_completed()) * 100.0 / total).alias("success_rate"),
            (F.count_if(_failed()) * 100.0 / total).alias("failure_rate"),
            (total / F.lit(_seconds(length))).alias("throughput"),
            F.avg("duration_s").alias("avg_duration"),
        )
        .select(F.col("w.start").alias("window_start"), *labels, "processed", "success_rate", "failure_rate", "throughput", "avg_duration")
    )


def success_rate(events: DataFrame, length: str = "5 minutes") -> DataFrame:
    return status_rates(events, length).select("window_start", "success_rate", "failure_rate")


def throughput(events: DataFrame, length: str = "5 minutes", labels: Sequence[str] = ()) -> DataFrame:
    return status_rates(events, length, labels=labels).select("window_start", *labels, "throughput")


def avg_duration(events: DataFrame, length: str = "5 minutes") -> DataFrame:
    return status_rates(events, length).select("window_start", "avg_duration")


def quantile_of_counts(counts: Column, bounds: Sequence[float], q: float) -> Column:
    """Quantile from cumulative bucket counts, linear inside a bucket.

    The first bucket starts at 0; a quantile beyond the last bound is that bound.
    """
    tops = F.array(*[F.lit(float(b)) for b in bounds])
    rank = F.lit(float(q)) * F.element_at(counts, -1)
    found = F.array_position(F.transform(counts, lambda c: c >= rank), True).cast("int")
    before = F.when(found > 1, F.get(counts, found - 2)).otherwise(F.lit(0))
    low = F.when(found > 1, F.get(tops, found - 2)).otherwise(F.lit(0.0))
    high = F.get(tops, found - 1)
    inside = low + (high - low) * (rank - before) / F.nullif((F.get(counts, found - 1) - before).cast("double"), F.lit(0.0))
    return F.when(found > len(bounds), F.lit(float(bounds[-1]))).otherwise(F.coalesce(inside, high))


def duration_quantile(events: DataFrame, q: float = 0.99, length: str = "5 minutes", labels: Sequence[str] = tuple(TASK_LABELS)) -> DataFrame:
    """Quantile of task durations per window and labels, from histogram buckets."""
    counted = events.groupBy(windowed(length).alias("w"), *labels).agg(bucket_counts(F.col("duration_s"), K.TASK_SECONDS).alias("counts"))
    return counted.select(F.col("w.start").alias("window_start"), *labels, quantile_of_counts(F.col("counts"), K.TASK_SECONDS, q).alias("duration"))


def failure_rate_by_type(events: DataFrame, length: str = "5 minutes") -> DataFrame:
    """Failed tasks per second by job and task type."""
    failed = events.filter(_failed()).groupBy(windowed(length).alias("w"), *TASK_LABELS).agg(F.count(F.lit(1)).alias("n"))
    return failed.select(F.col("w.start").alias("window_start"), *TASK_LABELS, (F.col("n") / F.lit(_seconds(length))).alias("failure_rate"))


def failures_by_error(events: DataFrame) -> DataFrame:
    return events.filter(_failed()).groupBy(error_type().alias("error_type")).agg(F.count(F.lit(1)).alias("failures"))


def active_tasks(events: DataFrame, labels: Sequence[str] = tuple(TASK_LABELS), block_micros: int = MICROS_PER_MINUTE) -> DataFrame:
    """Tasks running after each moment at which one starts or ends, by labels.

    A task without a duration still runs: it starts and does not end. There are few labels and very many events, so the running total goes through blocks of time, not one task per label.
    """
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    end = start + F.round(F.col("duration_s") * 1_000_000, 0).cast("bigint")
    change = F.array(
        F.struct(start.alias("at_micros"), F.lit(1).alias("change")), F.struct(end.alias("at_micros"), F.lit(-1).alias("change"))
    )
    moments = events.select(*labels, F.inline(change)).filter("at_micros is not null").groupBy(*labels, "at_micros").agg(F.sum("change").alias("change"))
    block = F.floor(F.col("at_micros") / block_micros)
    return running(moments, list(labels), "at_micros", block, sums={"active": "change"}).select(*labels, "at_micros", "active")


def pod_rates(events: DataFrame, length: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Successes and failures per second by pod over a sliding window."""
    seconds = F.lit(_seconds(length))
    return (
        events.groupBy(windowed(length, slide).alias("w"), "pod").agg(
            (F.count_if(_completed()) / seconds).alias("success_per_second"), (F.count_if(_failed()) / seconds).alias("failure_per_second"),
        )
        .select(F.col("w.start").alias("window_start"), "pod", "success_per_second", "failure_per_second")
    )
