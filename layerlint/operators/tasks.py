"""Job and task records: routing, attempts, failures, callbacks, parameters."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from layerlint import constants as K
from layerlint.config import SERVICES, Services
from layerlint.functions.rounding import progress_percentage
from layerlint.functions.text import build_url


def _lookup(key: Column, table: dict) -> Column:
    """Value of a short fixed table, NULL if not listed; a literal in the plan, so no join."""
    literals = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(literals, key)


def route_jobs(jobs: DataFrame, instance_type: str | None = None) -> DataFrame:
    """Add ``handler`` and ``route_error``. With an instance type, types of the other instance are errors too."""
    handlers = {t: h for t, h in K.JOB_HANDLERS.items() if instance_type in (None, h)}
    handler = _lookup(F.col("job_type"), handlers)
    error = F.when(handler.isNull(), F.concat(F.col("job_type"), F.lit(" job type is invalid")))
    return jobs.withColumn("handler", handler).withColumn("route_error", error)


def job_task(jobs: DataFrame, tasks: DataFrame) -> DataFrame:
    """Each job with each of its tasks; a task without job, or a job without task, gives no row."""
    return jobs.join(tasks, "job_id")


def task_limits(tasks: DataFrame, max_attempts: dict[str, int] | None = None) -> DataFrame:
    """Add ``max_attempts`` of the task's type; NULL if the type is not configured."""
    return tasks.withColumn("max_attempts", _lookup(F.col("task_type"), max_attempts or K.MAX_ATTEMPTS).cast("int"))


def attempts_gate(tasks: DataFrame, max_attempts: dict[str, int] | None = None) -> DataFrame:
    """Add ``gate_error`` (class) and ``gate_message``; NULL for tasks that may run."""
    limited = task_limits(tasks, max_attempts)
    configured = F.col("max_attempts").isNotNull()
    spent = F.col("attempts") >= F.col("max_attempts")
    return limited.withColumns({
        "gate_error": F.when(~configured, "UnrecoverableTaskError").when(spent, K.REACHED_MAX_ATTEMPTS),
        "gate_message": F.when(~configured, F.concat(F.lit("task type "), F.col("task_type"), F.lit(" is not configured"))).when(
            spent, F.concat(F.lit("task "), F.col("task_id").cast("string"), F.lit(" reached max attempts, rejects as unrecoverable"))
        ),
    })


def triage_failures(failures: DataFrame) -> DataFrame:
    """Whether a failed task may be tried again, and the reason stored with it.

    Reads ``error_type``, ``message`` (NULL if what was thrown was no error) and ``previous_reason``. A task out of attempts
    keeps the reason of its last real failure.
    """
    keeps = (F.col("error_type") == K.REACHED_MAX_ATTEMPTS) & (F.length("previous_reason") > 0)
    return failures.withColumns({
        "recoverable": ~F.coalesce(F.col("error_type").isin(*K.UNRECOVERABLE_ERRORS), F.lit(False)),
        "reason": F.when(F.coalesce(keeps, F.lit(False)), F.col("previous_reason")).otherwise(
            F.coalesce("message", F.lit("unknown error occurred"))
        ),
    })


def callback_rows(results: DataFrame) -> DataFrame:
    """One payload per finished task and callback URL.

    Reads job fields, ``status``, ``recoverable`` and ``error_type`` (of failed tasks), ``is_valid``, ``report``
    (STRUCT<fileName, url, fileSize> or NULL) and ``callback_urls``. Only ingestion calls back. A failure that may be tried again
    calls nobody, nor does one before the task had a handler (attempts spent, task type not configured), nor a task without URLs.
    """
    failed = F.col("status") == "Failed"
    handled = _lookup(F.col("task_type"), K.MAX_ATTEMPTS).isNotNull() & (F.coalesce("error_type", F.lit("")) != K.REACHED_MAX_ATTEMPTS)
    told = results.filter(
        (_lookup(F.col("job_type"), K.JOB_HANDLERS) == "ingestion") & (~failed | (handled & ~F.coalesce("recoverable", F.lit(False))))
    )
    valid = F.coalesce("is_valid", F.lit(False))
    ending = F.when(valid, " task completed successfully").otherwise(" task completed with errors")
    link = F.struct(
        F.col("report.fileName").alias("fileName"), F.col("report.url").alias("url"), F.col("report.fileSize").alias("fileSize"),
    )
    links = F.filter(F.array(link), lambda _: F.col("report").isNotNull())
    payload = F.struct(
        F.col("job_id").cast("string").alias("jobId"), F.col("task_id").cast("string").alias("taskId"), F.col("job_type").alias("jobType"),
        F.col("resource_id").alias("productId"), F.col("product_type").alias("productType"), F.col("version").alias("version"),
        F.col("task_type").alias("taskType"), F.col("status").alias("status"),
        F.when(failed, F.concat(F.col("task_type"), F.lit(" task failed"))).alias("error"),
        F.when(~failed, F.concat(F.col("task_type"), ending)).alias("message"),
        F.when(~failed, F.struct(valid.alias("isValid"), links.alias("links"))).alias("data"),
    )
    sent = told.select("job_id", "task_id", "callback_urls", F.to_json(payload).alias("payload"))
    return sent.select("job_id", "task_id", F.explode("callback_urls").alias("url"), "payload")


def merge_state(saved: Column, update: Column, fields: list[str]) -> Column:
    """Overlay a state field by field; fields the update leaves NULL keep their saved value."""
    merged = F.struct(*[F.coalesce(update[f], saved[f]).alias(f) for f in fields])
    return F.when(update.isNull(), saved).when(saved.isNull(), update).otherwise(merged)


def task_states(saved: DataFrame, updates: DataFrame, fields: list[str], version: str = "version") -> DataFrame:
    """One row per task that has a saved state or an update: job_id, task_id, ``state`` and ``percentage``.

    ``saved(job_id, task_id, state)`` has at most one row per task, ``updates(job_id, task_id, version, state)`` any number. Updates
    overlay the saved state field by field in the order of their version (unique in a task): the latest that sets a field wins.
    Each field is a maximum by version, so a task with very many updates is combined before the shuffle, in any order.
    ``percentage`` is that of the state's ``progress``, as a whole number; NULL without progress. Updates without version or state set nothing.
    """
    set_at = lambda f: F.when(F.col("state")[f].isNotNull(), F.col(version))
    latest = updates.filter(F.col(version).isNotNull()).groupBy("job_id", "task_id").agg(*[F.max_by(F.col("state")[f], set_at(f)).alias(f) for f in fields])
    folded = latest.select("job_id", "task_id", F.struct(*fields).alias("__new"))
    joined = saved.select("job_id", "task_id", F.col("state").alias("__saved")).join(folded, ["job_id", "task_id"], "full")
    state = merge_state(F.col("__saved"), F.col("__new"), fields)
    return joined.select("job_id", "task_id", state.alias("state")).withColumn("percentage", progress_percentage(F.col("state.progress.percentage")))


def merge_task_params(tasks: DataFrame, verdicts: DataFrame, manifest: DataFrame, services: Services = SERVICES) -> DataFrame:
    """Latest parameters overlaid with summary and verdict, and with the report only where one was published.

    Reads ``tasks(job_id, task_id, processing_state, errors_summary, is_valid, report)``, ``verdicts(job_id, summary,
    is_valid)`` and ``manifest(job_id, fileName, fileSize, path)``.
    """
    base = build_url(F.lit(services.download_base), F.lit(services.download_path))
    new = verdicts.select("job_id", F.col("summary").alias("__summary"), F.col("is_valid").alias("__valid"))
    published = manifest.select(
        "job_id",
        F.struct(
            "fileName", "fileSize", "path", F.concat(base, F.lit("/"), F.col("job_id").cast("string"), F.lit("/"), F.col("fileName")).alias("url")
        ).alias("__report"),
    )
    joined = tasks.join(new, "job_id", "left").join(published, "job_id", "left")
    return joined.withColumns({
        "errors_summary": F.coalesce("__summary", "errors_summary"),
        "is_valid": F.coalesce("__valid", "is_valid"),
        "report": F.coalesce("__report", "report"),
    }).drop("__summary", "__valid", "__report")
