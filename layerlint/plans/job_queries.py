"""Queries over export, job and task records, and telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerlint import constants as K
from layerlint.operators import export, metrics, tasks, verdict
from layerlint.plans.attribute_queries import METER_SQL
from layerlint.plans.query import query
from layerlint.plans.validation_queries import CHUNKS, SUMMARY_COUNTS_SQL, VIEWS, _verdicts, over
from layerlint.plans.views import Tables, with_views

# --- export -------------------------------------------------------------------------------------

# a region across the antimeridian is two boxes
PIECES_SQL = """(select roi_id, job_id, x0, y0, case when x0 > x1 then 180.0 else x1 end as x1, y1 from roi
    union all select roi_id, job_id, -180.0, y0, x1, y1 from roi where x0 > x1)"""
MET = "p.job_id = r.job_id and p.x0 <= r.x1 and r.x0 <= p.x1 and p.y0 <= r.y1 and r.y0 <= p.y1"
CANDIDATES_SQL = f"""select p.job_id, part_id, greatest(p.x0, r.x0) as x0, greatest(p.y0, r.y0) as y0, least(p.x1, r.x1) as x1, least(p.y1, r.y1) as y1,
    resolution_degree, roi_id as request_feature_id from parts p join {PIECES_SQL} r on {MET}"""


def _regions(t: Tables) -> DataFrame:
    return export.roi_feature_ids(t.roi, ("job_id", "ordinal"))


@query("roi_candidates", with_views("parts roi", CANDIDATES_SQL))
def _roi_candidates(t: Tables) -> DataFrame:
    return export.roi_candidates(t.parts, _regions(t), ("job_id",))


@query("roi_candidates_whole", with_views("parts roi", f"""select distinct p.job_id, part_id, p.x0, p.y0, p.x1, p.y1, resolution_degree, roi_id as request_feature_id
    from parts p join {PIECES_SQL} r on {MET}"""))
def _roi_candidates_whole(t: Tables) -> DataFrame:
    return export.roi_candidates(t.parts, _regions(t), ("job_id",), clip=False)


@query("apply_roi_resolution", with_views("parts roi", f"""+found as ({CANDIDATES_SQL}), raised as (select found.job_id, part_id, found.x0, found.y0,
    greatest(resolution_degree, max_resolution_deg) as resolution_degree from found join roi on roi_id = request_feature_id)
    select *, {METER_SQL.format(c='resolution_degree')} as resolution_meter from raised"""))
def _apply_roi_resolution(t: Tables) -> DataFrame:
    regions = _regions(t)
    return export.apply_roi_resolution(export.roi_candidates(t.parts, regions, ("job_id",)), regions).select(
        "job_id", "part_id", "x0", "y0", "resolution_degree", "resolution_meter"
    )


# --- jobs and tasks -----------------------------------------------------------------------------

LIMIT_SQL = "case when task_type in ('polygon-parts', 'validation') then 3 end"


@query("route_jobs", with_views("task_events", """select task_id, case job_type when 'Export' then 'export' when 'Bogus' then null else 'ingestion' end as handler,
    case when job_type = 'Bogus' then 'Bogus job type is invalid' end as route_error,
    case when job_type in ('Export', 'Bogus') then concat(job_type, ' job type is invalid') end as ingestion_error from task_events"""))
def _route_jobs(t: Tables) -> DataFrame:
    every = tasks.route_jobs(t.task_events).withColumnsRenamed({"handler": "handler_any", "route_error": "error_any"})
    return tasks.route_jobs(every, "ingestion").select(
        "task_id", F.col("handler_any").alias("handler"), F.col("error_any").alias("route_error"), F.col("route_error").alias("ingestion_error")
    )


@query("job_task", with_views("jobs task_events", """select j.job_id, t.task_id, j.resource_id, t.status from jobs j join
    (select user_id as job_id, event_id as task_id, case when event_type = 'error' then 'Failed' else 'Completed' end as status from events) t on t.job_id = j.job_id"""))
def _job_task(t: Tables) -> DataFrame:
    records = t.table("events").selectExpr(
        "user_id as job_id", "event_id as task_id", "case when event_type = 'error' then 'Failed' else 'Completed' end as status"
    )
    return tasks.job_task(t.jobs.select("job_id", "resource_id"), records).select("job_id", "task_id", "resource_id", "status")


@query("task_limits", with_views("task_events", f"select task_id, task_type, cast({LIMIT_SQL} as integer) as max_attempts from task_events"))
def _task_limits(t: Tables) -> DataFrame:
    return tasks.task_limits(t.task_events).select("task_id", "task_type", "max_attempts")


@query("attempts_gate", with_views("task_events", f"""select task_id, attempts,
    case when {LIMIT_SQL} is null then 'UnrecoverableTaskError' when attempts >= 3 then 'ReachedMaxTaskAttemptsError' end as gate_error,
    case when {LIMIT_SQL} is null then concat('task type ', task_type, ' is not configured')
      when attempts >= 3 then concat('task ', cast(task_id as varchar), ' reached max attempts, rejects as unrecoverable') end as gate_message from task_events"""))
def _attempts_gate(t: Tables) -> DataFrame:
    return tasks.attempts_gate(t.task_events).select("task_id", "attempts", "gate_error", "gate_message")


FAILURES = [
    "task_id", "error_type", "case when task_id % 7 = 0 then null else concat('failed with ', error_type) end as message",
    "case when task_id % 2 = 0 then props else '' end as previous_reason",
]


@query("triage_failures", with_views("task_events", f"""+failures as (select {', '.join(FAILURES)} from task_events where status = 'Failed')
    select task_id, error_type = 'Error' as recoverable, case when error_type = 'ReachedMaxTaskAttemptsError' and previous_reason <> '' then previous_reason
      else coalesce(message, 'unknown error occurred') end as reason from failures"""))
def _triage_failures(t: Tables) -> DataFrame:
    failures = t.task_events.filter("status = 'Failed'").selectExpr(*FAILURES)
    return tasks.triage_failures(failures).select("task_id", "recoverable", "reason")


RESULTS = [
    "user_id as job_id", "event_id as task_id", "case user_id % 5 when 0 then 'Ingestion_New' when 1 then 'Ingestion_Update' when 2 then 'Export' when 3 then 'Bogus' else 'Ingestion_Swap_Update' end as job_type",
    "concat('r', cast(user_id as string)) as resource_id", "'Orthophoto' as product_type",
    "'1.0' as version", "case when user_id % 7 = 0 then 'unconfigured' when user_id % 7 < 3 then 'polygon-parts' else 'validation' end as task_type",
    "case when event_type = 'error' then 'Failed' else 'Completed' end as status",
    "case when event_type <> 'error' then null when event_id % 11 < 4 then 'ReachedMaxTaskAttemptsError' else 'Error' end as error_type",
    "event_id % 2 = 0 as recoverable", "case event_id % 3 when 0 then true when 1 then false end as is_valid",
]


@query("callback_rows", f"""with results as (select {', '.join(RESULTS)}, event_id from events),
    urls as (select event_id, unnest(case event_id % 4 when 0 then []::varchar[] when 1 then ['http://a/1'] else ['http://a/1', 'http://b/2'] end) as url from events)
    select r.job_id, r.task_id, url, concat('{{"jobId":"', job_id, '","taskId":"', task_id, '","jobType":"', job_type, '","productId":"', resource_id,
      '","productType":"Orthophoto","version":"1.0","taskType":"', task_type, '","status":"', status, '",',
      case when status = 'Failed' then concat('"error":"', task_type, ' task failed"}}') else concat('"message":"', task_type, ' task completed ',
        case when coalesce(is_valid, false) then 'successfully' else 'with errors' end, '","data":{{"isValid":', cast(coalesce(is_valid, false) as varchar), ',"links":[',
        case when task_id % 5 = 0 then concat('{{"fileName":"f', task_id, '.zip","url":"http://d/f', task_id, '","fileSize":', task_id, '}}') else '' end, ']}}}}') end) as payload
    from results r join urls u on u.event_id = r.event_id
    where job_type like 'Ingestion%' and not (status = 'Failed' and (recoverable or task_type = 'unconfigured' or error_type = 'ReachedMaxTaskAttemptsError'))""")
def _callback_rows(t: Tables) -> DataFrame:
    urls = "case event_id % 4 when 0 then array() when 1 then array('http://a/1') else array('http://a/1', 'http://b/2') end as callback_urls"
    report = """case when event_id % 5 = 0 then named_struct('fileName', concat('f', cast(event_id as string), '.zip'),
        'url', concat('http://d/f', cast(event_id as string)), 'fileSize', event_id) end as report"""
    return tasks.callback_rows(t.table("events").selectExpr(*RESULTS, urls, report))


@query("merge_task_params", over(f"""select j.job_id, j.task_id, v."metadata" as metadata_errors, coalesce(not v.has_critical_errors, false) as is_valid,
    case when v.has_critical_errors then concat('http://localhost:8085/downloads/validation-reports/', cast(j.job_id as varchar), '/r', cast(j.job_id as varchar), '.zip')
      when j.job_id % 3 = 0 then 'old' end as report_url from jobs j left join verdicts v on v.job_id = j.job_id""", CHUNKS, f"{VIEWS} jobs"))
def _merge_task_params(t: Tables) -> DataFrame:
    verdicts = _verdicts(t)
    summaries = verdicts.select("job_id", verdict.summary_struct().alias("summary"), "is_valid")
    kind = summaries.schema["summary"].dataType.simpleString()
    saved = t.jobs.select(
        "job_id", "task_id", F.lit(None).cast(kind).alias("errors_summary"), F.lit(False).alias("is_valid"),
        F.when(F.col("job_id") % 3 == 0, F.struct(F.lit("o.zip").alias("fileName"), F.lit(1).cast("bigint").alias("fileSize"),
                                                 F.lit("/o").alias("path"), F.lit("old").alias("url"))).alias("report"),
    )
    name = F.concat(F.lit("r"), F.col("job_id").cast("string"), F.lit(".zip"))
    manifest = verdicts.filter("has_critical_errors").select(
        "job_id", name.alias("fileName"), F.lit(2).cast("bigint").alias("fileSize"), F.lit("/r").alias("path")
    )
    merged = tasks.merge_task_params(saved, summaries, manifest)
    return merged.select("job_id", "task_id", F.col("errors_summary.errorsCount.metadata").alias("metadata_errors"), "is_valid", F.col("report.url").alias("report_url"))


# a task has many updates; each sets the chunk, the progress, both or nothing
UPDATES = ["user_id as job_id", "user_id * 10 + event_id % 3 as task_id", "event_id as version", "case when event_id % 4 < 2 then event_id % 50 end as chunk",
           "case when event_id % 5 < 3 then event_id end as processed", "case when event_id % 5 < 3 then (event_id % 200) / 2.0 end as done"]
SAVED = ["user_id as job_id", "user_id * 10 + 2 as task_id"]


@query("task_states", f"""with updates as (select {', '.join(UPDATES)} from events),
    folded as (select job_id, task_id, arg_max(chunk, version) filter (where chunk is not null) as chunk, arg_max(processed, version) filter (where processed is not null) as processed,
      arg_max(done, version) filter (where processed is not null) as done from updates group by 1, 2),
    saved as (select distinct {', '.join(SAVED)} from events)
    select coalesce(s.job_id, f.job_id) as job_id, coalesce(s.task_id, f.task_id) as task_id, coalesce(chunk, case when s.task_id is not null then -1 end) as chunk,
      coalesce(processed, case when s.task_id is not null then 7 end) as processed,
      cast(floor(coalesce(done, case when s.task_id is not null then 12.5 end) + 0.5) as int) as percentage from saved s full join folded f on f.task_id = s.task_id""")
def _task_states(t: Tables) -> DataFrame:
    progress = "if(processed is null, null, named_struct('processed', processed, 'percentage', cast(done as double)))"
    events = t.table("events")
    updates = events.selectExpr(*UPDATES).selectExpr("job_id", "task_id", "version", f"named_struct('chunk', chunk, 'progress', {progress}) as state")
    saved = events.selectExpr(*SAVED).distinct().selectExpr("*", "named_struct('chunk', -1L, 'progress', named_struct('processed', 7L, 'percentage', 12.5D)) as state")
    states = tasks.task_states(saved, updates, ["chunk", "progress"])
    return states.select("job_id", "task_id", F.col("state.chunk").alias("chunk"), F.col("state.progress.processed").alias("processed"), "percentage")


# --- telemetry ----------------------------------------------------------------------------------


@query("task_counters", with_views("task_events", """select job_type, task_type, count(*) as processed, count(*) filter (where status = 'Completed') as success,
    count(*) filter (where status = 'Failed') as failure from task_events group by 1, 2"""))
def _task_counters(t: Tables) -> DataFrame:
    return metrics.task_counters(t.task_events)


@query("failure_counters", with_views("task_events", """select job_type, task_type, coalesce(error_type, 'UnknownError') as error_type, count(*) as failure
    from task_events where status = 'Failed' group by 1, 2, 3"""))
def _failure_counters(t: Tables) -> DataFrame:
    return metrics.failure_counters(t.task_events)


def _bounds_sql(bounds: list[float]) -> str:
    rows = [f"('{metrics._bound_text(b)}', cast({b} as double))" for b in bounds] + ["('+Inf', cast('infinity' as double))"]
    return f"(values {', '.join(rows)}) b(le, bound)"


def histogram_sql(source: str, labels: str, value: str, bounds: list[float]) -> str:
    keys = f"{labels}, " if labels else ""
    return (f"select {keys}le, count(*) filter (where {value} <= bound) as \"count\", round(cast(sum({value}) as double), 3) as total_value, count(*) as total "
            f"from {source} cross join {_bounds_sql(bounds)} group by {keys}le")


def _rounded(histogram: DataFrame) -> DataFrame:
    """The sum rounded for comparison, as double addition depends on order."""
    return histogram.withColumn("total_value", F.round(F.col("sum").cast("double"), 3)).drop("sum")


@query("duration_histogram", with_views("task_events", histogram_sql("task_events", "job_type, task_type, status", "duration_s", K.TASK_SECONDS)))
def _duration_histogram(t: Tables) -> DataFrame:
    return _rounded(metrics.duration_histogram(t.task_events))


OPERATIONS = """+timed as materialized (select 'read' as operation, read_ms / 1000.0 as seconds from {v} union all select 'process', process_ms / 1000.0 from {v}
    union all select 'total', total_ms / 1000.0 from {v}) """


@query("chunk_metrics", with_views("chunk_times", OPERATIONS.format(v="chunk_times") + histogram_sql("timed", "operation", "seconds", K.CHUNK_SECONDS)))
def _chunk_metrics(t: Tables) -> DataFrame:
    return _rounded(metrics.chunk_metrics(t.chunk_times))


@query("features_per_chunk", with_views("chunk_times", histogram_sql("chunk_times", "", "features", K.CHUNK_FEATURES)))
def _features_per_chunk(t: Tables) -> DataFrame:
    return _rounded(metrics.features_per_chunk(t.chunk_times))


# Features of a chunk scaled up so that every size range occurs.
SCALED = "features * (1 + chunk_id * 20)"
RANGE_SQL = "case " + " ".join(f"when n <= {top} then '{label}'" for top, label in K.CHUNK_SIZE_RANGES[:-1]) + f" else '{K.CHUNK_SIZE_RANGES[-1][1]}' end"


@query("duration_by_chunk_size", with_views("chunk_times", f"""+sized as materialized (select {RANGE_SQL} as chunk_size_range, total_ms / 1000.0 as seconds
    from (select *, {SCALED} as n from chunk_times) c) """ + histogram_sql("sized", "chunk_size_range", "seconds", K.CHUNK_SECONDS)))
def _duration_by_chunk_size(t: Tables) -> DataFrame:
    return _rounded(metrics.duration_by_chunk_size(t.chunk_times.withColumn("features", F.expr(SCALED))))


@query("file_metrics", with_views("file_times", OPERATIONS.format(v="file_times") + histogram_sql("timed", "operation", "seconds", K.FILE_SECONDS)))
def _file_metrics(t: Tables) -> DataFrame:
    return _rounded(metrics.file_metrics(t.file_times))


@query("features_per_file", with_views("file_times", histogram_sql("file_times", "", "features", K.FILE_FEATURES)))
def _features_per_file(t: Tables) -> DataFrame:
    return _rounded(metrics.features_per_file(t.file_times))


HOUR = "epoch_us(time_bucket(interval '1 hour', ts))"


def _micros(windows: DataFrame) -> DataFrame:
    return windows.withColumn("window_micros", F.unix_micros(F.col("window_start").cast("timestamp"))).drop("window_start")


@query("success_rate", with_views("task_events", f"""select {HOUR} as window_micros, round(count(*) filter (where status = 'Completed') * 100.0 / count(*), 6) as success_rate,
    round(count(*) filter (where status = 'Failed') * 100.0 / count(*), 6) as failure_rate from task_events group by 1"""))
def _success_rate(t: Tables) -> DataFrame:
    rates = _micros(metrics.success_rate(t.task_events, "1 hour"))
    return rates.select("window_micros", F.round("success_rate", 6).alias("success_rate"), F.round("failure_rate", 6).alias("failure_rate"))


@query("throughput", with_views("task_events", f"""select {HOUR} as window_micros, job_type, task_type, round(count(*) / 3600.0, 9) as throughput
    from task_events group by 1, 2, 3"""))
def _throughput(t: Tables) -> DataFrame:
    found = _micros(metrics.throughput(t.task_events, "1 hour", metrics.TASK_LABELS))
    return found.withColumn("throughput", F.round("throughput", 9))


@query("overall_throughput", with_views("task_events", f"select {HOUR} as window_micros, round(count(*) / 3600.0, 9) as throughput from task_events group by 1"))
def _overall_throughput(t: Tables) -> DataFrame:
    return _micros(metrics.throughput(t.task_events, "1 hour")).withColumn("throughput", F.round("throughput", 9))


BUCKETS = ", ".join(f"(cast({i} as integer), cast({lo} as double), cast({hi} as double))" for i, (lo, hi) in enumerate(zip([0, *K.TASK_SECONDS], K.TASK_SECONDS)))
P99_SQL = f"""+samples as materialized (select time_bucket(interval '1 day', ts) as day, job_type, task_type, duration_s from task_events),
    sizes as materialized (select day, job_type, task_type, count(*) * 0.99 as rank from samples group by 1, 2, 3),
    cumulative as materialized (select s.day, s.job_type, s.task_type, b.i, b.low, b.high, count(*) filter (where duration_s <= high) as at_top,
      count(*) filter (where duration_s <= low) as at_low from samples s cross join (values {BUCKETS}) b(i, low, high) group by all),
    hit as materialized (select c.*, z.rank, row_number() over (partition by c.day, c.job_type, c.task_type order by i) as rn
      from cumulative c join sizes z on z.day = c.day and z.job_type = c.job_type and z.task_type = c.task_type where at_top >= rank)
    select epoch_us(z.day) as window_micros, z.job_type, z.task_type,
      round(case when h.i is null then 500.0 else low + (high - low) * (h.rank - case when i = 0 then 0 else at_low end) / (at_top - case when i = 0 then 0 else at_low end) end, 6) as duration
    from sizes z left join hit h on h.day = z.day and h.job_type = z.job_type and h.task_type = z.task_type and h.rn = 1"""


@query("duration_quantile", with_views("task_events", P99_SQL))
def _duration_quantile(t: Tables) -> DataFrame:
    return _micros(metrics.duration_quantile(t.task_events, 0.99, "1 day")).withColumn("duration", F.round("duration", 6))


@query("avg_duration", with_views("task_events", f"select {HOUR} as window_micros, round(sum(duration_s) / count(duration_s), 6) as avg_duration from task_events group by 1"))
def _avg_duration(t: Tables) -> DataFrame:
    return _micros(metrics.avg_duration(t.task_events, "1 hour")).withColumn("avg_duration", F.round("avg_duration", 6))


@query("failure_rate_by_type", with_views("task_events", f"""select {HOUR} as window_micros, job_type, task_type, round(count(*) / 3600.0, 9) as failure_rate
    from task_events where status = 'Failed' group by 1, 2, 3"""))
def _failure_rate_by_type(t: Tables) -> DataFrame:
    return _micros(metrics.failure_rate_by_type(t.task_events, "1 hour")).withColumn("failure_rate", F.round("failure_rate", 9))


@query("failures_by_error", with_views("task_events", """select coalesce(error_type, 'UnknownError') as error_type, count(*) as failures
    from task_events where status = 'Failed' group by 1"""))
def _failures_by_error(t: Tables) -> DataFrame:
    return metrics.failures_by_error(t.task_events)


def active_sql(labels: str) -> str:
    return with_views("task_events", f"""+changes as (select {labels}, epoch_us(ts) as at_micros, 1 as change from task_events
    union all select {labels}, epoch_us(ts) + cast(round(duration_s * 1000000) as bigint), -1 from task_events),
    moments as (select {labels}, at_micros, sum(change) as change from changes group by {labels}, at_micros)
    select {labels}, at_micros, cast(sum(change) over (partition by {labels} order by at_micros rows unbounded preceding) as bigint) as active from moments""")


@query("active_tasks", active_sql("job_type, task_type"))
def _active_tasks(t: Tables) -> DataFrame:
    return metrics.active_tasks(t.task_events)


@query("pod_active_tasks", active_sql("pod"))
def _pod_active_tasks(t: Tables) -> DataFrame:
    return metrics.active_tasks(t.task_events, ["pod"])


@query("pod_rates", with_views("task_events", """+slots as (select pod, status, unnest(generate_series(0, 4)) as back, time_bucket(interval '1 minute', ts) as minute from task_events)
    select epoch_us(minute - back * interval '1 minute') as window_micros, pod, round(count(*) filter (where status = 'Completed') / 300.0, 9) as success_per_second,
      round(count(*) filter (where status = 'Failed') / 300.0, 9) as failure_per_second from slots group by 1, 2"""))
def _pod_rates(t: Tables) -> DataFrame:
    found = _micros(metrics.pod_rates(t.task_events, "5 minutes", "1 minute"))
    return found.withColumns({c: F.round(c, 9) for c in ("success_per_second", "failure_per_second")})


@query("label_filter", with_views("task_events", """select task_id, job_type, task_type, pod from task_events
    where regexp_full_match(job_type, 'Ingestion_.*|Export') and regexp_full_match(task_type, 'validation') and regexp_full_match(cast(pod as varchar), '0|2')"""))
def _label_filter(t: Tables) -> DataFrame:
    kept = metrics.label_filter(t.task_events, job_type="Ingestion_.*|Export", task_type="validation", pod="0|2")
    return kept.select("task_id", "job_type", "task_type", "pod")


@query("label_values", with_views("task_events", "select distinct task_type from task_events where regexp_full_match(job_type, 'Ingestion_.*')"))
def _label_values(t: Tables) -> DataFrame:
    return metrics.label_values(metrics.label_filter(t.task_events, job_type="Ingestion_.*"), "task_type")
