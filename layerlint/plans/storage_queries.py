"""Queries that write to the shared folder and read back, and streams run to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerlint import constants as K
from layerlint.functions.geometry import count_vertices
from layerlint.functions.text import format_issues
from layerlint.operators import errors, export, schema
from layerlint.plans.attribute_queries import ERROR_COLUMNS, FEATURE_ERRORS_SQL, METER_SQL, over_checked
from layerlint.plans.job_queries import CANDIDATES_SQL
from layerlint.plans.query import query
from layerlint.plans.validation_queries import CHUNKS, REPORT_COLUMNS, REPORT_SQL, VIEWS, WIDE_SQL, _errors, _verdicts, over
from layerlint.plans.views import Tables, with_views
from layerlint.session import new_folder, written
from layerlint.sources import features as feature_source, layers, reports
from layerlint.streaming import metrics as live_metrics, validation as live_validation

# --- features and files -------------------------------------------------------------------------


@query("read_features", """select p_partkey as ordinal, 'Feature' as type, p_name as feature_id, 'Polygon' as geometry_type, cast(4 as integer) as vertex_count,
    case when p_partkey % 3 = 0 then null else p_brand end as source_name, p_partkey % 3 = 0 as source_name_null, cast(p_retailprice as double) as ep90 from part""")
def _read_features(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "geojson")
    ring = F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.col("p_size").cast("double"), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)), F.array(F.lit(0.0), F.lit(0.0)))
    properties = F.struct(F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("sourceName"), F.col("p_retailprice").alias("ep90"))
    line = F.struct(
        F.lit(1).alias("job_id"), F.col("p_partkey").alias("ordinal"), F.lit("Feature").alias("type"), F.col("p_name").alias("id"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"), properties.alias("properties"),
    )
    t.table("part").select(F.to_json(line, {"ignoreNullFields": "false"}).alias("value")).write.text(path)
    found = feature_source.read_features(t.spark, path, "geojsonl")
    name = F.try_variant_get("properties", "$.sourceName", "string")
    kind = F.schema_of_variant(F.try_variant_get("properties", "$.sourceName", "variant"))
    return found.select(
        "ordinal", "type", "feature_id", F.col("geometry.type").alias("geometry_type"), count_vertices(F.col("geometry")).alias("vertex_count"),
        name.alias("source_name"), (kind == "VOID").alias("source_name_null"), F.try_variant_get("properties", "$.ep90", "double").alias("ep90"),
    )


LINES = """case when p_partkey % 13 = 0 then concat('{"broken', cast(p_partkey as string)) when p_partkey % 17 = 0 then concat('{"job_id":"00', cast(p_partkey as string), '","type":"Feature"}')
    when p_partkey % 19 = 0 then concat('{"ordinal":', cast(p_partkey as string), ',"type":"Feature"}')
    else concat('{"job_id":"00', cast(p_size as string), '","ordinal":', cast(p_partkey as string), ',"type":"Feature","id":', case p_partkey % 4 when 0 then '7' when 1 then '"a"' when 2 then '{}' else 'null' end,
      ',"bbox":', case p_partkey % 3 when 0 then '[1,2,3,4.5]' when 1 then '[1,2,"3",4]' else '[1,2,3]' end, case when p_partkey % 5 = 0 then ',"properties":null}' when p_partkey % 7 = 0 then '}' else ',"properties":"x"}' end) end"""


@query("broken_lines", f"""select line, case when line like '{{"broken%' then 'not a JSON object of a feature' when line like '{{"job%' then 'no position' else 'no job' end as reason
    from (select {LINES} as line, p_partkey from part) t where p_partkey % 13 = 0 or p_partkey % 17 = 0 or p_partkey % 19 = 0""")
def _broken_lines(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "geojson")
    t.table("part").selectExpr(f"{LINES} as value").write.text(path)
    return feature_source.broken_lines(t.spark, path)


@query("line_shape_issues", """select concat('00', cast(p_size as string)) as job_id, cast(p_partkey as bigint) as ordinal, concat_ws('; ',
    case when p_partkey % 4 > 1 then 'id: Invalid input (code: invalid_union)' end, case when p_partkey % 3 > 0 then 'bbox: Invalid input (code: invalid_union)' end,
    'geometry: Invalid input (code: invalid_union)', case when p_partkey % 5 = 0 then 'properties: Expected object, received null (code: invalid_type)'
      when p_partkey % 7 = 0 then 'properties: Required (code: invalid_type)' else 'properties: Expected object, received string (code: invalid_type)' end) as issues
    from part where p_partkey % 13 <> 0 and p_partkey % 17 <> 0 and p_partkey % 19 <> 0""")
def _line_shape_issues(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "geojson")
    t.table("part").selectExpr(f"{LINES} as value").write.text(path)
    checked = schema.metadata_issues(feature_source.read_features(t.spark, path, "geojsonl"))
    return checked.select("job_id", "ordinal", format_issues(F.col("issues")).alias("issues"))


FLAGS = ", ".join(f"bool_or(path = concat(base, '{e}')) as has{e[1:]}" for e in K.LAYER_EXTENSIONS)
ABSENT = ", ".join(f"case when not has{e[1:]} then concat(base, '{e}') end" for e in K.LAYER_EXTENSIONS)


@query("missing_files", with_views("listing", f"""+flags as (select base, {FLAGS} from listing group by base), absent as (select base, concat_ws(', ', {ABSENT}) as missing from flags)
    select base, missing, concat('Shapefile not found: ', base, '. Missing files: ', missing) as error from absent where missing <> ''"""))
def _missing_files(t: Tables) -> DataFrame:
    found = feature_source.missing_files(t.listing.select("base").distinct(), t.listing.select("path"))
    return found.withColumn("missing", F.array_join("missing", ", "))


@query("absent_folders", with_views("listing", """+required as (select distinct concat(base, '.shp') as path from listing)
    select r.path from required r where not exists (select 1 from listing l where l.path = r.path)"""))
def _absent_folders(t: Tables) -> DataFrame:
    required = t.listing.select(F.concat("base", F.lit(".shp")).alias("path")).distinct()
    return feature_source.absent_folders(required, t.listing.select("path"))


# --- reports ------------------------------------------------------------------------------------


def _report(t: Tables) -> DataFrame:
    return errors.report_rows(t.stored.features, _errors(t)).select(*REPORT_COLUMNS)


@query("write_report", over(REPORT_SQL))
def _write_report(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "report")
    reports.write_report(_report(t), path)
    return reports.read_report(t.spark, path).select(*REPORT_COLUMNS)


NARROW_SQL = f"select job_id, chunk_id, error_id, feature_ordinal, e_vertices, e_metadata from ({REPORT_SQL}) r"


@query("read_report", over(NARROW_SQL))
def _read_report(t: Tables) -> DataFrame:
    regular, skipped = new_folder(t.spark, "report"), new_folder(t.spark, "report")
    # written three times below, computed once
    report = written(_report(t).select("job_id", "chunk_id", "error_id", "feature_ordinal", "e_vertices", "e_metadata"), "report-rows")
    # the first report lacks a column and is written twice
    reports.write_report(report.filter("e_vertices is null").drop("e_vertices"), regular, batch="b0")
    reports.write_report(report.filter("e_vertices is null").drop("e_vertices"), regular, batch="b0")
    reports.write_report(report.filter("e_vertices is not null"), skipped)
    return reports.read_report(t.spark, regular, skipped).drop("batch")


@query("report_error_counts", over("select job_id, " + ", ".join(f'count({c}) as "{counter}"' for _, c, counter in K.ERROR_TYPES) + f" from ({WIDE_SQL}) w group by job_id"))
def _report_error_counts(t: Tables) -> DataFrame:
    return reports.report_error_counts(errors.errors_by_feature(_errors(t)), by_job=True)


OUTCOMES_SQL = f"""with_rows as (select job_id, count(*) as report_rows from ({WIDE_SQL}) w group by job_id),
    outcomes as (select j.job_id, case when j.job_id % 10 = 0 then 'reused' when r.report_rows is null then 'none'
      when coalesce(v.has_critical_errors, false) then 'published' else 'dropped' end as outcome,
      case when j.job_id % 10 = 0 then concat('/old/', cast(j.job_id as varchar)) end as existing_path,
      case when j.job_id % 10 = 0 then cast(j.job_id as bigint) end as existing_size, coalesce(r.report_rows, 0) as report_rows
      from jobs j left join with_rows r on r.job_id = j.job_id left join verdicts v on v.job_id = j.job_id)"""


def _outcomes(t: Tables) -> DataFrame:
    existing = t.jobs.filter("job_id % 10 = 0").select("job_id", F.concat(F.lit("/old/"), F.col("job_id").cast("string")).alias("path"), F.col("job_id").cast("bigint").alias("size"))
    return reports.finalize_reports(t.jobs, errors.errors_by_feature(_errors(t)), _verdicts(t), existing)


@query("finalize_reports", over(f", {OUTCOMES_SQL} select * from outcomes", CHUNKS, f"{VIEWS} jobs"))
def _finalize_reports(t: Tables) -> DataFrame:
    return _outcomes(t)


FILE_SQL = "concat(lower(concat(resource_id, '_', product_type)), '_v', version, '_report_2025-01-02T03:04:05.006Z.zip')"


@query("report_manifest", over(f""", {OUTCOMES_SQL}, files as (select o.*, case when outcome = 'reused' then cast(o.job_id as varchar) else {FILE_SQL} end as file
      from outcomes o join jobs j on j.job_id = o.job_id where outcome in ('published', 'reused'))
    select job_id, file as "fileName", case when outcome = 'reused' then existing_size else report_rows end as "fileSize",
    coalesce(existing_path, concat('/validation-reports/', cast(job_id as varchar), '/', file)) as path,
    concat('http://localhost:8085/downloads/validation-reports/', cast(job_id as varchar), '/', file) as url,
    concat('validation-reports/', cast(job_id as varchar), '/', file) as s3_key from files""", CHUNKS, f"{VIEWS} jobs"))
def _report_manifest(t: Tables) -> DataFrame:
    return reports.report_manifest(_outcomes(t), t.jobs, "2025-01-02 03:04:05.006")


# --- exported layers ----------------------------------------------------------------------------

PACKAGES = "select distinct concat('pkg', cast(c_nationkey as varchar)) as package from customer"
TARGETS = [
    "job_id", "concat('pkg', cast(job_id % 30 as string)) as package", "resource_id", "product_type",
]


@query("export_targets", with_views("jobs", f"""+packages as ({PACKAGES}), wanted as (select {', '.join(TARGETS)} from jobs)
    select w.job_id, w.package, concat(resource_id, '-', product_type, '_features') as layer,
      case when p.package is null then concat('gpkg file does not exist at ', w.package) end as error from wanted w left join packages p on p.package = w.package"""))
def _export_targets(t: Tables) -> DataFrame:
    packages = t.table("customer").select(F.concat(F.lit("pkg"), F.col("c_nationkey").cast("string")).alias("package"))
    return layers.export_targets(t.jobs.selectExpr(*TARGETS), packages)


@query("write_export_layer", with_views("parts roi", f"""+found as ({CANDIDATES_SQL}), raised as (select found.job_id, part_id, found.x0, found.y0,
    greatest(resolution_degree, max_resolution_deg) as resolution_degree from found join roi on roi_id = request_feature_id)
    select part_id, x0, y0, resolution_degree, {METER_SQL.format(c='resolution_degree')} as resolution_meter,
      concat('pkg', cast(job_id % 3 as varchar)) as package, concat('layer', cast(job_id as varchar)) as layer from raised
    union all select part_id, x0, y0, resolution_degree, cast(null as double), '007', 'untouched' from parts"""))
def _write_export_layer(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "export")
    regions = export.roi_feature_ids(t.roi, ("job_id", "ordinal"))
    # written three times below, computed once
    exported = written(export.apply_roi_resolution(export.roi_candidates(t.parts, regions, ("job_id",)), regions), "exported")
    no_error = F.lit(None).cast("string").alias("error")
    job = F.col("job_id")
    targets = t.roi.select("job_id").distinct().select("job_id", F.concat(F.lit("pkg"), (job % 3).cast("string")).alias("package"),
                                                       F.concat(F.lit("layer"), job.cast("string")).alias("layer"), no_error)
    other = t.spark.range(1).select(F.lit(-1).alias("job_id"), F.lit("007").alias("package"), F.lit("untouched").alias("layer"), no_error)
    plain = t.parts.withColumn("job_id", F.lit(-1).cast("bigint")).withColumn("resolution_meter", F.lit(None).cast("double"))
    layers.write_export_layer(plain, other, path)
    # every second part first, then all of them twice: each write replaces the layers of the jobs and leaves the other one
    layers.write_export_layer(exported.filter("part_id % 2 = 0"), targets, path)
    layers.write_export_layer(exported, targets, path)
    layers.write_export_layer(exported, targets, path)
    return layers.read_layers(t.spark, path).select("part_id", "x0", "y0", "resolution_degree", "resolution_meter", "package", "layer")


# --- streams ------------------------------------------------------------------------------------


def _feature_stream(t: Tables) -> DataFrame:
    """Features written once and read back file by file."""
    path = new_folder(t.spark, "features")
    columns = [c for c in t.features.columns if c not in ("geometry", "type")]
    staged = t.features.select(*columns)
    staged.write.parquet(path)
    return t.spark.readStream.schema(staged.schema).option("maxFilesPerTrigger", 4).parquet(path)


@query("validate_stream", over_checked(f"select {ERROR_COLUMNS} from ({FEATURE_ERRORS_SQL}) e"))
def _validate_stream(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "stream-errors")
    live_validation.validate_stream(_feature_stream(t), path, new_folder(t.spark, "checkpoint")).awaitTermination()
    return t.spark.read.parquet(path).selectExpr(*ERROR_COLUMNS.split(", "))


@query("running_counts_stream", over_checked("""select job_id, count(*) as features, count(*) filter (where skipped) as vertices,
    count(*) filter (where issues <> '') as metadata from checked group by job_id"""))
def _running_counts_stream(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "stream-counts")
    live_validation.running_counts_stream(_feature_stream(t), path, new_folder(t.spark, "checkpoint")).awaitTermination()
    return live_validation.latest_counts(t.spark.read.parquet(path))


START = 1_704_067_200_000_000  # 2024-01-01, in microseconds; a watermark begins at 1970


@query("counted_jobs_stream", over_checked("""select job_id, count(*) as features, count(*) filter (where skipped) as vertices,
    count(*) filter (where issues <> '') as metadata from checked group by job_id"""))
def _counted_jobs_stream(t: Tables) -> DataFrame:
    """Every job gets its verdict at some time of the stream; what comes after it is a further life."""
    path, staged, ends = (new_folder(t.spark, x) for x in ("stream-counts", "features", "ends"))
    timed = t.features.drop("geometry", "type").withColumn("ts", F.timestamp_micros(START + F.col("ordinal") * 1_000_000))
    # row groups small enough that the four files of a batch keep more than four cores busy
    timed.write.option("parquet.block.size", 16 << 20).parquet(staged)
    t.jobs.select("job_id", F.timestamp_micros(F.lit(START + 600_000_000)).alias("ts")).write.parquet(ends)
    features = t.spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", 4).parquet(staged)
    verdicts = t.spark.readStream.schema("job_id bigint, ts timestamp").parquet(ends)
    counted = live_validation.counted_jobs(features, verdicts, "1 hour", 3600, parts=4)
    live_validation.counted_jobs_stream(counted, path, new_folder(t.spark, "checkpoint")).awaitTermination()
    return live_validation.ended_counts(t.spark.read.parquet(path)).drop("ended")


def _event_stream(t: Tables) -> DataFrame:
    from layerlint.plans.views import TASK_EVENTS

    schema = t.table("events").schema
    return t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/events.parque[t]").selectExpr(*TASK_EVENTS)


CLOSED = "(select max(ts) - interval '10 minutes' from task_events)"


@query("task_metrics_stream", with_views("task_events", f"""select epoch_us(time_bucket(interval '1 hour', ts)) as window_micros, count(*) as processed,
    round(count(*) filter (where status = 'Completed') * 100.0 / count(*), 6) as success_rate,
    round(count(*) filter (where status = 'Failed') * 100.0 / count(*), 6) as failure_rate, round(count(*) / 3600.0, 9) as throughput,
    round(sum(duration_s) / count(duration_s), 6) as avg_duration from task_events group by time_bucket(interval '1 hour', ts)
    having time_bucket(interval '1 hour', ts) + interval '1 hour' <= {CLOSED}"""))
def _task_metrics_stream(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "stream-metrics")
    windows = live_metrics.live_status_rates(_event_stream(t), "10 minutes", "1 hour")
    live_metrics.store_closed_windows(windows, path, new_folder(t.spark, "checkpoint")).awaitTermination()
    found = t.spark.read.parquet(path).withColumn("window_micros", F.unix_micros("window_start")).drop("window_start")
    digits = {"success_rate": 6, "failure_rate": 6, "throughput": 9, "avg_duration": 6}
    return found.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("pod_rates_stream", with_views("task_events", f"""+slots as (select pod, status, time_bucket(interval '1 minute', ts) - unnest(generate_series(0, 4)) * interval '1 minute' as start
    from task_events)
    select epoch_us(start) as window_micros, pod, round(count(*) filter (where status = 'Completed') / 300.0, 9) as success_per_second,
      round(count(*) filter (where status = 'Failed') / 300.0, 9) as failure_per_second from slots group by start, pod
    having start + interval '5 minutes' <= {CLOSED}"""))
def _pod_rates_stream(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "stream-pods")
    windows = live_metrics.live_pod_rates(_event_stream(t))
    live_metrics.store_closed_windows(windows, path, new_folder(t.spark, "checkpoint")).awaitTermination()
    found = t.spark.read.parquet(path).withColumn("window_micros", F.unix_micros("window_start")).drop("window_start")
    return found.withColumns({c: F.round(c, 9) for c in ("success_per_second", "failure_per_second")})


@query("task_counters_stream", with_views("task_events", f"""select epoch_us(time_bucket(interval '5 minutes', ts)) as window_micros, job_type, task_type, pod, count(*) as processed,
    count(*) filter (where status = 'Completed') as success, count(*) filter (where status = 'Failed') as failure from task_events
    group by time_bucket(interval '5 minutes', ts), job_type, task_type, pod having time_bucket(interval '5 minutes', ts) + interval '5 minutes' <= {CLOSED}"""))
def _task_counters_stream(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "stream-counters")
    live_metrics.store_closed_windows(live_metrics.live_task_counters(_event_stream(t)), path, new_folder(t.spark, "checkpoint")).awaitTermination()
    return t.spark.read.parquet(path).withColumn("window_micros", F.unix_micros("window_start")).drop("window_start")
