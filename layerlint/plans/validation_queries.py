"""Queries over checker results, the error table, reports, verdicts and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerlint import constants as K
from layerlint.operators import chunks, errors, verdict
from layerlint.operators.schema import valid_features
from layerlint.operators.mapping import map_part_properties
from layerlint.plans.attribute_queries import (
    CHECKED, COLUMN_SQL, ERROR_COLUMNS, FEATURE_ERRORS_SQL, LIMIT, MESSAGE_SQL, TYPE_SQL, over_checked,
)
from layerlint.plans.query import query
from layerlint.plans.views import Tables, with_views

# --- SQL fragments ------------------------------------------------------------------------------

LOOKUP_SQL = """select job_id, chunk_id, feature_key as id, max(ordinal) as feature_ordinal from checked where not skipped group by 1, 2, 3"""
MATCHED = f"""{CHECKED}, lookup as materialized ({LOOKUP_SQL}),
  matched as materialized (select e.*, feature_ordinal from part_errors e join lookup l on e.job_id = l.job_id and e.chunk_id = l.chunk_id and e.id = l.id)"""
CHECKER_ERRORS_SQL = f"""select job_id, chunk_id, id, 2 as phase, cast(0 as bigint) as ordinal, item, {TYPE_SQL} as type, {COLUMN_SQL} as column_name,
  {MESSAGE_SQL} as message, feature_ordinal, is_exceeded from matched"""
ERRORS = f"{MATCHED}, errors as materialized ({FEATURE_ERRORS_SQL} union all {CHECKER_ERRORS_SQL})"
COUNTS_SQL = ", ".join(f"count(*) filter (where type = '{t}') as \"{c}\"" for t, _, c in K.ERROR_TYPES)
# Per-chunk counters, holes of chunks with checker items, and the closed form of the small-holes share per job.
CHUNKS = f"""{ERRORS},
  totals as materialized (select job_id, count(*) as total from features group by job_id),
  chunk_list as materialized (select job_id, chunk_id, count(*) as features from features group by 1, 2),
  reported as materialized (select h.* from chunk_holes h where exists (select 1 from part_errors p where p.job_id = h.job_id and p.chunk_id = h.chunk_id)),
  last_hole as materialized (select job_id, max(chunk_id) as last_chunk from reported where small_holes_count > 0 group by job_id),
  hole_sums as materialized (select job_id, cast(sum(small_holes_count) as bigint) as holes from reported group by job_id),
  counts as materialized (
    select t.job_id, t.total as features, {', '.join(f'coalesce(max(c."{c}"), 0) as "{c}"' for c in K.COUNTERS)},
      coalesce(max(hs.holes), 0) as holes, coalesce(max(c.res), false) as resolution_exceeded,
      max(case when l.last_chunk is not null then coalesce(b.basis, 0) end) as basis
    from totals t
    left join (select job_id, {COUNTS_SQL}, coalesce(bool_or(type = 'Resolution' and is_exceeded), false) as res from errors group by job_id) c on c.job_id = t.job_id
    left join hole_sums hs on hs.job_id = t.job_id
    left join last_hole l on l.job_id = t.job_id
    left join (select e.job_id, count(*) filter (where type = 'Small_Holes') as basis from errors e join last_hole h on e.job_id = h.job_id
               where e.chunk_id <= h.last_chunk group by e.job_id) b on b.job_id = t.job_id
    group by t.job_id, t.total),
  limits as materialized (select *, round("smallGeometries" * 100.0 / features, 2) > 5 as small_geometries_exceeded,
    coalesce(round(basis * 100.0 / features, 2) > 5, false) as small_holes_exceeded from counts),
  verdicts as materialized (select *, ("vertices" > 0 or "metadata" > 0 or "geometryValidity" > 0 or "resolution" > 0 or "unknown" > 0
    or small_geometries_exceeded or small_holes_exceeded) as has_critical_errors from limits)"""
VIEWS = "features part_errors chunk_holes"
WIDE_SQL = """select job_id, chunk_id, id, first(feature_ordinal order by phase, ordinal, item) as feature_ordinal,
    {cells},
    case when last(feature_ordinal order by phase, ordinal, item) filter (where type = 'Resolution') = first(feature_ordinal order by phase, ordinal, item)
      then case when coalesce(last(is_exceeded order by phase, ordinal, item) filter (where type = 'Resolution'), false) then 'true' else 'false' end end as res_exceed
    from errors group by job_id, chunk_id, id""".format(cells=", ".join(
        f"string_agg(message, '; ' order by phase, ordinal, item) filter (where type = '{t}') as {c}" for t, c, _ in K.ERROR_TYPES))


def over(body: str, base: str = ERRORS, names: str = VIEWS, recursive: bool = False) -> str:
    return with_views(names, f"{base} {body}", recursive)


def _errors(t: Tables) -> DataFrame:
    t = t.stored
    return errors.all_errors(t.features, t.part_errors)


def _chunks(t: Tables) -> DataFrame:
    t = t.stored
    return verdict.chunk_counts(t.features, t.part_errors, t.chunk_holes)


def _verdicts(t: Tables) -> DataFrame:
    t = t.stored
    return verdict.job_verdicts(t.features, t.part_errors, t.chunk_holes)


# --- checker results ----------------------------------------------------------------------------


@query("attach_results", over("select job_id, chunk_id, id, item, code, feature_ordinal from matched", MATCHED))
def _attach_results(t: Tables) -> DataFrame:
    return errors.attach_results(t.stored.part_errors, t.stored.features).select("job_id", "chunk_id", "id", "item", "code", "feature_ordinal")


@query("unmatched_results", over("""select job_id, chunk_id, id, item, code from part_errors e where not exists
    (select 1 from lookup l where e.job_id = l.job_id and e.chunk_id = l.chunk_id and e.id = l.id)""", MATCHED))
def _unmatched_results(t: Tables) -> DataFrame:
    return errors.unmatched_results(t.stored.part_errors, t.stored.features).select("job_id", "chunk_id", "id", "item", "code")


@query("dedupe_by_id", over_checked("""select job_id, chunk_id, feature_key as id, min(ordinal) as first_ordinal,
    max(ordinal) filter (where not skipped) as last_ordinal from checked group by 1, 2, 3"""))
def _dedupe_by_id(t: Tables) -> DataFrame:
    return errors.dedupe_by_id(t.features)


@query("explode_errors", with_views("part_errors", """select job_id, chunk_id, cast(row_number() over (partition by job_id, chunk_id order by item) - 1 as integer) as part,
    0 as item, id, code, is_exceeded from part_errors"""))
def _explode_errors(t: Tables) -> DataFrame:
    nested = errors.nest_errors(t.stored.part_errors, t.stored.chunk_holes)
    return errors.explode_errors(nested)


@query("all_errors", over(f"select {ERROR_COLUMNS}, feature_ordinal, is_exceeded from errors"))
def _all_errors(t: Tables) -> DataFrame:
    return _errors(t).selectExpr(*ERROR_COLUMNS.split(", "), "feature_ordinal", "is_exceeded")


@query("error_counts", over(f"select job_id, {COUNTS_SQL} from errors group by job_id"))
def _error_counts(t: Tables) -> DataFrame:
    return verdict.error_counts(_errors(t))


@query("errors_by_feature", over(WIDE_SQL))
def _errors_by_feature(t: Tables) -> DataFrame:
    return errors.errors_by_feature(_errors(t))


@query("res_exceed", over(f"select job_id, chunk_id, id, res_exceed from ({WIDE_SQL}) w where res_exceed is not null"))
def _res_exceed(t: Tables) -> DataFrame:
    wide = errors.errors_by_feature(_errors(t))
    return wide.filter("res_exceed is not null").select("job_id", "chunk_id", "id", "res_exceed")


REPORT_SQL = f"""select w.job_id, w.chunk_id, w.id as error_id, w.feature_ordinal, e_vertices, e_metadata, e_validity, e_res, e_sm_geom, e_sm_holes,
    e_unknown, res_exceed, f.source_name, f.update_date from ({WIDE_SQL}) w join features f on f.job_id = w.job_id and f.ordinal = w.feature_ordinal"""
REPORT_COLUMNS = ["job_id", "chunk_id", "error_id", "feature_ordinal", *K.REPORT_COLUMNS, "res_exceed", "source_name", "update_date"]


@query("report_rows", over(REPORT_SQL))
def _report_rows(t: Tables) -> DataFrame:
    return errors.report_rows(t.stored.features, _errors(t)).select(*REPORT_COLUMNS)


# --- verdict and summary ------------------------------------------------------------------------


@query("feature_verdicts", over_checked("""select job_id, count(*) as features, count(*) filter (where skipped) as vertices,
    count(*) filter (where issues <> '') as metadata, not (bool_or(skipped) or bool_or(issues <> '')) as is_valid from checked group by job_id"""))
def _feature_verdicts(t: Tables) -> DataFrame:
    return verdict.feature_verdicts(t.unnumbered)


@query("small_geometries_exceeded", over('select job_id, "smallGeometries", features, small_geometries_exceeded from verdicts', CHUNKS))
def _small_geometries_exceeded(t: Tables) -> DataFrame:
    return _verdicts(t).select("job_id", "smallGeometries", "features", "small_geometries_exceeded")


@query("small_holes", over('select job_id, "smallHoles", holes, small_holes_exceeded from verdicts', CHUNKS))
def _small_holes(t: Tables) -> DataFrame:
    return _verdicts(t).select("job_id", "smallHoles", "holes", "small_holes_exceeded")


@query("resolution_exceeded", over("select job_id, resolution, resolution_exceeded from verdicts", CHUNKS))
def _resolution_exceeded(t: Tables) -> DataFrame:
    return _verdicts(t).select("job_id", "resolution", "resolution_exceeded")


VERDICT_COLUMNS = ", ".join(["job_id", *(f'"{c}"' for c in K.COUNTERS), "holes", "small_geometries_exceeded", "small_holes_exceeded",
                             "resolution_exceeded", "has_critical_errors"])


@query("verdict", over(f"select {VERDICT_COLUMNS}, not has_critical_errors as is_valid from verdicts", CHUNKS))
def job_verdicts(t: Tables) -> DataFrame:
    return _verdicts(t).select("job_id", *K.COUNTERS, "holes", "small_geometries_exceeded", "small_holes_exceeded", "resolution_exceeded",
                               "has_critical_errors", "is_valid")


@query("has_errors", over("select s.job_id, exists (select 1 from errors e where e.job_id = s.job_id) as has_errors from jobs s", names=f"{VIEWS} jobs"))
def _has_errors(t: Tables) -> DataFrame:
    return verdict.has_errors(t.jobs, _errors(t))


SUMMARY_COUNTS_SQL = ", ".join(f'"{c}"' for c in K.COUNTERS)


@query("errors_summary", over(f"""select job_id, {SUMMARY_COUNTS_SQL}, small_geometries_exceeded as geometries_failed, small_holes_exceeded as holes_failed,
    holes as holes_count, resolution_exceeded as resolution_failed from verdicts""", CHUNKS))
def _errors_summary(t: Tables) -> DataFrame:
    s = F.col("summary")
    return verdict.errors_summary(_verdicts(t)).select(
        "job_id", *[s["errorsCount"][c].alias(c) for c in K.COUNTERS], s["thresholds"]["smallGeometries"]["exceeded"].alias("geometries_failed"),
        s["thresholds"]["smallHoles"]["exceeded"].alias("holes_failed"), s["thresholds"]["smallHoles"]["count"].alias("holes_count"),
        s["thresholds"]["resolution"]["exceeded"].alias("resolution_failed"),
    )


def _threshold_sql(column: str) -> str:
    return f"case when {column} then 'Failed' else 'Passed' end"


KEYWORD_VALUES = [(K.COUNT_LABELS[c], f'cast("{c}" as varchar)') for c in K.SUMMARY_COUNTERS] + [
    (label, _threshold_sql(column)) for (_, label), column in
    zip(K.THRESHOLD_LABELS, ["small_geometries_exceeded", "small_holes_exceeded", "resolution_exceeded"])
]


@query("summary_keywords", over(" union all ".join(
    f"select job_id, {i} as position, '{label}' as label, {value} as value from verdicts" for i, (label, value) in enumerate(KEYWORD_VALUES)), CHUNKS))
def _summary_keywords(t: Tables) -> DataFrame:
    return verdict.summary_keywords(verdict.errors_summary(_verdicts(t)))


def _element(name: str, value: str) -> str:
    return f"'    <{name}>', {value}, '</{name}>\n'"


DOCUMENT_SQL = "concat('<?xml version=\"1.0\" encoding=\"UTF-8\"?>\n<qgis>\n', " + ", ".join([
    _element("identifier", "cast(j.task_id as varchar)"), _element("parentidentifier", "cast(v.job_id as varchar)"),
    _element("type", "j.job_type"), _element("title", "concat(lower(concat(resource_id, '_', product_type)), '_v', version)"),
    _element("abstract", f"'{K.SUMMARY_ABSTRACT}'"),
    *[f"'    <keywords vocabulary=\"{label}\">\n        <keyword>', {value}, '</keyword>\n    </keywords>\n'" for label, value in KEYWORD_VALUES],
]) + ", '</qgis>')"


@query("summary_document", over(f"select v.job_id, {DOCUMENT_SQL} as document from verdicts v join jobs j on v.job_id = j.job_id", CHUNKS, f"{VIEWS} jobs"))
def _summary_document(t: Tables) -> DataFrame:
    from layerlint.functions.text import report_title

    jobs = t.jobs.select("job_id", "task_id", "job_type", report_title(F.col("resource_id"), F.col("product_type"), F.col("version")).alias("title"))
    return verdict.summary_document(verdict.errors_summary(_verdicts(t)), jobs)


RUNNING = f"""{CHUNKS},
  steps as materialized (
    select c.job_id, c.chunk_id, total, {', '.join(f'coalesce(e."{c}", 0) as "{c}"' for c in K.COUNTERS)}, coalesce(r.small_holes_count, 0) as holes,
      coalesce(e.res, false) as res
    from chunk_list c join totals t on t.job_id = c.job_id
    left join (select job_id, chunk_id, {COUNTS_SQL}, coalesce(bool_or(type = 'Resolution' and is_exceeded), false) as res from errors group by 1, 2) e
      on e.job_id = c.job_id and e.chunk_id = c.chunk_id
    left join reported r on r.job_id = c.job_id and r.chunk_id = c.chunk_id),
  so_far as materialized (select job_id, chunk_id, total, holes as step_holes, {', '.join(f'cast(sum("{c}") over w as bigint) as "{c}"' for c in K.COUNTERS)},
    cast(sum(holes) over w as bigint) as holes, bool_or(res) over w as resolution_exceeded from steps
    window w as (partition by job_id order by chunk_id rows unbounded preceding)),
  based as materialized (select *, max(case when step_holes > 0 then "smallHoles" end) over (partition by job_id order by chunk_id rows unbounded preceding) as basis
    from so_far)"""


@query("running_summary", over(f"""select job_id, chunk_id, {SUMMARY_COUNTS_SQL}, holes, round("smallGeometries" * 100.0 / total, 2) > 5 as small_geometries_exceeded,
    coalesce(round(basis * 100.0 / total, 2) > 5, false) as small_holes_exceeded, resolution_exceeded from based""", RUNNING))
def _running_summary(t: Tables) -> DataFrame:
    return verdict.running_summary(_chunks(t), verdict.feature_stats(t.unnumbered))


# --- chunks -------------------------------------------------------------------------------------


@query("feature_stats", with_views("features", """select job_id, count(*) as total_features, cast(sum(vertices) as bigint) as total_vertices
    from features group by job_id"""))
def _feature_stats(t: Tables) -> DataFrame:
    return verdict.feature_stats(t.unnumbered)


@query("empty_layers", """select c_custkey as job_id, 'layer has no features' as error from customer
    where not exists (select 1 from lineitem where l_suppkey = c_custkey)""")
def _empty_layers(t: Tables) -> DataFrame:
    jobs = t.table("customer").select(F.col("c_custkey").alias("job_id"))
    return verdict.empty_layers(jobs, t.table("lineitem").select(F.col("l_suppkey").alias("job_id")))


@query("assign_chunks", with_views("features", f"""+counted as materialized (select job_id, ordinal, case when vertices > {LIMIT} then 0 else vertices end as v from features),
  packed as (
    select job_id, ordinal, v as fill, cast(0 as bigint) as chunk_id from counted where ordinal = 0
    union all
    select c.job_id, c.ordinal, case when p.fill + c.v > {LIMIT} then c.v else p.fill + c.v end, case when p.fill + c.v > {LIMIT} then p.chunk_id + 1 else p.chunk_id end
    from packed p join counted c on c.job_id = p.job_id and c.ordinal = p.ordinal + 1)
  select job_id, ordinal, chunk_id from packed""", recursive=True))
def _assign_chunks(t: Tables) -> DataFrame:
    return chunks.assign_chunks(t.stored.numbered)


@query("chunk_stats", over_checked("""select job_id, chunk_id, count(*) filter (where not skipped) as features,
    cast(coalesce(sum(vertices) filter (where not skipped), 0) as bigint) as vertices, count(*) filter (where skipped) as skipped_features,
    cast(coalesce(sum(vertices) filter (where skipped), 0) as bigint) as skipped_vertices, bool_or(not skipped and issues = '') as should_validate
    from checked group by job_id, chunk_id"""))
def _chunk_stats(t: Tables) -> DataFrame:
    return chunks.chunk_stats(t.features)


@query("chunk_payload", over_checked("""select c.job_id, c.chunk_id, cast(count(*) as integer) as parts, any_value(job_type) as job_type,
    any_value(catalog_id) as catalog_id, any_value(version) as version, string_agg(id, ',' order by ordinal) as ids
    from checked c join jobs j on c.job_id = j.job_id where issues = '' and not skipped group by c.job_id, c.chunk_id""", "features jobs"))
def _chunk_payload(t: Tables) -> DataFrame:
    payloads = chunks.chunk_payload(map_part_properties(valid_features(t.features, readings=True), t.jobs), t.jobs)
    body = F.from_json(
        "payload", "jobType string, catalogId string, productVersion string, partsData array<struct<properties:struct<id:string>>>"
    )
    return payloads.withColumn("b", body).select(
        "job_id", "chunk_id", "parts", F.col("b.jobType").alias("job_type"), F.col("b.catalogId").alias("catalog_id"),
        F.col("b.productVersion").alias("version"), F.array_join("b.partsData.properties.id", ",").alias("ids"),
    )


@query("running_progress", with_views("features", """+per_chunk as (select job_id, chunk_id, count(*) as n from features group by 1, 2)
    select job_id, chunk_id, cast(sum(n) over w as bigint) as processed, cast(sum(n) over (partition by job_id) as bigint) as total_features,
      cast(floor(sum(n) over w * 100.0 / sum(n) over (partition by job_id) + 0.5) as integer) as percentage from per_chunk
    window w as (partition by job_id order by chunk_id rows unbounded preceding)"""))
def _running_progress(t: Tables) -> DataFrame:
    return chunks.running_progress(t.numbered)


STATE = ["s_suppkey as job_id", "case when s_nationkey % 3 = 0 then null else s_nationkey * 20 end as last_processed_feature"]


@query("resume_features", with_views("features", f"""+state as (select {', '.join(STATE)} from supplier where s_nationkey % 5 <> 0)
    select f.job_id, ordinal from features f left join state s on s.job_id = f.job_id where last_processed_feature is null or ordinal > last_processed_feature"""))
def _resume_features(t: Tables) -> DataFrame:
    state = t.table("supplier").filter("s_nationkey % 5 <> 0").selectExpr(*STATE)
    return chunks.resume_features(t.numbered.select("job_id", "ordinal"), state)
