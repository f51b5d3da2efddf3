"""Queries over attribute parsing, checks and mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerlint.functions.attributes import Attribute, from_typed
from layerlint.functions.geometry import count_vertices, polygon_from_envelope
from layerlint.functions.parsing import attribute_number, flexible_date, parse_csv_list
from layerlint.functions.resolution import resolution_meter, zoom_level
from layerlint.functions.rounding import progress_percentage
from layerlint.functions.text import build_url, entity_name, feature_id, format_issues, layer_name, report_title
from layerlint.operators import errors, export, mapping, schema
from layerlint.plans.query import query
from layerlint.plans.views import Tables, with_views
from pyspark.sql import types as T

LIMIT = 2500

# --- SQL fragments ------------------------------------------------------------------------------

DATE_SQL = (
    "case when regexp_full_match(update_date, '\\d{2}/\\d{2}/\\d{4}') then try_strptime(update_date, '%d/%m/%Y') "
    "else try_cast(update_date as timestamp) end"
)


def number_sql(column: str, label: str, low: str, high: str) -> str:
    n = f"try_cast({column} as double)"
    return (
        f"case when {n} is null then 'properties.{{name}}: {label} should be a number (code: invalid_type)' "
        f"when {n} < {low} then 'properties.{{name}}: {label} should not be less than {low} (code: too_small)' "
        f"when {n} > {high} then 'properties.{{name}}: {label} should not be larger than {high} (code: too_big)' end"
    )


SOURCE_RES_SQL = number_sql("source_res", "Source resolution meter", "0.0185", "78271.52").format(name="sourceRes")
EP90_SQL = number_sql("ep90", "Horizontal accuracy CE90", "0.01", "4000").format(name="ep90")
PUBLISH_RES_SQL = number_sql("publish_res", "Publish resolution meter", "0.0185", "78271.52").format(name="publishRes")
ISSUE_SQLS = [
    "case when id is null then 'properties.id: Expected string, received null (code: invalid_type)' end",
    f"case when {DATE_SQL} is null then 'properties.updateDate: Expected a valid date format (ISO 8601 or DD/MM/YYYY) (code: invalid_date)' end",
    SOURCE_RES_SQL, EP90_SQL, PUBLISH_RES_SQL,
    "case when source_name is null then 'properties.sourceName: Expected string, received null (code: invalid_type)' end",
]
ISSUES_SQL = f"concat_ws('; ', {', '.join(ISSUE_SQLS)})"
CHECKED = f"+checked as materialized (select *, {ISSUES_SQL} as issues, vertices > {LIMIT} as skipped, coalesce(id, 'UNKNOWN_ID') as feature_key from features)"


def over_checked(body: str, names: str = "features") -> str:
    return with_views(names, f"{CHECKED} {body}")


LIST_SQL = "list_filter(list_transform(string_split({c}, ','), lambda x: trim(x)), lambda x: x <> '')"
SENSORS_SQL = LIST_SQL.format(c="coalesce(sensors, '')")


def _string(column: str) -> Attribute:
    return from_typed(F.col(column), T.StringType())


def _issue_text(rules: list[schema.Rule]):
    """First broken rule of an attribute as text."""
    return F.coalesce(*[F.when(r.broken, F.concat(F.lit(f"{r.path}: "), r.message, F.lit(f" (code: {r.code})"))) for r in rules])


@query("parse_csv_list", with_views("features", f"""
    select job_id, ordinal, cast(len({SENSORS_SQL}) as integer) as items, array_to_string({SENSORS_SQL}, '|') as sensor_list from features"""))
def _parse_csv_list(t: Tables) -> DataFrame:
    parsed = parse_csv_list(F.col("sensors"))
    return t.numbered.select("job_id", "ordinal", F.size(parsed).alias("items"), F.array_join(parsed, "|").alias("sensor_list"))


@query("flexible_date", with_views("features", f"select job_id, ordinal, epoch_us({DATE_SQL}) as update_micros from features"))
def _flexible_date(t: Tables) -> DataFrame:
    return t.numbered.select("job_id", "ordinal", F.unix_micros(flexible_date(F.col("update_date"))).alias("update_micros"))


@query("coerce_number", with_views("features", f"""
    select job_id, ordinal, try_cast(publish_res as double) as publish_res_number, {SOURCE_RES_SQL} as source_res_issue,
      {EP90_SQL} as ep90_issue, {PUBLISH_RES_SQL} as publish_res_issue from features"""))
def _coerce_number(t: Tables) -> DataFrame:
    resolution = (0.0185, 78271.52)

    def issue(column: str, name: str, label: str, low: float, high: float):
        return _issue_text(schema.bounded_number(attribute_number(_string(column)), f"properties.{name}", label, low, high))

    return t.numbered.select(
        "job_id", "ordinal", attribute_number(_string("publish_res")).alias("publish_res_number"),
        issue("source_res", "sourceRes", "Source resolution meter", *resolution).alias("source_res_issue"),
        issue("ep90", "ep90", "Horizontal accuracy CE90", 0.01, 4000).alias("ep90_issue"),
        issue("publish_res", "publishRes", "Publish resolution meter", *resolution).alias("publish_res_issue"),
    )


SCALE = "case k % 5 when 0 then null when 1 then '0' when 2 then 'x1' when 3 then ' 2.5 ' else cast(k as string) end"


@query("optional_scale", with_views("features", f"""
    select job_id, ordinal, try_cast(trim({SCALE}) as double) as scale_number, case k % 5
      when 1 then 'properties.scale: Scale must be a positive number (code: too_small)'
      when 2 then 'properties.scale: Expected number, received nan (code: invalid_type)'
      when 4 then case when k < 1 then 'properties.scale: Scale must be a positive number (code: too_small)' end end as scale_issue
    from features"""))
def _optional_scale(t: Tables) -> DataFrame:
    scale = _string("scale")
    return t.numbered.withColumn("scale", F.expr(SCALE)).select(
        "job_id", "ordinal", F.when(~scale.is_a("null"), attribute_number(scale)).alias("scale_number"),
        _issue_text(schema.optional_scale(scale, attribute_number(scale), "properties.scale")).alias("scale_issue"),
    )


@query("required_string", with_views("features", f"select job_id, ordinal, {ISSUE_SQLS[0]} as id_issue, {ISSUE_SQLS[-1]} as source_name_issue, "
                                                 "cast(null as varchar) as source_id_issue from features"))
def _required_string(t: Tables) -> DataFrame:
    return t.numbered.select(
        "job_id", "ordinal",
        _issue_text(schema.required_string(_string("id"), "properties.id")).alias("id_issue"),
        _issue_text(schema.required_string(_string("source_name"), "properties.sourceName")).alias("source_name_issue"),
        _issue_text(schema.optional_string(_string("sensors"), "properties.sourceId")).alias("source_id_issue"),
    )


@query("feature_shape_issues", with_views("parts", """
    select part_id, concat_ws('; ',
      case when part_id % 17 = 0 then 'type: Invalid literal value, expected "Feature" (code: invalid_literal)' end,
      case when part_id % 23 = 0 then 'bbox: Invalid input (code: invalid_union)' end,
      case when part_id % 19 = 0 or part_id % 7 = 0 then 'geometry: Invalid input (code: invalid_union)' end) as issues from parts"""))
def _feature_shape_issues(t: Tables) -> DataFrame:
    k = F.col("part_id")
    corner = F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("x0"))
    box = polygon_from_envelope(corner, F.col("y0"), F.col("x1"), F.col("y1"))
    shaped = t.parts.select(
        "part_id", F.when(k % 17 == 0, "Thing").otherwise("Feature").alias("type"),
        F.when(k % 23 == 0, F.array("x0", "y0", "x1")).when(k % 2 == 0, F.array("x0", "y0", "x1", "y1")).alias("bbox"),
        box.withField("type", F.when(k % 19 == 0, "Point").when(k % 3 == 0, "MultiPolygon").otherwise("Polygon")).alias("geometry"),
    )
    return schema.feature_shape_issues(shaped).select("part_id", format_issues(F.col("issues")).alias("issues"))


@query("metadata_issues", over_checked("""select job_id, ordinal,
    cast(case when issues = '' then 0 else len(string_split(issues, '; ')) end as integer) as issue_count, issues like '%updateDate%' as bad_date from checked"""))
def _metadata_issues(t: Tables) -> DataFrame:
    return schema.metadata_issues(t.features).select(
        "job_id", "ordinal", F.size("issues").alias("issue_count"),
        F.exists("issues", lambda i: i["path"] == "properties.updateDate").alias("bad_date"),
    )


@query("format_issues", over_checked("select job_id, ordinal, issues from checked where issues <> ''"))
def _format_issues(t: Tables) -> DataFrame:
    checked = schema.metadata_issues(t.features)
    return checked.filter(F.size("issues") > 0).select("job_id", "ordinal", format_issues(F.col("issues")).alias("issues"))


@query("split_valid", over_checked("""
    select job_id, ordinal, id, 'part' as kind from checked where issues = '' and not skipped
    union all select job_id, ordinal, feature_key, 'Metadata' from checked where issues <> ''
    union all select job_id, ordinal, feature_key, 'Vertices' from checked where skipped"""))
def _split_valid(t: Tables) -> DataFrame:
    parts, found = mapping.split_valid(t.features, t.jobs)
    return parts.select("job_id", "ordinal", "id", F.lit("part").alias("kind")).unionByName(
        found.select("job_id", "ordinal", "id", F.col("type").alias("kind"))
    )


@query("map_part_properties", over_checked(f"""
    select f.job_id, chunk_id, ordinal, id, cast(null as varchar) as source_id, source_name, try_cast(ep90 as double) as ce90,
      epoch_us({DATE_SQL}) as begin_micros, epoch_us({DATE_SQL}) as end_micros, cast(source_res as double) as source_meter,
      78271.52 / power(2, job_id % 20) as meter, 0.703125 / power(2, job_id % 20) as degree, array_to_string({SENSORS_SQL}, '|') as sensor_list,
      cast(null as varchar) as description, 'c1|c2' as city_list, '' as country_list
    from checked f where issues = '' and not skipped"""))
def _map_part_properties(t: Tables) -> DataFrame:
    parts = mapping.map_part_properties(schema.valid_features(t.features), t.jobs)
    return parts.select(
        "job_id", "chunk_id", "ordinal", "id", F.col("sourceId").alias("source_id"), F.col("sourceName").alias("source_name"),
        F.col("horizontalAccuracyCE90").alias("ce90"), F.unix_micros("imagingTimeBeginUTC").alias("begin_micros"),
        F.unix_micros("imagingTimeEndUTC").alias("end_micros"), F.col("sourceResolutionMeter").alias("source_meter"),
        F.col("resolutionMeter").alias("meter"), F.col("resolutionDegree").alias("degree"),
        F.array_join("sensors", "|").alias("sensor_list"), "description", F.array_join("cities", "|").alias("city_list"),
        F.array_join("countries", "|").alias("country_list"),
    )


@query("feature_id", with_views("features", "select job_id, ordinal, coalesce(id, 'UNKNOWN_ID') as feature_key from features"))
def _feature_id(t: Tables) -> DataFrame:
    return t.numbered.select("job_id", "ordinal", feature_id(_string("id")).alias("feature_key"))


@query("count_vertices", with_views("parts", "select part_id, cast(case when part_id % 3 = 0 then 10 else 5 end as integer) as vertices, "
                                             "true as polygonal from parts"))
def _count_vertices(t: Tables) -> DataFrame:
    box = polygon_from_envelope(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    twice = box.withField("type", F.lit("MultiPolygon")).withField("coordinates", F.concat(box["coordinates"], box["coordinates"]))
    shaped = t.parts.select("part_id", F.when(F.col("part_id") % 3 == 0, twice).otherwise(box).alias("geometry"))
    return shaped.select("part_id", count_vertices(F.col("geometry")).alias("vertices"), schema.is_polygonal(F.col("geometry")).alias("polygonal"))


@query("split_over_limit", with_views("features", f"select job_id, ordinal, vertices from features where vertices > {LIMIT}"))
def _split_over_limit(t: Tables) -> DataFrame:
    return schema.split_over_limit(t.features)[1].select("job_id", "ordinal", "vertices")


FEATURE_ERRORS_SQL = f"""
    select job_id, chunk_id, feature_key as id, case when skipped then 0 else 1 end as phase, ordinal, cast(0 as bigint) as item,
      'Metadata' as type, 'e_metadata' as column_name, issues as message, ordinal as feature_ordinal, cast(null as boolean) as is_exceeded
    from checked where issues <> ''
    union all select job_id, chunk_id, feature_key, 0, ordinal, 1, 'Vertices', 'e_vertices',
      concat('result:', cast(vertices as varchar), ', limit: {LIMIT}'), ordinal, null from checked where skipped"""
ERROR_COLUMNS = "job_id, chunk_id, id, phase, ordinal, item, type, column_name, message"


@query("metadata_errors", over_checked(f"select {ERROR_COLUMNS} from ({FEATURE_ERRORS_SQL}) e where phase = 1"))
def _metadata_errors(t: Tables) -> DataFrame:
    return schema.metadata_errors(t.features).selectExpr(*ERROR_COLUMNS.split(", "))


@query("vertices_errors", over_checked(f"select {ERROR_COLUMNS} from ({FEATURE_ERRORS_SQL}) e where phase = 0"))
def _vertices_errors(t: Tables) -> DataFrame:
    return schema.vertices_errors(t.features).selectExpr(*ERROR_COLUMNS.split(", "))


METER_SQL = "78271.52 / power(2, cast(round(log2(0.703125 / {c})) as integer))"


@query("resolution_meter", with_views("parts", f"""
    select part_id, cast(round(log2(0.703125 / resolution_degree)) as integer) as zoom, {METER_SQL.format(c='resolution_degree')} as meter from parts"""))
def _resolution_meter(t: Tables) -> DataFrame:
    degree = F.col("resolution_degree")
    return t.parts.select("part_id", zoom_level(degree).alias("zoom"), resolution_meter(degree).alias("meter"))


CODE_SQL = """case code when 'Geometry_Validity' then '{0}' when 'Resolution' then '{1}' when 'Small_Geometry' then '{2}' when 'Small_Holes' then '{3}'
    when 'Unknown' then '{4}' else {5} end"""
MESSAGE_SQL = CODE_SQL.format("Invalid Geometry", "Resolution Conflict", "Small geometry error", "Contains small holes", "Unknown error", "code")
TYPE_SQL = CODE_SQL.format("Geometry_Validity", "Resolution", "Small_Geometry", "Small_Holes", "Unknown", "'Unknown'")
COLUMN_SQL = CODE_SQL.format("e_validity", "e_res", "e_sm_geom", "e_sm_holes", "e_unknown", "'e_unknown'")
COUNTER_SQL = CODE_SQL.format("geometryValidity", "resolution", "smallGeometries", "smallHoles", "unknown", "'unknown'")


@query("map_error_code", with_views("part_errors", f"""
    select job_id, item, {TYPE_SQL} as type, {COLUMN_SQL} as column_name, {COUNTER_SQL} as counter, {MESSAGE_SQL} as message from part_errors"""))
def _map_error_code(t: Tables) -> DataFrame:
    return t.part_errors.select("job_id", "item", errors.map_error_code(F.col("code")).alias("m")).select("job_id", "item", "m.*")


@query("progress_percentage", """select o_orderkey, cast(floor(o_totalprice / 5000.0 + 0.5) as integer) as percentage from orders""")
def _progress_percentage(t: Tables) -> DataFrame:
    return t.table("orders").select("o_orderkey", progress_percentage(F.col("o_totalprice") / 5000.0).alias("percentage"))


@query("entity_names", with_views("jobs", """
    select job_id, lower(concat(resource_id, '_', product_type)) as entity, concat(resource_id, '-', product_type, '_features') as layer,
      concat(lower(concat(resource_id, '_', product_type)), '_v', version) as title from jobs"""))
def _entity_names(t: Tables) -> DataFrame:
    resource, product = F.col("resource_id"), F.col("product_type")
    return t.jobs.select(
        "job_id", entity_name(resource, product).alias("entity"), layer_name(resource, product).alias("layer"),
        report_title(resource, product, F.col("version")).alias("title"),
    )


@query("build_url", """select page_id, concat(rtrim(regexp_extract(url, '^([^?#]*)', 1), '/'), '/downloads/', cast(page_id as varchar)) as link from pages""")
def _build_url(t: Tables) -> DataFrame:
    base = F.regexp_extract("url", "^([^?#]*)", 1)
    return t.table("pages").select("page_id", build_url(base, F.concat(F.lit("/downloads//"), F.col("page_id").cast("string"))).alias("link"))


@query("roi_feature_ids", "select c_custkey, sha256(concat(cast(c_custkey as varchar), '|', cast(c_nationkey as varchar))) as roi_id from customer")
def _roi_feature_ids(t: Tables) -> DataFrame:
    regions = t.table("customer").select("c_custkey", "c_nationkey", F.lit("old").alias("roi_id"))
    return export.roi_feature_ids(regions, keys=("c_custkey", "c_nationkey")).select("c_custkey", "roi_id")


@query("feature_resolutions", with_views("features jobs", f"""
    select f.job_id, ordinal, ingestion_resolution as degree, {METER_SQL.format(c='ingestion_resolution')} as meter
    from features f join jobs j on f.job_id = j.job_id"""))
def _feature_resolutions(t: Tables) -> DataFrame:
    joined = mapping.feature_resolutions(t.numbered.select("job_id", "ordinal"), t.jobs)
    return joined.select("job_id", "ordinal", F.col("resolutionDegree").alias("degree"), F.col("resolutionMeter").alias("meter"))
