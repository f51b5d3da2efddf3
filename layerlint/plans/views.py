"""Views over the given tables that stand in for uploaded layers, checker output, task events, parts and regions.

Each view is one list of SQL expressions, used by Spark here and by the SQL each query is compared with.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerlint.functions.geometry import polygon_from_envelope
from layerlint.operators.prefix import number_rows
from layerlint.session import prepare, spread, written

FEATURE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag",
    "l_linestatus",
]
# Orders per block when the features of a job are numbered, as a power of two.
ORDER_BLOCK_BITS = 20

# k decides the faults of a feature. Of ten jobs one has no fault, one small geometries only, one small holes only, and one a
# few of both; one has nothing but features over the vertex limit, and the others have faults of all kinds.
SOUND = "l_suppkey % 10 between 1 and 4"
FAULTS = """case l_suppkey % 10 when 1 then 7 when 2 then 61 when 3 then 62
    when 4 then case (l_orderkey + l_linenumber) % 40 when 0 then 61 when 1 then 62 else 7 end else l_partkey end"""

FEATURES = [
    "l_suppkey as job_id",
    "cast(ordinal as bigint) as ordinal",
    "cast(floor(ordinal / 50) as int) as chunk_id",
    "k",
    "case when k % 97 = 0 then null else concat('F', cast(l_orderkey as string)) end as id",
    f"cast(l_quantity as int) * case when {SOUND} then 1 when l_suppkey % 10 = 6 then 2501 else 60 end as vertices",
    "case when k % 53 = 0 then null else concat('src', cast(k % 10 as string)) end as source_name",
    """case when k % 41 = 0 then 'not a date'
       when k % 3 = 0 then concat(lpad(cast(day(l_shipdate) as string), 2, '0'), '/', lpad(cast(month(l_shipdate) as string), 2, '0'), '/', cast(year(l_shipdate) as string))
       else concat(cast(year(l_shipdate) as string), '-', lpad(cast(month(l_shipdate) as string), 2, '0'), '-', lpad(cast(day(l_shipdate) as string), 2, '0')) end as update_date""",
    "case when k % 11 = 0 then '' when k % 13 = 0 then null else concat(l_returnflag, ' , ', l_linestatus, ',,') end as sensors",
    f"case when {SOUND} then '3' else cast(cast(floor(l_extendedprice / 25) as bigint) as string) end as ep90",
    f"case when {SOUND} then '2' else cast(cast(round(l_discount * 100) as bigint) as string) end as source_res",
    "case when k % 29 = 0 then 'abc' else cast(cast(round(l_tax * 100) as bigint) + 1 as string) end as publish_res",
]

PART_ERRORS = [
    "job_id", "chunk_id", "ordinal as item",
    "case when k % 60 = 6 then 'GHOST' else coalesce(id, 'UNKNOWN_ID') end as id",
    """case k % 60 when 0 then 'Geometry_Validity' when 1 then 'Small_Geometry' when 2 then 'Small_Holes'
       when 3 then 'Resolution' when 4 then 'Unknown' when 5 then 'NotListed' else 'Geometry_Validity' end as code""",
    "case when k % 60 = 3 then k % 2 = 1 and chunk_id % 2 = 0 end as is_exceeded",
]

HOLES = "sum(case when chunk_id % 4 = 3 then 0 when k % 60 = 2 then 1 + k % 7 else 0 end)"

TASK_EVENTS = [
    "event_id as task_id", "ts", "user_id % 3 as pod", "event_id % 6 as attempts",
    """case user_id % 5 when 0 then 'Ingestion_New' when 1 then 'Ingestion_Update' when 2 then 'Ingestion_Swap_Update'
       when 3 then 'Export' else 'Bogus' end as job_type""",
    "case event_type when 'signup' then 'polygon-parts' when 'view' then 'unconfigured' else 'validation' end as task_type",
    "case when event_type = 'error' then 'Failed' else 'Completed' end as status",
    """case when event_type <> 'error' then null when event_id % 3 = 0 then 'ShapefileNotFoundError'
       when event_id % 3 = 1 then 'ReachedMaxTaskAttemptsError' else 'Error' end as error_type""",
    "value as duration_s", "props",
]

PARTS = [
    "p_partkey % 20 as job_id", "p_partkey as part_id", "cast(p_partkey % 340 - 170 as double) as x0", "cast(p_size * 2 - 60 as double) as y0",
    "cast(p_partkey % 340 - 169 + p_size % 5 as double) as x1", "cast(p_size * 2 - 59 + p_partkey % 3 as double) as y1",
    "cast(0.703125 as double) / power(2, p_size % 23) as resolution_degree",
]

# Regions of 20 jobs, numbered alike in each: wide ones, strips, small ones, and some that cross the antimeridian.
_WIDTH = "case s_suppkey % 4 when 0 then 20.0 when 1 then 100.0 when 2 then 0.5 else 45.0 end"
_HEIGHT = "case s_suppkey % 4 when 0 then 40.0 when 1 then 0.001 when 2 then 0.5 else 10.0 end"
_EAST = f"(s_suppkey * 13) % 340 - 170 + {_WIDTH}"
ROI = [
    "s_suppkey % 20 as job_id", "cast(floor(s_suppkey / 20) as int) as ordinal", "cast((s_suppkey * 13) % 340 - 170 as double) as x0",
    "cast((s_suppkey * 3) % 100 - 50 as double) as y0", f"cast(case when {_EAST} > 180 then {_EAST} - 360 else {_EAST} end as double) as x1",
    f"cast((s_suppkey * 3) % 100 - 50 + {_HEIGHT} as double) as y1", "cast(0.703125 as double) / power(2, s_suppkey % 15) as max_resolution_deg",
]

JOBS = [
    "s_suppkey as job_id", "concat('layer_', cast(s_suppkey as string)) as resource_id",
    "case when s_nationkey % 2 = 0 then 'Orthophoto' else 'OrthophotoHistory' end as product_type",
    "concat(cast(s_nationkey as string), '.0') as version",
    "case s_suppkey % 3 when 0 then 'Ingestion_New' when 1 then 'Ingestion_Update' else 'Ingestion_Swap_Update' end as job_type",
    "concat('catalog-', cast(s_suppkey as string)) as catalog_id", "s_suppkey * 10 as task_id",
    "cast(0.703125 as double) / power(2, s_suppkey % 20) as ingestion_resolution",
]

# Times in milliseconds, of chunks and of whole layers.
CHUNK_TIMES = [
    "job_id", "chunk_id", "count(*) as features", "sum(vertices) % 20011 as read_ms", "sum(k) % 50021 as process_ms",
    "sum(vertices) % 20011 + sum(k) % 50021 as total_ms",
]
FILE_TIMES = [
    "job_id", "count(*) as features", "sum(vertices) % 500009 as read_ms", "sum(k) % 3000017 as process_ms",
    "sum(vertices) % 500009 + sum(k) % 3000017 as total_ms",
]

_LAYER = "concat('layers/', regexp_extract(url, '/([a-z]{2})/', 1), '-', cast(cast(floor(page_id / 12) as bigint) as string))"
LISTING = [
    f"{_LAYER} as base",
    f"""concat({_LAYER}, case page_id % 7 when 0 then '.shp' when 1 then '.shx' when 2 then '.dbf' when 3 then '.prj'
       when 4 then '.cpg' when 5 then '.qmd' else '.shp' end) as path""",
]

_SQL = {
    "features": f"select {', '.join(FEATURES)} from (select *, {FAULTS} as k, row_number() over (partition by l_suppkey order by "
                f"{', '.join(FEATURE_ORDER)}) - 1 as ordinal from lineitem) t",
    "part_errors": f"select {', '.join(PART_ERRORS)} from features where k % 60 <= 6",
    "chunk_holes": f"select job_id, chunk_id, cast({HOLES} as bigint) as small_holes_count from features group by job_id, chunk_id",
    "task_events": f"select {', '.join(TASK_EVENTS)} from events",
    "parts": f"select {', '.join(PARTS)} from part",
    "roi": f"select *, sha256(concat(cast(job_id as string), '|', cast(ordinal as string))) as roi_id from (select {', '.join(ROI)} from supplier) r",
    "jobs": f"select {', '.join(JOBS)} from supplier",
    "chunk_times": f"select {', '.join(CHUNK_TIMES)} from features group by job_id, chunk_id",
    "file_times": f"select {', '.join(FILE_TIMES)} from features group by job_id",
    "listing": f"select {', '.join(LISTING)} from pages",
}
_NEEDS = {"part_errors": ["features"], "chunk_holes": ["features"], "chunk_times": ["features"], "file_times": ["features"]}


def with_views(names: str, body: str, recursive: bool = False) -> str:
    """SQL text of a query over some of the views, named in a space separated list."""
    ordered: list[str] = []
    for name in names.split():
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    views = ", ".join(f"{name} as materialized ({_SQL[name]})" for name in ordered)
    glue = ", " if body.lstrip().startswith("+") else " "
    return f"with {'recursive ' if recursive else ''}{views}{glue}{body.lstrip().removeprefix('+')}"


class Tables:
    """The views as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def numbered(self) -> DataFrame:
        """The features view: each job's rows numbered in file order."""
        block = F.shiftright("l_orderkey", ORDER_BLOCK_BITS)
        return number_rows(self.table("lineitem"), ["l_suppkey"], FEATURE_ORDER, block).withColumn("k", F.expr(FAULTS)).selectExpr(*FEATURES)

    @cached_property
    def stored(self) -> Tables:
        """The same tables with the features view written once, for plans that read it several times.

        Numbering the rows of every job is a full shuffle. A real layer comes with its positions, as the stored view does.
        """
        tables = Tables(self.spark, self.sf_dir)
        tables.numbered = written(self.numbered, "features")
        return tables

    @cached_property
    def unnumbered(self) -> DataFrame:
        """The features view without positions and chunks, for plans that need neither: no shuffle by job."""
        columns = [c for c in FEATURES if not c.endswith((" as ordinal", " as chunk_id"))]
        return self._with_constants(spread(self.table("lineitem")).withColumn("k", F.expr(FAULTS)).selectExpr(*columns))

    @cached_property
    def features(self) -> DataFrame:
        """Features with the remaining attributes as constants."""
        return self._with_constants(self.numbered)

    @staticmethod
    def _with_constants(features: DataFrame) -> DataFrame:
        zero, one = F.lit(0.0), F.lit(1.0)
        return features.withColumns({
            "type": F.lit("Feature"), "geometry": polygon_from_envelope(zero, zero, one, one), "classify": F.lit("C"),
            "cities": F.lit("c1, c2"), "countries": F.lit(None).cast("string"),
        })

    @cached_property
    def part_errors(self) -> DataFrame:
        return self.numbered.filter("k % 60 <= 6").selectExpr(*PART_ERRORS)

    @cached_property
    def chunk_holes(self) -> DataFrame:
        return self.numbered.groupBy("job_id", "chunk_id").agg(F.expr(f"cast({HOLES} as bigint)").alias("small_holes_count"))

    @cached_property
    def task_events(self) -> DataFrame:
        return self.table("events").selectExpr(*TASK_EVENTS)

    @cached_property
    def parts(self) -> DataFrame:
        return self.table("part").selectExpr(*PARTS)

    @cached_property
    def roi(self) -> DataFrame:
        return self.table("supplier").selectExpr(*ROI)

    @cached_property
    def jobs(self) -> DataFrame:
        return self.table("supplier").selectExpr(*JOBS)

    @cached_property
    def chunk_times(self) -> DataFrame:
        return self._grouped(CHUNK_TIMES, "job_id", "chunk_id")

    @cached_property
    def file_times(self) -> DataFrame:
        return self._grouped(FILE_TIMES, "job_id")

    def _grouped(self, columns: list[str], *keys: str) -> DataFrame:
        return self.numbered.groupBy(*keys).agg(*[F.expr(c) for c in columns if c not in keys])

    @cached_property
    def listing(self) -> DataFrame:
        return self.table("pages").selectExpr(*LISTING)
