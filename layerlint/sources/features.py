"""Feature tables and file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from layerlint import constants as K
from layerlint.functions.geometry import GEOMETRY_TYPE, count_vertices

# One feature per line. Spark keeps no file order, so every line carries its position in the layer.
LINE_SCHEMA = (
    "job_id variant, ordinal bigint, type string, id variant, bbox variant, "
    "geometry struct<type:string,coordinates:variant>, properties variant"
)


def _four_levels(geometry: Column) -> Column:
    """Coordinates of either geometry type as a list of polygons."""
    polygon = F.try_variant_get(geometry["coordinates"], "$", "array<array<array<double>>>")
    several = F.try_variant_get(geometry["coordinates"], "$", "array<array<array<array<double>>>>")
    coordinates = F.when(geometry["type"] == "Polygon", F.when(polygon.isNotNull(), F.array(polygon))).otherwise(several)
    return F.when(
        geometry.isNotNull(), F.struct(geometry["type"].alias("type"), coordinates.alias("coordinates"))
    ).cast(GEOMETRY_TYPE)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Fields of each line, and its text. Job ids may be texts or numbers and are read as texts, ``007`` stays what it is."""
    read = spark.read.text(path).select("value", F.from_json("value", LINE_SCHEMA).alias("f")).select("value", "f.*")
    return read.withColumn("job_id", F.try_variant_get("job_id", "$", "string"))


def read_features(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | T.StructType | None = None) -> DataFrame:
    """Features of layers in a declared schema, from Parquet or from GeoJSON lines.

    GeoJSON properties stay a ``VARIANT``: a missing attribute, a null and values of different types remain apart; so do id and
    bbox in ``raw_id`` and ``raw_bbox``, which the shape rules look at. Vertices are counted from the geometry; a number that
    the line states is only used where there is no geometry to count. Lines without job or position are in ``broken_lines``.
    """
    if fmt == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if fmt != "geojsonl":
        raise ValueError(f"unknown feature format {fmt}")
    given = F.try_variant_get("properties", "$.vertices", "bigint")
    lines = _lines(spark, path).filter("job_id is not null and ordinal is not null").drop("value")
    shaped = lines.withColumnsRenamed({"id": "raw_id", "bbox": "raw_bbox"}).withColumns({
        "geometry": _four_levels(F.col("geometry")), "feature_id": F.try_variant_get("raw_id", "$", "string"), "bbox": F.try_variant_get("raw_bbox", "$", "array<double>"),
    })
    return shaped.withColumn("vertices", F.when(F.col("geometry").isNotNull(), count_vertices(F.col("geometry")).cast("bigint")).otherwise(given))


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are no feature of a layer: their text and the reason, one row each, repeated lines too."""
    lines = _lines(spark, path).filter("job_id is null or ordinal is null")
    nothing = F.expr("coalesce(job_id is null and ordinal is null and type is null and id is null and bbox is null and geometry is null and properties is null, true)")
    reason = F.when(nothing, "not a JSON object of a feature").when(F.col("job_id").isNull(), "no job").otherwise("no position")
    return lines.select(F.col("value").alias("line"), reason.alias("reason"))


def base_and_extension(path: Column) -> tuple[Column, Column]:
    """A file path without its extension, and the extension with its dot."""
    extension = F.regexp_extract(path, r"(\.[^./]+)$", 1)
    return F.substring(path, F.lit(1), F.length(path) - F.length(extension)), extension


def missing_files(layers: DataFrame, listing: DataFrame, required: tuple[str, ...] = tuple(K.LAYER_EXTENSIONS)) -> DataFrame:
    """Layers whose required files are not all in the listing, with the files and the error text.

    ``layers`` has ``base`` (path without extension), ``listing`` has ``path``. One flag per required extension is combined
    on the map side, however often a path is listed.
    """
    base, extension = base_and_extension(F.col("path"))
    present = (
        listing.select(base.alias("base"), extension.alias("extension")).filter(F.col("extension").isin(*required))
        .groupBy("base").agg(*[F.max(F.col("extension") == e).alias(f"has{e[1:]}") for e in required])
    )
    absent = F.array_compact(F.array(*[
        F.when(~F.coalesce(F.col(f"has{e[1:]}"), F.lit(False)), F.concat(F.col("base"), F.lit(e))) for e in required
    ]))
    files = F.array_join("missing", ", ")
    return (
        layers.join(present, "base", "left").withColumn("missing", absent).filter(F.size("missing") > 0)
        .select("base", "missing", F.concat(F.lit("Shapefile not found: "), F.col("base"), F.lit(". Missing files: "), files).alias("error"))
    )


def absent_folders(required: DataFrame, present: DataFrame) -> DataFrame:
    """Folders that should exist and do not."""
    return required.select("path").subtract(present.select("path"))
