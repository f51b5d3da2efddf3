"""Valid features to mapped parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerlint.config import LIMITS, ZOOM_LEVELS, Limits, ZoomLevels
from layerlint.functions.resolution import resolution_meter
from layerlint.operators.schema import PARSED, feature_errors, parse_properties, valid_features, with_parsed

PART_COLUMNS = [
    "id", "sourceId", "sourceName", "horizontalAccuracyCE90", "imagingTimeBeginUTC", "imagingTimeEndUTC", "sourceResolutionMeter",
    "resolutionMeter", "resolutionDegree", "sensors", "description", "cities", "countries",
]


def feature_resolutions(rows: DataFrame, jobs: DataFrame, zoom_levels: ZoomLevels = ZOOM_LEVELS) -> DataFrame:
    """Attach each job's ingestion resolution in degrees and metres. No hint: the engine broadcasts jobs if they are small."""
    resolutions = jobs.select(
        "job_id",
        F.col("ingestion_resolution").alias("resolutionDegree"),
        resolution_meter(F.col("ingestion_resolution"), zoom_levels).alias("resolutionMeter"),
    )
    return rows.join(resolutions, "job_id")


def map_part_properties(valid: DataFrame, jobs: DataFrame, zoom_levels: ZoomLevels = ZOOM_LEVELS) -> DataFrame:
    """The mapped table: attributes renamed and typed, one date for both ends of the imaging time, unused ones dropped."""
    if not set(PARSED.values()) <= set(valid.columns):
        valid = with_parsed(valid)
    p = parse_properties(valid)
    geometry = [c for c in ("geometry",) if c in valid.columns]
    parts = valid.select(
        "job_id", "chunk_id", "ordinal", *geometry,
        p["id"].alias("id"), p["source_id"].alias("sourceId"), p["source_name"].alias("sourceName"),
        p["ep90"].alias("horizontalAccuracyCE90"),
        p["update_date"].alias("imagingTimeBeginUTC"), p["update_date"].alias("imagingTimeEndUTC"),
        p["source_res"].alias("sourceResolutionMeter"),
        p["sensors"].alias("sensors"), p["desc"].alias("description"), p["cities"].alias("cities"), p["countries"].alias("countries"),
    )
    return feature_resolutions(parts, jobs, zoom_levels).select("job_id", "chunk_id", "ordinal", *geometry, *PART_COLUMNS)


def split_valid(
    features: DataFrame, jobs: DataFrame, limits: Limits = LIMITS, zoom_levels: ZoomLevels = ZOOM_LEVELS,
) -> tuple[DataFrame, DataFrame]:
    """(mapped parts, vertex and metadata errors)."""
    return map_part_properties(valid_features(features, limits, readings=True), jobs, zoom_levels), feature_errors(features, limits)
