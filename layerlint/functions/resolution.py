"""Resolution in degrees per pixel to zoom level and metres per pixel."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from layerlint.config import ZOOM_LEVELS, ZoomLevels


def zoom_level(degree: Column, zoom_levels: ZoomLevels = ZOOM_LEVELS) -> Column:
    return F.round(F.log2(F.lit(zoom_levels.top_degree) / degree), 0).cast("int")


def resolution_meter(degree: Column, zoom_levels: ZoomLevels = ZOOM_LEVELS) -> Column:
    """Metres per pixel of the level a resolution belongs to. A literal lookup, so no join.

    NULL for NULL; a resolution outside the table fails the job instead of losing its metres.
    """
    table = F.array(*[F.lit(float(m)) for m in zoom_levels.meters()])
    found = F.get(table, zoom_level(degree, zoom_levels))
    outside = F.raise_error(F.concat(F.lit("resolution outside the zoom table: "), degree.cast("string"))).cast("double")
    return F.when(degree.isNotNull(), F.coalesce(found, outside))
