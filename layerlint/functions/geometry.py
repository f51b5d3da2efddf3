"""Geometry columns: ``STRUCT<type, coordinates>`` with coordinates four levels deep (a polygon has one member)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GEOMETRY_TYPE = "struct<type:string,coordinates:array<array<array<array<double>>>>>"


def polygon_from_envelope(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed rectangular ring around an envelope."""
    ring = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    return F.struct(F.lit("Polygon").alias("type"), F.array(F.array(ring)).alias("coordinates"))


def count_vertices(geometry: Column) -> Column:
    """Coordinate pairs over all rings of all members, closing points included."""
    rings = F.flatten(geometry["coordinates"])
    return F.coalesce(F.aggregate(rings, F.lit(0), lambda total, ring: total + F.size(ring)), F.lit(0))


def is_polygonal(geometry: Column) -> Column:
    """A Polygon (exactly one member) or MultiPolygon whose positions are all two or three numbers."""
    coordinates = geometry["coordinates"]

    def sound(position: Column) -> Column:
        numbers = F.size(position)
        third = (numbers == 2) | F.get(position, 2).isNotNull()
        return numbers.between(2, 3) & F.get(position, 0).isNotNull() & F.get(position, 1).isNotNull() & third

    # a NULL member or ring makes the flattened list NULL
    sound_positions = F.forall(F.flatten(F.flatten(coordinates)), sound)
    members = F.when(geometry["type"] == "Polygon", F.size(coordinates) == 1).otherwise(geometry["type"] == "MultiPolygon")
    return F.coalesce(geometry.isNotNull() & members & sound_positions, F.lit(False))
