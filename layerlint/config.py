"""Tunable limits. Defaults marked "assumed" are choices of this library, not documented values."""

from __future__ import annotations

from dataclasses import dataclass, field

from layerlint import constants as K


@dataclass(frozen=True)
class Bounds:
    """Inclusive numeric ranges of feature attributes."""

    resolution_min: float = 0.0185  # assumed
    resolution_max: float = 78271.52
    ce90_min: float = 0.01  # assumed
    ce90_max: float = 4000


@dataclass(frozen=True)
class Limits:
    """Limits of one validation run."""

    max_vertices: int = 2500
    small_geometries_pct: float = 5
    small_holes_pct: float = 5
    bounds: Bounds = field(default_factory=Bounds)


@dataclass(frozen=True)
class ZoomLevels:
    """Degrees per pixel and metres per pixel by zoom; each level halves the one before (assumed beyond 0)."""

    top_degree: float = 0.703125
    top_meter: float = 78271.52
    levels: int = 23

    def meters(self) -> list[float]:
        return [self.top_meter / 2**z for z in range(self.levels)]


@dataclass(frozen=True)
class Services:
    """Names and places used in report links."""

    download_base: str = "http://localhost:8085"
    download_path: str = "downloads/validation-reports"
    reports_path: str = "/validation-reports"


LIMITS = Limits()
ZOOM_LEVELS = ZoomLevels()
SERVICES = Services()
LAYER_EXTENSIONS = tuple(K.LAYER_EXTENSIONS)
