"""Distances on a sphere."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
METRES_PER_MILE = 1609.344
HAVERSINE_RADIUS_MI = 3961.0
KM_PER_MILE = 1.60934


def _central_angle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0))
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
        * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    )
    return 2 * F.asin(F.sqrt(F.least(F.lit(1.0), half_chord)))


def great_circle_miles(lat1, lon1, lat2, lon2, radius_m: float, pad: float = 1.0) -> Column:
    """Padded great-circle miles; NULL unless all four coordinates are known.

    The guard is needed: ``least(1.0, NULL)`` is 1.0, half a circumference.
    """
    metres = F.lit(radius_m) * _central_angle(lat1, lon1, lat2, lon2)
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, F.lit(pad) * metres / F.lit(METRES_PER_MILE))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    scale = 1.0 if unit == "mi" else KM_PER_MILE
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    angle = _central_angle(lat1, lon1, lat2, lon2)
    return F.when(known, angle * F.lit(HAVERSINE_RADIUS_MI) * F.lit(scale))
