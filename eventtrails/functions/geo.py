"""Native (JVM-side, codegen'd) geographic column expressions.

Everything here returns a ``Column``; no Python UDF is involved, so the
expressions stay inside whole-stage codegen and take part in constant
folding and filter pushdown.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in km used by the haversine distance.
EARTH_RADIUS_KM = 6371.0


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km between two (lat, lon) points in degrees.

    ``a = sin²(Δlat/2) + sin²(Δlon/2)·cos(lat1)·cos(lat2)``,
    ``d = 2R·atan2(√a, √(1-a))``. ``1 - a`` is clamped at 0 so rounding
    can never produce NaN. Null in, null out: an unlocated event has no
    distance (the original treated a missing point as (0, 0)).
    """
    la1, lo1, la2, lo2 = (_col(c).cast("double") for c in (lat1, lon1, lat2, lon2))
    half_dlat = F.radians(la2 - la1) / 2
    half_dlon = F.radians(lo2 - lo1) / 2
    a = F.sin(half_dlat) * F.sin(half_dlat) + F.sin(half_dlon) * F.sin(half_dlon) * F.cos(
        F.radians(la1)
    ) * F.cos(F.radians(la2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))


distance_km = haversine_km


def chord_for_km(km: float) -> float:
    """Chord length on the unit sphere for a great-circle distance in km."""
    theta = min(float(km) / EARTH_RADIUS_KM, math.pi)
    return 2.0 * math.sin(theta / 2.0)


def unit_vector(lat, lon) -> list[Column]:
    """(x, y, z) of the point on the unit sphere; no pole/antimeridian cases."""
    la, lo = F.radians(_col(lat).cast("double")), F.radians(_col(lon).cast("double"))
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def cell_side_for_km(km: float) -> float:
    """Side of the 3-D grid cell for a radius: the chord plus a relative margin.

    Two points closer than ``km`` lie closer than the chord in R³, so they
    fall into the same or adjacent cells. The margin absorbs rounding.
    """
    return chord_for_km(km) * (1.0 + 1e-4) + 1e-12


def grid_cell(lat, lon, km: float) -> list[Column]:
    """Integer (cx, cy, cz) cell of a point for a search radius of ``km``."""
    side = cell_side_for_km(km)
    # long: for radii under a metre the cell index exceeds the int range
    return [F.floor(c / F.lit(side)).cast("long") for c in unit_vector(lat, lon)]
