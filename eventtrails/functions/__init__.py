"""Scalar column expressions (all native Spark, no Python UDFs)."""

from .dates import abs_day_gap, date_lit, day_gap
from .geo import (
    EARTH_RADIUS_KM,
    cell_side_for_km,
    chord_for_km,
    distance_km,
    grid_cell,
    haversine_km,
    unit_vector,
)
from .curve import circle_ranges, curve_key
from .labels import event_label

__all__ = [
    "EARTH_RADIUS_KM",
    "abs_day_gap",
    "cell_side_for_km",
    "chord_for_km",
    "circle_ranges",
    "curve_key",
    "date_lit",
    "day_gap",
    "distance_km",
    "event_label",
    "grid_cell",
    "haversine_km",
    "unit_vector",
]
