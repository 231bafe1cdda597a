"""Row filters on event frames.

All are plain ``where`` clauses on native expressions, so Catalyst pushes
them into the scan when the columns are stored (``lat``, ``time_norm``,
``actor``) and fuses them into one codegen stage otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.curve import circle_ranges, in_ranges
from ..functions.dates import date_lit
from ..functions.geo import EARTH_RADIUS_KM, haversine_km


#: Stored key of the ``curve`` table layout.
CURVE_KEY = "curve_key"


def located(df: DataFrame) -> DataFrame:
    """Keep events with a location (``lat`` and ``lon`` both present).

    A ``NaN`` coordinate counts as located, as a non-empty ``loc`` did in the
    original, but it is within no distance of anything.
    """
    return df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def with_city(df: DataFrame) -> DataFrame:
    """Keep events with a non-empty city."""
    return df.where(F.length("city") > 0)


def with_country(df: DataFrame) -> DataFrame:
    """Keep events with a non-empty country."""
    return df.where(F.length("country") > 0)


def by_actor(df: DataFrame, actor: str) -> DataFrame:
    """Keep one actor's events (an equality pushed to the scan when stored)."""
    return df.where(F.col("actor") == F.lit(actor))


def root(df: DataFrame, e_id) -> DataFrame:
    """The root event row(s) with id ``e_id`` (ids may repeat: all rows kept).

    ``e_id`` may also be a list of ids (an ``IN`` filter, pushed to the scan).
    """
    if isinstance(e_id, (list, tuple, set)):
        return df.where(F.col("e_id").isin([int(x) for x in e_id]))
    return df.where(F.col("e_id") == F.lit(int(e_id)))


def between_dates(df: DataFrame, start=None, end=None, column: str = "time_norm") -> DataFrame:
    """Inclusive date range; ``None`` leaves that side open."""
    if start is not None:
        df = df.where(F.col(column) >= date_lit(start))
    if end is not None:
        df = df.where(F.col(column) <= date_lit(end))
    return df


def latitude_band(lat: float, km: float) -> tuple[float, float]:
    """Latitudes that can be within ``km`` of a point at latitude ``lat``."""
    dlat = math.degrees(float(km) / EARTH_RADIUS_KM) * (1 + 1e-6) + 1e-9
    return lat - dlat, lat + dlat


def within_radius(df: DataFrame, lat: float, lon: float, km: float, dist_col: str | None = None) -> DataFrame:
    """Events strictly closer than ``km`` to (lat, lon).

    A latitude band (a sargable range on ``lat``) is applied first; it is
    pushed to the Parquet scan where ``lat`` is a stored column and skips
    row groups by their min/max statistics. Where the events carry the key of
    the ``curve`` layout (``read_events_table(curve=True)``), the circle's key
    ranges are pushed too, so row groups are skipped by longitude as well. The
    exact haversine test runs on what remains.
    """
    lo, hi = latitude_band(lat, km)
    d = haversine_km(F.col("lat"), F.col("lon"), F.lit(float(lat)), F.lit(float(lon)))
    out = df.where((F.col("lat") >= F.lit(lo)) & (F.col("lat") <= F.lit(hi)))
    if CURVE_KEY in df.columns:
        out = out.where(in_ranges(F.col(CURVE_KEY), circle_ranges(float(lat), float(lon), float(km))))
    if dist_col:
        return out.withColumn(dist_col, d).where(F.col(dist_col) < F.lit(float(km)))
    return out.where(d < F.lit(float(km)))
