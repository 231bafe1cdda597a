"""A space-filling curve over the globe, and circles as ranges of its keys.

Latitude and longitude are each divided into 2^16 steps whose bits are interleaved
(Z order), so near places mostly have near keys. A table sorted by the key has narrow
ranges of latitude *and* longitude in every file and row group; a circle is a few key
ranges, which the Parquet reader compares with their statistics.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import EARTH_RADIUS_KM

BITS = 16
#: Key of events without a usable point: within no distance of anything.
NOWHERE = -2
#: Key of points outside [-90, 90] x [-180, 180], which no range covers.
OUTSIDE = -1
#: Greatest number of key ranges for one circle.
MAX_RANGES = 16


def _spread(x: Column) -> Column:
    """The bits of a 16-bit number at every second place."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def _step(c: Column, low: float, span: float) -> Column:
    return F.least(F.floor((c - F.lit(low)) / F.lit(span) * F.lit(float(1 << BITS))), F.lit((1 << BITS) - 1)).cast("long")


def curve_key(lat="lat", lon="lon") -> Column:
    """The key of a point: 0 to 2^32 - 1, :data:`OUTSIDE` or :data:`NOWHERE`."""
    la, lo = (F.col(c).cast("double") for c in (lat, lon))
    key = F.shiftleft(_spread(_step(la, -90.0, 180.0)), 1).bitwiseOR(_spread(_step(lo, -180.0, 360.0)))
    return (
        F.when(la.isNull() | lo.isNull() | F.isnan(la) | F.isnan(lo), F.lit(NOWHERE).cast("long"))
        .when(~la.between(-90.0, 90.0) | ~lo.between(-180.0, 180.0), F.lit(OUTSIDE).cast("long"))
        .otherwise(key)
    )


def circle_boxes(lat: float, lon: float, km: float) -> list[tuple[float, float, float, float]]:
    """Boxes ``(south, north, west, east)`` that cover all points within ``km``."""
    angle = float(km) / EARTH_RADIUS_KM * (1 + 1e-6) + 1e-9
    dlat = math.degrees(angle)
    south, north = lat - dlat, lat + dlat
    lon = (lon + 180.0) % 360.0 - 180.0
    if south <= -90 or north >= 90:
        return [(max(south, -90.0), min(north, 90.0), -180.0, 180.0)]
    dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + 1e-6
    west, east = lon - dlon, lon + dlon
    if west < -180:
        return [(south, north, -180.0, east), (south, north, west + 360, 180.0)]
    if east > 180:
        return [(south, north, west, 180.0), (south, north, -180.0, east - 360)]
    # the two sides of the antimeridian are one line
    touch = [(south, north, 180.0, 180.0)] * (west == -180) + [(south, north, -180.0, -180.0)] * (east == 180)
    return [(south, north, west, east), *touch]


def circle_ranges(lat: float, lon: float, km: float, max_ranges: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``max_ranges`` inclusive key ranges that cover all points within ``km``.

    Cells of the curve that the circle's boxes cut are divided, level by level, while
    the ranges stay few; then the ranges with the narrowest gaps are joined.
    """
    top = (1 << BITS) - 1

    def step(v: float, low: float, span: float) -> int:
        return max(0, min(top, math.floor((v - low) / span * (1 << BITS))))

    # a step more on every side for rounding
    boxes = [
        (max(0, step(s, -90, 180) - 1), min(top, step(n, -90, 180) + 1), max(0, step(w, -180, 360) - 1), min(top, step(e, -180, 360) + 1))
        for s, n, w, e in circle_boxes(lat, lon, km)
    ]
    inside: list[tuple[int, int]] = []
    cut = [(0, 0, 0)]  # row, column and first key of cells that the boxes cut
    side = 1 << BITS
    while cut and side > 1 and len(cut) + len(inside) <= 4 * max_ranges:
        side //= 2
        parts = [(r + dr * side, c + dc * side, k + (2 * dr + dc) * side * side) for r, c, k in cut for dr in (0, 1) for dc in (0, 1)]
        cut = []
        for r, c, k in parts:
            hit = [b for b in boxes if b[0] < r + side and b[1] >= r and b[2] < c + side and b[3] >= c]
            if any(b[0] <= r and b[1] >= r + side - 1 and b[2] <= c and b[3] >= c + side - 1 for b in hit):
                inside.append((k, k + side * side - 1))
            elif hit:
                cut.append((r, c, k))
    ranges: list[tuple[int, int]] = []
    for a, b in sorted(inside + [(k, k + side * side - 1) for _, _, k in cut]):
        if ranges and ranges[-1][1] + 1 == a:
            ranges[-1] = ranges[-1][0], b
        else:
            ranges.append((a, b))
    while len(ranges) > max_ranges:
        k = min(range(1, len(ranges)), key=lambda i: ranges[i][0] - ranges[i - 1][1])
        ranges[k - 1 : k + 1] = [(ranges[k - 1][0], ranges[k][1])]
    return ranges


def in_ranges(key: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether a key lies in one of the ranges or outside the curve (to be tested exactly)."""
    out = key == F.lit(OUTSIDE)
    for a, b in ranges:
        out = out | key.between(a, b)
    return out
