"""Place enrichment: city and country from the nearest gazetteer entry.

Stands in for reverse geocoding by an online service, one request per
event: here it is a distance join between the *distinct* event places and a
gazetteer table (``place_id, lat, lon, city, country``), keeping per place
the nearest entry within ``max_km`` (ties by ``place_id``), then an
equi-join back to the events. Unlocated events and places without an entry
in range get null city/country.

Where the gazetteer is dense, the search widens in rings: a short radius first, then
double that for the points that found nothing yet. A radius that finds any entry has
the nearest one among its finds, so a point is done with the first ring that finds one,
and its candidates are those of that ring instead of all within ``max_km``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import grid_cell
from ..operators.spatial import distance_join
from ..session import cut_lineage

#: Entries in a cell (as wide as the radius) above which the search starts with a shorter one.
CELL_ENTRIES = 64
#: Greatest number of rings; each is a join of the points that are left.
MAX_RINGS = 12


def rings(gazetteer: DataFrame, max_km: float) -> list[float]:
    """The radii to search, the last one ``max_km``; one aggregate over the gazetteer.

    Each halving leaves about a quarter of a cell's entries, so the first radius
    follows the density of the densest cell.
    """
    placed = gazetteer.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    cell = F.struct(*grid_cell(F.col("lat").cast("double"), F.col("lon").cast("double"), max_km))
    densest = placed.groupBy(cell.alias("cell")).count().agg(F.max("count")).first()[0] or 0
    radii = [float(max_km)]
    while densest > CELL_ENTRIES and len(radii) < MAX_RINGS:
        radii.append(radii[-1] / 2)
        densest /= 4
    return radii[::-1]


def nearest_places(points: DataFrame, gazetteer: DataFrame, max_km: float, replicate: str = "left") -> DataFrame:
    """For each distinct (lat, lon) of ``points``, the nearest gazetteer entry.

    ``min(struct(distance, place_id, ...))`` per point is a partial
    aggregate, so a point with many candidates is reduced before the shuffle. With more
    than one ring (:func:`rings`) the points and each ring's finds are written.
    """
    pts = points.select("lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).distinct()
    gz = gazetteer.select(
        F.col("place_id").alias("_pid"),
        F.col("lat").cast("double").alias("_glat"),
        F.col("lon").cast("double").alias("_glon"),
        F.col("city").alias("_gcity"),
        F.col("country").alias("_gcountry"),
    )
    radii = rings(gazetteer, max_km)
    if len(radii) > 1:
        pts, gz = cut_lineage(pts), cut_lineage(gz)
    found = []
    for km in radii:
        cand = distance_join(pts, gz, km, ("lat", "lon"), ("_glat", "_glon"), "_dist", replicate)
        best = cand.groupBy("lat", "lon").agg(
            F.min(F.struct("_dist", "_pid", "_gcity", "_gcountry")).alias("_b")
        )
        if km < radii[-1]:
            best = cut_lineage(best)
            pts = cut_lineage(pts.join(best, ["lat", "lon"], "left_anti"))
        found.append(best)
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return best.select(
        "lat",
        "lon",
        F.col("_b._pid").alias("place_id"),
        F.col("_b._dist").alias("place_km"),
        F.col("_b._gcity").alias("city"),
        F.col("_b._gcountry").alias("country"),
    )


def enrich_places(events: DataFrame, gazetteer: DataFrame, max_km: float = 50.0) -> DataFrame:
    """``events`` plus ``city`` and ``country`` of the nearest gazetteer place.

    Existing ``city``/``country`` columns are replaced.
    """
    base = events.drop("city", "country")
    best = nearest_places(base, gazetteer, max_km).select("lat", "lon", "city", "country")
    # unlocated events share a null key: a hash of the id spreads them over the tasks
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    spread = F.when(placed, F.lit(-1)).otherwise(F.pmod(F.xxhash64("e_id"), F.lit(1 << 16)).cast("int"))
    rows = base.withColumn("_spread", spread)
    named = rows.join(best.withColumn("_spread", F.lit(-1)), ["lat", "lon", "_spread"], "left")
    return named.select(*base.columns, "city", "country")
