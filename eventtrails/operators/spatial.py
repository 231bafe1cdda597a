"""Distance join: all point pairs closer than ``km``, without a theta join.

Each point becomes a unit vector (x, y, z). Two points less than ``km``
apart on the sphere are less than the chord ``c = 2·sin(km / 2R)`` apart in
R³, so with cells of side ``c`` (plus a margin) they fall into the same or
adjacent cells. One side is replicated into its 27 neighbour cells, the
sides are equi-joined on the cell (a hash/sort-merge join Spark can
partition and AQE can split when a cell is hot), and the exact haversine
test removes the false candidates. Poles and the antimeridian need no
special case. For radii near half the circumference the grid degenerates
to a handful of cells, i.e. to the theta join, and stays exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import cell_side_for_km, chord_for_km, grid_cell, haversine_km, unit_vector
from ..session import cut_lineage

_OFFSETS = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1)]
_CELL = ["_cx", "_cy", "_cz"]
# The 27 offsets as one literal array expression (one parse instead of 81
# separate literal columns when the plan is built).
_OFFSETS_SQL = "array(" + ", ".join(f"named_struct('dx', {a}, 'dy', {b}, 'dz', {c})" for a, b, c in _OFFSETS) + ")"


def _usable(lat: str, lon: str):
    """A point that can be within some distance: present and not NaN."""
    return F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def with_cell(df: DataFrame, lat: str, lon: str, km: float) -> DataFrame:
    """Add the integer grid cell ``_cx, _cy, _cz`` of (lat, lon) for radius ``km``."""
    cx, cy, cz = grid_cell(F.col(lat), F.col(lon), km)
    return df.withColumns({"_cx": cx, "_cy": cy, "_cz": cz})


def with_neighbour_cells(df: DataFrame, lat: str, lon: str, km: float) -> DataFrame:
    """Replicate each row into the 27 cells around its own (27 rows per input row)."""
    cx, cy, cz = grid_cell(F.col(lat), F.col(lon), km)
    return (
        df.withColumn("_off", F.explode(F.expr(_OFFSETS_SQL)))
        .withColumns(
            {
                "_cx": cx + F.col("_off.dx"),
                "_cy": cy + F.col("_off.dy"),
                "_cz": cz + F.col("_off.dz"),
            }
        )
        .drop("_off")
    )


def distance_join(
    left: DataFrame,
    right: DataFrame,
    km: float,
    left_point: tuple[str, str] = ("lat", "lon"),
    right_point: tuple[str, str] = ("lat", "lon"),
    dist_col: str | None = "dist_km",
    replicate: str = "left",
    extra_condition=None,
) -> DataFrame:
    """Inner join of ``left`` and ``right`` on haversine distance ``< km``.

    Column names of the two sides must be disjoint. ``replicate`` picks the
    side copied into 27 cells: the one expected to be smaller (a frontier, a
    set of distinct places). Rows with a null point never match.
    ``extra_condition`` (a Column over both sides) is added to the join
    condition, e.g. a date order, so it is evaluated in the same operator.
    """
    (llat, llon), (rlat, rlon) = left_point, right_point
    lsrc = left.where(_usable(llat, llon))
    rsrc = right.where(_usable(rlat, rlon))
    if replicate == "left":
        lc, rc = with_neighbour_cells(lsrc, llat, llon, km), with_cell(rsrc, rlat, rlon, km)
    elif replicate == "right":
        lc, rc = with_cell(lsrc, llat, llon, km), with_neighbour_cells(rsrc, rlat, rlon, km)
    else:
        raise ValueError("replicate must be 'left' or 'right'")
    lc = lc.withColumnsRenamed({c: "_l" + c for c in _CELL})
    rc = rc.withColumnsRenamed({c: "_r" + c for c in _CELL})
    dist = haversine_km(F.col(llat), F.col(llon), F.col(rlat), F.col(rlon))
    cond = (
        (F.col("_l_cx") == F.col("_r_cx"))
        & (F.col("_l_cy") == F.col("_r_cy"))
        & (F.col("_l_cz") == F.col("_r_cz"))
        & (dist < F.lit(float(km)))
    )
    if extra_condition is not None:
        cond = cond & extra_condition
    out = lc.join(rc, cond, "inner").drop(*["_l" + c for c in _CELL], *["_r" + c for c in _CELL])
    if dist_col:
        out = out.withColumn(dist_col, dist)
    return out


def neighbour_places(
    centres: DataFrame, places: DataFrame, km: float, replicate: str = "left"
) -> DataFrame:
    """Pairs of distinct places ``(lat, lon) -> (n_lat, n_lon, dist_km)`` within ``km``.

    Both inputs are reduced to their distinct (lat, lon) first, so the work
    grows with the number of places, not of events; a place is its own
    neighbour (distance 0).
    """
    c = centres.select("lat", "lon").distinct()
    p = places.select(F.col("lat").alias("n_lat"), F.col("lon").alias("n_lon")).distinct()
    return distance_join(c, p, km, ("lat", "lon"), ("n_lat", "n_lon"), "dist_km", replicate)


#: Pairs of places that a pair of cells at the rim may give before it is divided.
LEAF_PAIRS = 256
#: Levels of cells; the finest are under a metre for radii up to 1,000 km.
MAX_LEVEL = 21
_AXES = ("x", "y", "z")


def _side_of(km: float, level: int) -> float:
    return cell_side_for_km(km) / 2.0**level


def _cells(df: DataFrame, lat: str, lon: str, side: float, prefix: str) -> DataFrame:
    """Add the cell ``<prefix>x, <prefix>y, <prefix>z`` of (lat, lon).

    Halving ``side`` is exact in binary, so a cell's parts have twice its numbers,
    or one more, on each axis.
    """
    point = unit_vector(F.col(lat), F.col(lon))
    return df.withColumns({prefix + a: F.floor(v / F.lit(side)).cast("long") for a, v in zip(_AXES, point)})


def _judged(pairs: DataFrame, km: float, level: int, leaf_pairs: int) -> DataFrame:
    """Cell pairs that can hold places within ``km``, with their ``kind``: 0 wholly
    within, 1 to be tested place by place, 2 to be divided."""
    side, chord = F.lit(_side_of(km, level)), chord_for_km(km)
    near2, far2 = F.lit(0.0), F.lit(0.0)
    for a in _AXES:
        gap = (F.col("b" + a) - F.col("a" + a)).cast("double")
        near = F.greatest(F.abs(gap) - 1.0, F.lit(0.0)) * side
        far = (F.abs(gap) + 1.0) * side
        near2, far2 = near2 + near * near, far2 + far * far
    few = (F.col("na") * F.col("nb") <= F.lit(leaf_pairs)) if level < MAX_LEVEL else F.lit(True)
    # margins over the rounding of unit vectors and distances
    inner, outer = max(0.0, chord * (1 - 1e-9) - 1e-15) ** 2, (chord * (1 + 1e-9) + 1e-15) ** 2
    kind = F.when(far2 < F.lit(inner), 0).when(few, 1).otherwise(2)
    return pairs.where(near2 < F.lit(outer)).withColumn("kind", kind)


def _cell_pairs(cen: DataFrame, places: DataFrame, km: float, leaf_pairs: int):
    """Written cell pairs by level: ``[(level, table, kinds)]`` (see :func:`neighbour_spreader`)."""

    def counted(df: DataFrame, level: int, prefix: str) -> DataFrame:
        cells = [prefix + a for a in _AXES]
        return _cells(df, "lat", "lon", _side_of(km, level), prefix).groupBy(*cells).agg(F.count(F.lit(1)).alias("n" + prefix))

    a_cells, b_cells = ["a" + a for a in _AXES], ["b" + a for a in _AXES]
    around = counted(cen, 0, "a").withColumn("_off", F.explode(F.expr(_OFFSETS_SQL)))
    around = around.withColumns({"b" + a: F.col("a" + a) + F.col(f"_off.d{a}") for a in _AXES}).drop("_off")
    pairs = around.join(counted(places, 0, "b"), b_cells)
    out = []
    for level in range(MAX_LEVEL + 1):
        table = cut_lineage(_judged(pairs, km, level, leaf_pairs).select(*a_cells, *b_cells, "kind"))
        kinds = {r["kind"] for r in table.select("kind").distinct().collect()}  # three at most
        out.append((level, table, kinds))
        if 2 not in kinds:
            break
        pairs = table.where("kind = 2").select(*[F.col(c).alias("up" + c) for c in a_cells + b_cells])
        for side, cells, what in ((cen, a_cells, "a"), (places, b_cells, "b")):
            parts = counted(side, level + 1, what)
            parts = parts.withColumns({"up" + c: F.floor(F.col(c) / 2).cast("long") for c in cells})
            pairs = pairs.join(parts, ["up" + c for c in cells])
    return out


def neighbour_spreader(
    centres: DataFrame, places: DataFrame, km: float, split: int | None = None, leaf_pairs: int = LEAF_PAIRS
):
    """Build, once, a function that sums values over neighbouring places.

    ``centres`` and ``places``: ``lat, lon`` (duplicates allowed). The
    returned ``spread(values, keys, value)`` takes ``lat, lon, *keys, value``
    rows at places and returns ``lat, lon, *keys, value``: per centre, the sum
    over rows at places strictly within ``km``.

    Cells form a hierarchy, each level half the side of the one above. A pair of
    cells (of centres, of places) that lies wholly within the radius passes the place
    cell's total on to the centre cell; one wholly outside goes; one at the rim is
    divided into its parts, until it stands for ``leaf_pairs`` pairs of places at
    most, which are tested one by one. So where places are sparse this is the join of
    neighbouring places, and where they are dense, coarse cells carry the inside of a
    radius and only its rim is looked at closely; there is one way for both. The pairs
    are found once, level by level, over distinct places, and written; values join
    them, pre-summed by cell. Exact: a cell is inside or outside by a margin over
    rounding. A sum that overflows its type is null. ``split`` has no effect any more.
    """
    cen = cut_lineage(centres.select("lat", "lon").where(_usable("lat", "lon")).distinct())
    places = cen if places is centres else cut_lineage(places.select("lat", "lon").where(_usable("lat", "lon")).distinct())
    a_cells, b_cells = ["a" + a for a in _AXES], ["b" + a for a in _AXES]
    levels = _cell_pairs(cen, places, km, leaf_pairs)
    within, near = [], []
    for level, table, kinds in levels:
        side = _side_of(km, level)
        if 0 in kinds:
            within.append((side, table.where("kind = 0").select(*a_cells, *b_cells)))
        if 1 in kinds:
            rim = table.where("kind = 1").select(*a_cells, *b_cells)
            rim = rim.join(_cells(cen, "lat", "lon", side, "a"), a_cells)
            there = places.select(F.col("lat").alias("n_lat"), F.col("lon").alias("n_lon"))
            rim = rim.join(_cells(there, "n_lat", "n_lon", side, "b"), b_cells)
            near.append(rim.where(haversine_km("lat", "lon", "n_lat", "n_lon") < F.lit(float(km))).select("lat", "lon", "n_lat", "n_lon"))
    pairs = cut_lineage(reduce(DataFrame.unionByName, near)) if near else None

    def spread(values: DataFrame, keys: list[str], value: str) -> DataFrame:
        values = values.where(_usable("lat", "lon"))
        total = F.try_sum(F.col(value)).alias(value)
        parts = []
        if pairs is not None:
            parts.append(pairs.join(values.withColumnsRenamed({"lat": "n_lat", "lon": "n_lon"}), ["n_lat", "n_lon"]))
        for side, inside in within:
            sums = _cells(values, "lat", "lon", side, "b").groupBy(*b_cells, *keys).agg(total)
            sums = inside.join(sums, b_cells).groupBy(*a_cells, *keys).agg(total)
            parts.append(_cells(cen, "lat", "lon", side, "a").join(sums, a_cells))
        if not parts:
            return values.select("lat", "lon", *keys, value).limit(0)
        rows = reduce(DataFrame.unionByName, [p.select("lat", "lon", *keys, value) for p in parts])
        return rows.groupBy("lat", "lon", *keys).agg(total)

    return spread


def neighbour_sums(
    centres: DataFrame,
    values: DataFrame,
    km: float,
    keys: list[str],
    value: str,
    split: int | None = None,
) -> DataFrame:
    """Per centre place, the sum of ``value`` over rows of ``values`` at places
    strictly within ``km``, per ``keys`` (see :func:`neighbour_spreader`)."""
    return neighbour_spreader(centres, values.select("lat", "lon"), km)(values, keys, value)
