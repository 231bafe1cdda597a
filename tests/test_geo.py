"""Distance expression and the grid distance join against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from eventtrails.functions.geo import haversine_km
from eventtrails.operators.filters import within_radius
from eventtrails.operators.spatial import distance_join, neighbour_places


def py_hav(lat1, lon1, lat2, lon2):
    r = math.radians
    a = math.sin(r(lat2 - lat1) / 2) ** 2 + math.sin(r(lon2 - lon1) / 2) ** 2 * math.cos(r(lat1)) * math.cos(r(lat2))
    return 2 * 6371.0 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))


def points(n, seed):
    rnd = random.Random(seed)
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(n)]
    # poles, antimeridian and near-duplicates
    pts += [(90.0, 0.0), (89.99, 45.0), (-90.0, 10.0), (-89.95, -170.0), (0.0, 179.9), (0.0, -179.9),
            (10.0, 180.0), (10.0, -180.0), (48.85, 2.35), (48.85, 2.35)]
    return pts


def test_haversine_matches_python(spark):
    pts = points(50, 1)
    pairs = [(a[0], a[1], b[0], b[1]) for a in pts[:20] for b in pts[-12:]]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = df.select(haversine_km("a", "b", "c", "d").alias("km")).collect()
    for (a, b, c, d), r in zip(pairs, got):
        assert r.km == pytest.approx(py_hav(a, b, c, d), abs=1e-6)
    # antimeridian neighbours are close, poles are one point
    one = spark.range(1).select(
        haversine_km(F.lit(0.0), F.lit(179.9), F.lit(0.0), F.lit(-179.9)).alias("x"),
        haversine_km(F.lit(90.0), F.lit(0.0), F.lit(90.0), F.lit(123.0)).alias("p"),
        haversine_km(F.lit(None).cast("double"), F.lit(1.0), F.lit(0.0), F.lit(0.0)).alias("n"),
    ).first()
    assert one.x == pytest.approx(22.239, abs=1e-2) and one.p == pytest.approx(0.0, abs=1e-6) and one.n is None


@pytest.mark.parametrize("km", [300.0, 500.0, 5000.0, 15000.0, 25000.0])
def test_grid_join_equals_brute_force(spark, km):
    left = points(150, 7)
    right = points(200, 11)
    ldf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left)], "li int, llat double, llon double")
    rdf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(right)], "ri int, rlat double, rlon double")
    for rep in ("left", "right"):
        got = distance_join(ldf, rdf, km, ("llat", "llon"), ("rlat", "rlon"), "d", rep)
        got = sorted((r.li, r.ri) for r in got.collect())
        want = sorted(
            (i, j)
            for i, (a, b) in enumerate(left)
            for j, (c, d) in enumerate(right)
            if py_hav(a, b, c, d) < km
        )
        assert got == want


def test_neighbour_places_includes_self_and_dedups(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (1.5, 1.0), (40.0, 40.0)], "lat double, lon double")
    got = sorted((r.lat, r.lon, r.n_lat, r.n_lon) for r in neighbour_places(df, df, 100.0).collect())
    assert got == [
        (1.0, 1.0, 1.0, 1.0),
        (1.0, 1.0, 1.5, 1.0),
        (1.5, 1.0, 1.0, 1.0),
        (1.5, 1.0, 1.5, 1.0),
        (40.0, 40.0, 40.0, 40.0),
    ]


def test_within_radius_band_is_exact(spark):
    pts = points(400, 3)
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pts)], "i int, lat double, lon double")
    for lat, lon, km in [(89.0, 0.0, 500.0), (0.0, 179.5, 300.0), (-60.0, -100.0, 3000.0)]:
        got = sorted(r.i for r in within_radius(df, lat, lon, km).collect())
        want = sorted(i for i, (a, b) in enumerate(pts) if py_hav(a, b, lat, lon) < km)
        assert got == want


@pytest.mark.parametrize("km,split", [(150.0, 2), (150.0, 4), (400.0, 3), (3000.0, 2)])
def test_neighbour_sums_split_equals_pairs(spark, km, split):
    from eventtrails.operators.spatial import neighbour_sums

    rnd = random.Random(int(km) + split)
    # dense cluster (many places per cell) plus scattered points, poles included
    pts = [(40 + rnd.uniform(-2, 2), 10 + rnd.uniform(-2, 2)) for _ in range(120)]
    pts += points(40, 5)
    vals = [(a, b, rnd.randrange(3), rnd.randrange(1, 5)) for a, b in pts for _ in range(2)]
    vdf = spark.createDataFrame(vals, "lat double, lon double, d int, v long")
    cen = vdf.select("lat", "lon").distinct()
    got = sorted(tuple(r) for r in neighbour_sums(cen, vdf, km, ["d"], "v", split).collect())
    base = sorted(tuple(r) for r in neighbour_sums(cen, vdf, km, ["d"], "v", None).collect())
    assert got == base
    want = {}
    for a, b in {(x, y) for x, y, _, _ in vals}:
        for x, y, d, v in vals:
            if py_hav(a, b, x, y) < km:
                want[(a, b, d)] = want.get((a, b, d), 0) + v
    assert sorted((a, b, d, v) for (a, b, d), v in want.items()) == base


def test_tiny_radius_cells_do_not_overflow(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0, 20.0), (3, 10.0000001, 20.0)], "i int, lat double, lon double")
    r = df.select(F.col("i").alias("j"), F.col("lat").alias("la"), F.col("lon").alias("lo"))
    got = sorted((x.i, x.j) for x in distance_join(df, r, 1e-6, ("lat", "lon"), ("la", "lo"), None).collect())
    # 1e-6 km = 1 mm: only identical points match (the third is 1.1 cm away)
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 3)]


def test_nan_point_never_matches(spark):
    from eventtrails.sources import parse_lines

    lines = spark.createDataFrame([("1;A;[u'nan 2.0'];;t;2000-01-02;X",), ("2;B;[u'1.0 2.0'];;t;2000-01-01;Y",)], "value string")
    ev = parse_lines(lines)
    assert ev.where("e_id = 1").first().lat != ev.where("e_id = 1").first().lat  # NaN
    got = distance_join(ev.select("e_id", "lat", "lon"),
                        ev.select(F.col("e_id").alias("j"), F.col("lat").alias("la"), F.col("lon").alias("lo")),
                        500.0, ("lat", "lon"), ("la", "lo"), None)
    assert sorted((r.e_id, r.j) for r in got.collect()) == [(2, 2)]


@pytest.mark.parametrize("km,box,leaf_pairs", [(150.0, 4.0, 1), (150.0, 4.0, 20), (0.05, 0.002, 4), (900.0, 60.0, 64), (25_000.0, 170.0, 4)])
def test_cell_levels_equal_brute_force(spark, km, box, leaf_pairs):
    import random
    import struct

    from eventtrails.operators.spatial import neighbour_spreader

    rng = random.Random(int(km) + leaf_pairs)
    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    points = sorted({(f32(47 + box / 3 * rng.random() - box / 6), f32(8 + box * rng.random() - box / 2)) for _ in range(160)})
    points += [(90.0, 0.0), (-90.0, 10.0), (47.0, f32(179.99)), (47.0, f32(-179.99))]
    values = [(*p, d, rng.randrange(1, 9)) for p in points for d in (1, 2) if rng.random() < 0.8]
    vdf = spark.createDataFrame(values, "lat float, lon float, d int, v long")
    cen = spark.createDataFrame([*points, points[0], (float("nan"), 1.0), (None, 1.0)], "lat float, lon float")
    got = {(r.lat, r.lon, r.d): r.v for r in neighbour_spreader(cen, cen, km, leaf_pairs=leaf_pairs)(vdf, ["d"], "v").collect()}
    want = {}
    for lat, lon in points:
        for a, b, d, v in values:
            x = math.sin(math.radians(a - lat) / 2) ** 2
            x += math.sin(math.radians(b - lon) / 2) ** 2 * math.cos(math.radians(lat)) * math.cos(math.radians(a))
            if 2 * 6371.0 * math.atan2(math.sqrt(x), math.sqrt(max(0.0, 1 - x))) < km:
                want[lat, lon, d] = want.get((lat, lon, d), 0) + v
    assert got == want


def test_dense_places_pass_whole_cells(spark):
    from eventtrails.operators import spatial

    places = spark.range(1500).select((F.lit(45.0) + F.rand(1)).cast("float").alias("lat"), (F.lit(7.0) + F.rand(2)).cast("float").alias("lon"))
    levels = spatial._cell_pairs(places.distinct().cache(), places.distinct(), 60.0, 32)
    inside = [t.where("kind = 0").count() for _, t, _ in levels]
    # no cell is inside at first; then coarse cells are, and finer ones nearer to the rim
    assert inside[0] == 0 and sum(n > 0 for n in inside) >= 2
    spread = spatial.neighbour_spreader(places.cache(), places, 60.0, leaf_pairs=32)
    ones = places.distinct().withColumns({"d": F.lit(1), "v": F.lit(1)})
    got = {(r.lat, r.lon): r.v for r in spread(ones, ["d"], "v").collect()}
    pairs = neighbour_places(places, places, 60.0).groupBy("lat", "lon").count()
    assert got == {(r.lat, r.lon): r["count"] for r in pairs.collect()}
