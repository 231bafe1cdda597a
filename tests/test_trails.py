"""Trails, trail graphs and trail counts against a brute-force enumeration."""

from __future__ import annotations

import datetime as dt
import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventtrails.operators.filters import located
from eventtrails.operators.hops import hop_actor
from eventtrails.plans.counts import count_trails, most_related
from eventtrails.plans.graph import trail_graph
from eventtrails.plans.trails import trail, trail_columns, trail_two_hop

from .conftest import D, make_events


def py_hav(lat1, lon1, lat2, lon2):
    r = math.radians
    a = math.sin(r(lat2 - lat1) / 2) ** 2 + math.sin(r(lon2 - lon1) / 2) ** 2 * math.cos(r(lat1)) * math.cos(r(lat2))
    return 2 * 6371.0 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))


def f32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0] if x is not None else None


def brute_trails(rows, roots, depth, second="geo", km=500.0, max_days=None):
    """All trails as tuples of row indices (rows: (e_id, actor, date, lat, lon[, city]))."""
    def ok(a, b, kind):
        ra, rb = rows[a], rows[b]
        if not rb[2] < ra[2]:
            return False
        if max_days and (ra[2] - rb[2]).days >= max_days:
            return False
        if kind == "actor":
            return ra[1] == rb[1]
        if kind == "geo":
            return py_hav(f32(ra[3]), f32(ra[4]), f32(rb[3]), f32(rb[4])) < km
        return ra[5] == rb[5]

    trails = [(r,) for r in roots]
    for step in range(1, depth + 1):
        kind = "actor" if step % 2 == 1 else second
        trails = [t + (j,) for t in trails for j in range(len(rows)) if ok(t[-1], j, kind)]
    return trails


def random_rows(seed, n=70, actors=4, days=9, city=False):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lat, lon = rnd.choice([0, 1, 2, 3]) * 1.0, rnd.choice([0, 1, 2]) * 1.0
        r = (i + 1, f"A{rnd.randrange(actors)}", D(f"2000-01-{1 + rnd.randrange(days)}"), lat, lon)
        rows.append(r + ((f"C{int(lat + lon) % 3}",) if city else ()))
    return rows


@pytest.mark.parametrize("second,km,max_days,depth", [("geo", 150.0, None, 3), ("geo", 250.0, 4, 4), ("city", None, 3, 4)])
def test_trail_equals_brute_force(spark, second, km, max_days, depth):
    rows = random_rows(5, city=second == "city")
    ev = make_events(spark, rows, places=True)
    roots = [i for i, r in enumerate(rows) if r[2] >= D("2000-01-08")][:4]
    got = trail(ev, ev.where(F.col("e_id").isin([rows[i][0] for i in roots])), depth, second, km or 0.0, max_days)
    assert got.columns == trail_columns(depth, second, max_days)
    ids = [f"e_id{'' if k == 1 else k}" for k in range(1, depth + 2)]
    got_c = Counter(tuple(r[c] for c in ids) for r in got.collect())
    want = brute_trails(rows, roots, depth, second, km or 0.0, max_days)
    want_c = Counter(tuple(rows[i][0] for i in t) for t in want)
    assert got_c == want_c
    # dates strictly decrease along every trail
    tcols = [f"time_norm{'' if k == 1 else k}" for k in range(1, depth + 2)]
    for r in got.collect():
        ds = [r[c] for c in tcols]
        assert all(a > b for a, b in zip(ds, ds[1:]))


def test_repeated_id_multiplies_and_same_day_never_links(spark):
    rows = [
        (1, "A", "2000-01-05", 10.0, 10.0),
        (2, "A", "2000-01-03", 10.0, 10.0),
        (2, "A", "2000-01-03", 10.0, 10.0),  # repeated row
        (3, "A", "2000-01-05", 10.0, 10.0),  # same day as the root
        (4, "B", "2000-01-01", 10.5, 10.0),
    ]
    ev = make_events(spark, rows)
    t = trail(ev, 1, 2, "geo", 100.0)
    assert sorted((r.e_id2, r.e_id3) for r in t.collect()) == [(2, 4), (2, 4)]
    c = count_trails(ev, ev.where("e_id = 1"), depth=2, max_km=100.0).first()
    assert c.trails == 2


def test_root_without_predecessor(spark):
    ev = make_events(spark, [(1, "A", "2000-01-01", 1.0, 1.0), (2, "B", "2000-01-02", 1.0, 1.0)])
    assert trail(ev, 1, 2, "geo", 100.0).count() == 0
    nodes, edges = trail_graph(ev, 1, 2, 100.0)
    assert nodes.count() == 0 and edges.count() == 0
    assert count_trails(ev, ev.where("e_id = 1"), depth=2).first().trails == 0


def test_outer_first_hop(spark):
    ev = make_events(spark, [(1, "A", "2000-01-05", 1.0, 1.0), (2, "B", "2000-01-02", 1.0, 1.0)])
    out = hop_actor(ev.where("e_id = 1"), ev, how="left").collect()
    assert len(out) == 1 and out[0].e_id2 is None
    assert trail_two_hop(ev, 1, 500.0).count() == 0


def test_two_hop_different_actor(spark):
    rows = [
        (1, "A", "2000-01-05", 1.0, 1.0),
        (2, "A", "2000-01-04", 1.0, 1.0),
        (3, "A", "2000-01-02", 1.0, 1.0),  # same actor: excluded on hop 2
        (4, "B", "2000-01-03", 1.5, 1.0),
        (5, "C", "2000-01-01", 30.0, 30.0),  # too far
    ]
    ev = make_events(spark, rows)
    got = sorted((r.e_id2, r.e_id3) for r in trail_two_hop(ev, 1, 500.0).collect())
    assert got == [(2, 4)]


@pytest.mark.parametrize("depth,km,max_days", [(2, 150.0, None), (3, 150.0, None), (4, 250.0, 3), (6, 150.0, None)])
def test_counts_equal_enumeration(spark, depth, km, max_days):
    rows = random_rows(9, n=45)
    ev = make_events(spark, rows)
    got = {r.e_id: r.trails for r in count_trails(ev, ev, depth, km, max_days).collect()}
    for i, r in enumerate(rows):
        want = len(brute_trails(rows, [i], depth, "geo", km, max_days))
        assert got[r[0]] == want, (r, got[r[0]], want)


def test_most_related_roots_and_absent_actors(spark):
    rows = random_rows(13, n=40)
    ev = make_events(spark, rows)
    got = {r.actor: r.related_events for r in most_related(ev, depth=2, max_km=150.0).collect()}
    want = {}
    for a in {r[1] for r in rows}:
        mine = [i for i, r in enumerate(rows) if r[1] == a]
        root = max(mine, key=lambda i: (rows[i][2], rows[i][0]))
        n = len(brute_trails(rows, [root], 2, "geo", 150.0))
        if n:
            want[a] = n
    assert got == want


@pytest.mark.parametrize("second,km,max_days,depth", [("geo", 150.0, None, 3), ("city", None, 4, 3)])
def test_graph_equals_distinct_over_trails(spark, second, km, max_days, depth):
    rows = random_rows(21, n=50, city=second == "city")
    ev = make_events(spark, rows, places=True)
    root_i = max(range(len(rows)), key=lambda i: (rows[i][2], rows[i][0]))
    root_id = rows[root_i][0]
    nodes, edges = trail_graph(ev, root_id, depth, km or 0.0, second, max_days)
    got_edges = {(r.Source, r.Target, r.Label) for r in edges.collect()}
    want_edges, want_nodes = set(), set()
    for d in range(1, depth + 1):
        for t in brute_trails(rows, [root_i], d, second, km or 0.0, max_days):
            a, b = rows[t[-2]], rows[t[-1]]
            label = a[1] if d % 2 == 1 else "Location"
            want_edges.add((str(a[0]), str(b[0]), label))
            want_nodes.add(str(b[0]))
            if d == 1:
                want_nodes.add(str(a[0]))
    assert got_edges == want_edges
    assert {r.Id for r in nodes.collect()} == want_nodes
    if second == "geo":
        root = [r for r in nodes.collect() if r.Id == str(root_id)]
        assert all(r.Label == rows[root_i][1] for r in root)
        assert all(float(r.lat) == rows[root_i][3] for r in root)


def test_located_filter(spark):
    ev = make_events(spark, [(1, "A", "2000-01-01", None, None), (2, "A", "2000-01-01", 0.0, 0.0)])
    assert [r.e_id for r in located(ev).collect()] == [2]


def test_trail_checkpoint_every_same_result(spark):
    rows = random_rows(31, n=50)
    ev = make_events(spark, rows)
    root = max(rows, key=lambda r: (r[2], r[0]))[0]
    a = trail(ev, root, 4, "geo", 250.0, 4)
    b = trail(ev, root, 4, "geo", 250.0, 4, checkpoint_every=2)
    assert a.columns == b.columns
    assert sorted(a.collect()) == sorted(b.collect())


def test_counts_cell_split_equal(spark):
    rnd = random.Random(77)
    rows = [
        (i + 1, f"A{rnd.randrange(4)}", D(f"2000-01-{1 + rnd.randrange(9)}"),
         round(rnd.uniform(0, 3), 2), round(rnd.uniform(0, 3), 2))
        for i in range(60)
    ]
    ev = make_events(spark, rows)
    base = {r.e_id: r.trails for r in count_trails(ev, ev, 4, 150.0).collect()}
    split = {r.e_id: r.trails for r in count_trails(ev, ev, 4, 150.0, cell_split=3).collect()}
    assert base == split
    for i in range(0, 60, 7):
        assert base[rows[i][0]] == len(brute_trails(rows, [i], 4, "geo", 150.0))


def test_geo_hop_across_antimeridian_and_pole(spark):
    from eventtrails.operators.hops import hop_geo

    rows = [
        (1, "A", "2000-01-05", 0.0, 179.9),
        (2, "B", "2000-01-04", 0.0, -179.9),   # 22 km away across the antimeridian
        (3, "C", "2000-01-03", 0.0, 170.0),    # 1,100 km away
        (4, "A", "2000-01-05", 89.95, 0.0),
        (5, "D", "2000-01-02", 89.95, 180.0),  # 11 km away across the pole
        (6, "E", "2000-01-06", 0.0, -179.9),   # later: never a predecessor
    ]
    ev = make_events(spark, rows)
    got = sorted((r.e_id, r.e_id2) for r in hop_geo(ev.where("e_id in (1, 4)"), ev, 1, 50.0).collect())
    assert got == [(1, 2), (4, 5)]


def test_roots_as_list_of_ids(spark):
    rows = random_rows(41, n=40)
    ev = make_events(spark, rows)
    ids = [rows[-1][0], rows[-2][0]]
    a = trail(ev, ids, 2, "geo", 150.0)
    b = trail(ev, ev.where(F.col("e_id").isin(ids)), 2, "geo", 150.0)
    assert sorted(a.collect()) == sorted(b.collect())


def test_undated_events_are_on_no_trail(spark):
    rows = [
        (1, "A", "2000-01-05", 1.0, 1.0),
        (2, "A", None, 1.0, 1.0),          # no date: never earlier, never later
        (3, "A", "2000-01-03", 1.0, 1.0),
        (4, "B", "2000-01-02", 1.0, 1.0),
    ]
    ev = make_events(spark, rows)
    got = {r.e_id: r.trails for r in count_trails(ev, ev.where("e_id in (1, 3)"), 2, 100.0).collect()}
    assert got == {1: 1, 3: 0}  # 1 -> 3 -> 4; 3 has no dated earlier event of A
    assert sorted((r.e_id2, r.e_id3) for r in trail(ev, 1, 2, "geo", 100.0).collect()) == [(3, 4)]


def test_trail_counts_per_key(spark):
    from eventtrails.plans.counts import trail_counts

    rows = random_rows(51, n=40)
    ev = make_events(spark, rows)
    per_key = {(r.actor, r.time_norm, r.lat, r.lon): (r.m, r.f) for r in trail_counts(ev, 3, 150.0).collect()}
    for i, r in enumerate(rows):
        m, f = per_key[(r[1], r[2], r[3], r[4])]
        assert f == len(brute_trails(rows, [i], 3, "geo", 150.0))
    assert sum(m for m, _ in per_key.values()) == len(rows)


def test_trail_different_actor(spark):
    rows = random_rows(61, n=45)
    ev = make_events(spark, rows)
    root_i = max(range(len(rows)), key=lambda i: (rows[i][2], rows[i][0]))
    got = sorted(tuple(r[c] for c in ("e_id", "e_id2", "e_id3", "e_id4"))
                 for r in trail(ev, rows[root_i][0], 3, "geo", 150.0, different_actor=True).collect())
    want = sorted(tuple(rows[i][0] for i in t) for t in brute_trails(rows, [root_i], 3, "geo", 150.0)
                  if rows[t[1]][1] != rows[t[2]][1])
    assert got == want


def test_counts_with_nan_place(spark):
    import math

    rows = [(1, "A", "2000-01-05", 1.0, 1.0), (2, "A", "2000-01-04", math.nan, 1.0),
            (3, "B", "2000-01-03", 1.0, 1.0), (4, "A", "2000-01-03", 1.0, 1.0)]
    ev = make_events(spark, rows)
    for split in (None, 2):
        got = {r.e_id: r.trails for r in count_trails(ev, ev.where("e_id = 1"), 2, 100.0, cell_split=split).collect()}
        # 1 -> 2 (NaN place: near nothing) -> none; 1 -> 4 -> none (3 is not earlier than 4)
        assert got == {1: 0}
    got = {r.e_id: r.trails for r in count_trails(ev, ev.where("e_id = 1"), 1, 100.0).collect()}
    assert got == {1: 2}  # the actor hop alone reaches 2 and 4; a NaN place does not matter there


@pytest.mark.parametrize("year", [1943, 1150, 2])
def test_reference_parameters_in_any_year(spark, year):
    """Depth 6 and 73,000 days: the window leaves the calendar, the trails stay."""
    rows = [(i, "AB"[i % 2], f"{year:04d}-{1 + i // 20:02d}-{1 + i % 20:02d}", 10.0 + (i % 3), 10.0) for i in range(11)]
    ev = make_events(spark, [(a, b, dt.date(*map(int, c.split("-"))), d, e) for a, b, c, d, e in rows])
    for root_id in (10, 9):
        a = sorted(map(tuple, trail(ev, root_id, 6, "geo", 500.0, 365 * 200).collect()))
        b = sorted(map(tuple, trail(ev, root_id, 6, "geo", 500.0, 365 * 200, prune=False).collect()))
        assert a == b and a
    c = trail(ev.withColumn("city", F.lit("C")), 10, 2, "city", max_days=365 * 200)
    assert c.count() > 0


def test_early_date_bounds_are_pushed(spark, tmp_path):
    from eventtrails.plans.search import time_interval
    from eventtrails.sinks import write_events_table
    from eventtrails.sources import read_events_table

    ev = make_events(spark, [(1, "A", dt.date(664, 1, 1), 1.0, 1.0), (2, "A", dt.date(663, 12, 31), 1.0, 1.0)])
    write_events_table(ev, str(tmp_path / "t"))
    got = time_interval(read_events_table(spark, str(tmp_path / "t")), "0664-01-01", order=False)
    assert [r.e_id for r in got.collect()] == [1]
    assert "GreaterThanOrEqual(time_norm,0664-01-01)" in got._jdf.queryExecution().executedPlan().toString()


def test_counts_beyond_64_bits_are_exact_or_fail(spark):
    """24,000 rows of one actor at one place, 400 a day: C(59, depth) * 400 ** depth."""
    from .test_skew import conf

    from math import comb

    days = spark.range(60).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(400))))
    ev = days.select(
        (F.col("id") * 400 + F.col("n")).cast("int").alias("e_id"), F.lit("P").alias("geo_name"), F.array(F.lit(1.0).cast("float"), F.lit(1.0).cast("float")).alias("loc"),
        F.lit(1.0).cast("float").alias("lat"), F.lit(1.0).cast("float").alias("lon"), F.lit(None).cast("int").alias("geonamesid"), F.lit("t").alias("time"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("time_norm"), F.lit("A").alias("actor"),
    )
    for ansi in ("true", "false"):
        with conf(spark, {"spark.sql.ansi.enabled": ansi}):
            assert [int(r.related_events) for r in most_related(ev, 6, 100.0).collect()] == [comb(59, 6) * 400**6]
            with pytest.raises(Exception, match="overflow"):
                most_related(ev, 14, 100.0).collect()
            with pytest.raises(Exception, match="overflow"):
                most_related(ev, 8, 100.0, exact=False).collect()


def test_id_root_is_broadcast_and_events_stay(spark, tmp_path):
    """A one-row root joins by broadcast even at a tiny limit: no event-side shuffle."""
    from .test_skew import conf

    from eventtrails.sinks import write_events_table
    from eventtrails.sources import read_events_table

    rows = random_rows(5, n=60)
    write_events_table(make_events(spark, rows), str(tmp_path / "t"))
    ev = read_events_table(spark, str(tmp_path / "t"))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "20k", "spark.sql.adaptive.enabled": "false"}):
        plan = trail(ev, rows[0][0], 1, "geo", 500.0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_salt_needs_an_inner_join(spark):
    from eventtrails.operators.hops import hop_actor

    ev = make_events(spark, random_rows(3, n=5)).select("e_id", "time_norm", "actor", "lat", "lon")
    with pytest.raises(ValueError, match="inner"):
        hop_actor(ev, ev, how="left", salt=3)


def test_intermediate_tables_are_dropped(spark):
    from eventtrails.plans.graph import trail_graph
    from eventtrails.session import drop_intermediates, shared_dir

    drop_intermediates(spark)
    here = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(here))  # the folder may hold other applications' tables
    rows = random_rows(4, n=40)
    nodes, _ = trail_graph(make_events(spark, rows), rows[0][0], 3, 150.0)
    nodes.count()
    assert set(os.listdir(here)) > before
    drop_intermediates(spark)
    assert set(os.listdir(here)) == before


def _brute_graph(rows, roots, depth, km, max_days=None):
    edges, nodes = set(), set()
    for d in range(1, depth + 1):
        for t in brute_trails(rows, roots, d, "geo", km, max_days):
            a, b = rows[t[-2]], rows[t[-1]]
            edges.add((str(a[0]), str(b[0]), a[1] if d % 2 == 1 else "Location"))
            nodes.add((str(b[0]), f"{b[1]} - P{b[0]} - {b[2]}"))
            if d == 1:
                nodes.add((str(a[0]), a[1]))
    return edges, nodes


@pytest.mark.parametrize("depth", [4, 6])
def test_deep_graph_expands_an_event_twice_at_most(spark, monkeypatch, depth):
    from collections import Counter

    from eventtrails.plans import graph

    rows = random_rows(5, n=36)
    # several roots, one of them on another's trails; an id twice; an actor named as the label
    rows += [(*rows[3][:2], rows[9][2], *rows[7][3:]), (990, "Location", rows[1][2], *rows[1][3:]), (991, "Location", rows[2][2], *rows[2][3:])]
    ev = make_events(spark, rows, places=True)
    order = sorted(range(len(rows)), key=lambda i: rows[i][2])
    roots = [order[-1], order[-2], order[len(order) // 2]]
    ids = [rows[i][0] for i in roots]
    assert len([r for r in rows if r[0] in ids]) == 3
    expanded = Counter()
    for name in ("hop_actor", "hop_geo"):
        real = getattr(graph, name)

        def seen(left, *args, _real=real, _name=name, **kw):
            expanded.update((_name, tuple(r)) for r in left.collect())
            return _real(left, *args, **kw)

        monkeypatch.setattr(graph, name, seen)
    frame = ev.where(F.col("e_id").isin(ids))
    nodes, edges = trail_graph(ev, frame, depth, 150.0)
    want_edges, want_nodes = _brute_graph(rows, roots, depth, 150.0)
    got = [tuple(r) for r in edges.collect()]
    assert set(got) == want_edges and len(got) == len(want_edges)
    assert {(r.Id, r.Label) for r in nodes.collect()} == want_nodes
    root_rows = {tuple(r) for r in frame.select(*graph._FRONTIER).collect()}
    assert all(n <= (2 if row in root_rows else 1) for (_, row), n in expanded.items())


def test_graph_ends_where_no_event_is_new(spark, monkeypatch):
    from eventtrails.plans import graph

    calls = []
    real = graph.hop_geo
    monkeypatch.setattr(graph, "hop_geo", lambda *a, **k: calls.append(1) or real(*a, **k))
    rows = [(1, "A", "2000-01-05", 0.0, 0.0), (2, "A", "2000-01-04", 0.0, 0.0), (3, "B", "2000-01-03", 0.0, 0.0)]
    _, edges = trail_graph(make_events(spark, rows), 1, 40, 10.0)
    assert {tuple(r) for r in edges.collect()} == {("1", "2", "A"), ("2", "3", "Location")}
    assert len(calls) == 1


@pytest.mark.parametrize("second,max_days,depth", [("geo", None, 3), ("geo", 3, 2), ("city", 4, 4), ("geo", 2, 1)])
@pytest.mark.parametrize("columns", [None, ["actor"], ["e_id", "actor2"]])
def test_grouped_trails_are_the_trails_counted(spark, second, max_days, depth, columns):
    rows = random_rows(11, n=40, city=True)
    rows += rows[4:7] + [(990, "A", None, 0.0, 0.0, "C0")]
    ev = make_events(spark, rows, places=True)
    last = f"time_norm{depth + 1}"
    columns = [*(columns or []), last]
    whole = trail(ev, ev, depth, second, 150.0, max_days)
    want = Counter(tuple(r) for r in whole.select(*columns).collect())
    got = trail(ev, ev, depth, second, 150.0, max_days, columns=columns, order=True)
    assert sorted(got.columns) == sorted([*columns, "trails"])
    found = [tuple(r) for r in got.select(*columns, "trails").collect()]
    assert len(found) == len(want) and {r[:-1]: r[-1] for r in found} == dict(want)
    dates = [r[-2] for r in found]
    assert dates == sorted(dates)


def test_grouped_trails_write_no_trail(spark, tmp_path):
    """300 x 300 x 300 trails of one date: a few rows of places, not 27 million trails."""
    from eventtrails.operators.ranking import positions

    day = lambda d: [(1000 * d + i, "A", f"2000-01-0{d}", 1.0, 1.0) for i in range(300)]
    ev = make_events(spark, day(1) + day(2) + day(3))
    out = trail(ev, ev.where("e_id >= 3000"), 2, "geo", 50.0, 2, order=True, columns=["time_norm3"])
    placed = positions(out, weight="trails").collect()
    assert [(r.position, r.trails) for r in placed] == [(1, 300**3)]
    with pytest.raises(ValueError):
        trail(ev, ev, 2, columns=["gps_diff2"])
    with pytest.raises(ValueError):
        trail(ev, ev, 2, columns=["time_norm3"], different_actor=True)


def test_weighted_positions(spark):
    from eventtrails.operators.ranking import positions

    df = spark.createDataFrame([(i, i % 4) for i in range(40)], "k int, n int").repartition(6).orderBy("k")
    rows = positions(df, weight="n").orderBy("k").collect()
    before = 0
    for r in rows:
        assert r.position == before + 1
        before += r.n


@pytest.mark.parametrize("second", ["geo", "city"])
def test_graph_writes_no_pairs(spark, monkeypatch, second):
    """160,000 edges between 800 events: what is written follows the events."""
    from eventtrails.operators import hops
    from eventtrails.plans import graph

    written = []
    for module in (graph, hops):
        real = module.cut_lineage

        def seen(df, _real=real):
            out = _real(df)
            written.append(out.count())
            return out

        monkeypatch.setattr(module, "cut_lineage", seen)
    rows = [(i, "A" if i % 2 else "B", f"2000-01-0{1 + i // 400}", 1.0, 1.0, "X") for i in range(800)]
    rows.append((900, "A", "2000-01-09", 1.0, 1.0, "X"))
    _, edges = trail_graph(make_events(spark, rows, places=True), 900, 2, 50.0, second)
    assert edges.count() == 400 + 200 * 400
    assert max(written) <= 801


@pytest.mark.parametrize("max_days", [None, 1, 2, 5])
def test_reached_events_are_the_targets(spark, max_days):
    from eventtrails.operators import hop_actor, hop_geo
    from eventtrails.operators.frontier import reached

    rows = random_rows(21, n=60) + [(990, "A", None, 0.0, 0.0), (991, None, "2000-01-02", 0.0, 0.0)]
    ev = make_events(spark, rows).select("e_id", "time_norm", "actor", "lat", "lon")
    left = ev.where("e_id % 3 = 0")
    ids = lambda df, c="e_id": sorted({r[0] for r in df.select(c).collect()})
    pairs = hop_actor(left, ev, 1, max_days)
    got = reached(ev, left, ["actor"], max_days)
    assert ids(got) == ids(pairs, "e_id2") and got.count() == len(ids(got))
    assert ids(reached(left, ev, ["actor"], max_days, later=True)) == ids(pairs)
    near = reached(ev, left, ["lat", "lon"], max_days, 150.0, ev.select("lat", "lon"))
    assert ids(near) == ids(hop_geo(left, ev, 1, 150.0, max_days), "e_id2")
