"""Hot keys: one actor and one place hold well over a third of all rows.

Broadcasts are disabled and AQE's skew thresholds forced tiny, so the joins
run as sort-merge joins whose hot partitions AQE splits; results must still
equal brute force.
"""

from __future__ import annotations

import contextlib
import random

import pytest

from eventtrails.plans.counts import count_trails
from eventtrails.plans.graph import trail_graph
from eventtrails.plans.trails import trail

from .conftest import D, make_events
from .test_trails import brute_trails

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_rows(seed=3, n=90):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 2 == 0:  # half the rows: one actor at one place
            r = (i + 1, "HOT", D(f"2000-01-{1 + rnd.randrange(9)}"), 1.0, 1.0)
        else:
            r = (i + 1, f"A{rnd.randrange(5)}", D(f"2000-01-{1 + rnd.randrange(9)}"),
                 rnd.choice([0, 1, 2]) * 1.0, rnd.choice([0, 1, 2]) * 1.0)
        rows.append(r)
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    rows = skewed_rows()
    return rows, make_events(spark, rows).repartition(6)


def test_counts_with_hot_keys(spark, skewed):
    rows, ev = skewed
    with conf(spark, SKEW_CONF):
        got = {r.e_id: r.trails for r in count_trails(ev, ev, 4, 150.0, None).collect()}
    for i, r in enumerate(rows):
        assert got[r[0]] == len(brute_trails(rows, [i], 4, "geo", 150.0, None))


def test_trail_and_graph_with_hot_keys(spark, skewed):
    rows, ev = skewed
    root_i = max((i for i, r in enumerate(rows) if r[1] == "HOT"), key=lambda i: (rows[i][2], rows[i][0]))
    with conf(spark, SKEW_CONF):
        t = trail(ev, rows[root_i][0], 3, "geo", 150.0, 3)
        got = sorted(tuple(r[c] for c in ("e_id", "e_id2", "e_id3", "e_id4")) for r in t.collect())
        nodes, edges = trail_graph(ev, rows[root_i][0], 3, 150.0)
        got_edges = {(r.Source, r.Target) for r in edges.collect()}
    want = sorted(tuple(rows[i][0] for i in tr) for tr in brute_trails(rows, [root_i], 3, "geo", 150.0, 3))
    assert got == want
    want_edges = set()
    for d in (1, 2, 3):
        for tr in brute_trails(rows, [root_i], d, "geo", 150.0, None):
            want_edges.add((str(rows[tr[-2]][0]), str(rows[tr[-1]][0])))
    assert got_edges == want_edges


def test_salted_hops_equal_plain(spark, skewed):
    from eventtrails.operators.hops import hop_actor

    rows, ev = skewed
    root_i = max((i for i, r in enumerate(rows) if r[1] == "HOT"), key=lambda i: (rows[i][2], rows[i][0]))
    with conf(spark, SKEW_CONF):
        a = trail(ev, rows[root_i][0], 3, "geo", 150.0)
        b = trail(ev, rows[root_i][0], 3, "geo", 150.0, salt=5)
        assert sorted(a.collect()) == sorted(b.collect())
        plain = hop_actor(ev, ev).select("e_id", "e_id2")
        salted = hop_actor(ev, ev, salt=7).select("e_id", "e_id2")
        assert sorted(plain.collect()) == sorted(salted.collect())


def test_salted_graph_equals_plain(spark, skewed):
    rows, ev = skewed
    root = max((r for r in rows if r[1] == "HOT"), key=lambda r: (r[2], r[0]))[0]
    a = trail_graph(ev, root, 3, 150.0)[1]
    b = trail_graph(ev, root, 3, 150.0, salt=4)[1]
    assert sorted(a.collect()) == sorted(b.collect())


def test_hot_key_salting(spark, skewed):
    from eventtrails.operators.hops import hop_actor, hot_keys

    rows, ev = skewed
    assert hot_keys(ev, "actor", 0.3) == ["HOT"]  # half the rows
    assert hot_keys(ev, "actor", 0.6) == []
    plain = sorted(hop_actor(ev, ev).select("e_id", "e_id2").collect())
    assert sorted(hop_actor(ev, ev, salt=6, hot=["HOT"]).select("e_id", "e_id2").collect()) == plain
    root = max((r for r in rows if r[1] == "HOT"), key=lambda r: (r[2], r[0]))[0]
    with conf(spark, SKEW_CONF):
        a = trail(ev, root, 3, "geo", 150.0)
        b = trail(ev, root, 3, "geo", 150.0, salt=5, hot_fraction=0.3)
        assert sorted(a.collect()) == sorted(b.collect())
        ga = trail_graph(ev, root, 3, 150.0)[1]
        gb = trail_graph(ev, root, 3, 150.0, salt=5, hot_fraction=0.3)[1]
        assert sorted(ga.collect()) == sorted(gb.collect())


@pytest.mark.parametrize("max_days,salt", [(None, 3), (4, None), (4, 5)])
def test_outer_hop_splits_a_hot_actor(spark, skewed, max_days, salt):
    from eventtrails.operators.hops import hop_actor, hop_actor_outer

    _, ev = skewed
    ev = ev.select("e_id", "time_norm", "actor", "lat", "lon")
    with conf(spark, SKEW_CONF):
        want = hop_actor(ev, ev, max_days=max_days, how="left")
        got = hop_actor_outer(ev, ev, max_days=max_days, salt=salt)
        assert sorted(got.columns) == sorted(want.columns)
        assert got.where("e_id2 is null").count() > 0
        assert got.exceptAll(want.select(got.columns)).isEmpty() and want.select(got.columns).exceptAll(got).isEmpty()


def test_two_hop_with_salts_equals_plain(spark, skewed):
    from eventtrails.plans.trails import trail_two_hop

    rows, ev = skewed
    root = max(rows, key=lambda r: r[2])[0]
    with conf(spark, SKEW_CONF):
        a, b = trail_two_hop(ev, root, 150.0), trail_two_hop(ev, root, 150.0, salt=4)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > 0


def test_hops_are_divided_by_their_pairs(spark, monkeypatch, tmp_path):
    """One city and one place with nearly all pairs: many tasks, none with many of them."""
    from pyspark.sql import functions as F

    from eventtrails.operators import hop_city, hop_geo, hops

    for name, value in (("LEAST_PAIRS", 100), ("MOST_PAIRS", 100), ("FEW_ROWS", 2)):
        monkeypatch.setattr(hops, name, value)
    rnd = random.Random(8)
    rows = [
        (i, f"A{i % 7}", f"2000-01-{1 + rnd.randrange(9)}", *((1.0, 1.0, "HOT") if i % 8 else (9.0, float(i % 3), f"C{i % 3}")))
        for i in range(120)
    ]
    rows += rows[5:9] + [(900, "A1", None, 1.0, 1.0, "HOT"), (901, "A2", "2000-01-09", 1.0, 1.0, None)]
    make_events(spark, rows, places=True).coalesce(1).write.parquet(f"{tmp_path}/events")
    ev = spark.read.parquet(f"{tmp_path}/events").select("e_id", "time_norm", "actor", "lat", "lon", "city")

    def seen(df):
        out = sorted(map(tuple, df.select("e_id", "time_norm", "e_id2", "time_norm2").collect()))
        return out, [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

    for days in (None, 3):
        for hop in (lambda **k: hop_city(ev, ev, 1, days, **k), lambda **k: hop_geo(ev, ev, 1, 150.0, days, **k)):
            want, before = seen(hop())
            got, after = seen(hop(spread=True))
            assert got == want and len(want) > 1000
            assert len(after) > 10 and max(after) < max(before) / 2


def test_no_grid_where_pairs_are_few(spark):
    from eventtrails.operators import hops

    df = spark.createDataFrame([(i, i % 3) for i in range(90)], "a int, k int")
    left, right, lk, rk = hops.spread_pairs(df, df, ["k"], ["k"])
    assert left is df and right is df and lk == ["k"] and rk == ["k"]
