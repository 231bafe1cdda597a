"""The frontier filter: no lost pairs, few events left to shuffle; nearest places in rings."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from eventtrails.functions.geo import haversine_km
from eventtrails.operators import hop_actor, hop_city
from eventtrails.operators.frontier import reduce_to_frontier, too_large_to_broadcast
from eventtrails.plans import places
from eventtrails.plans.graph import trail_graph
from eventtrails.plans.trails import trail
from eventtrails.session import cut_lineage

from .conftest import D, make_events
from .test_skew import SKEW_CONF, conf, skewed_rows

PLAIN = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_events_of_the_frontiers_keys_are_shuffled(spark):
    # 100,000 frontier rows of 2,000 actors; 1,000,000 events of 200,000 actors
    def frame(n, actors, year):
        day = F.date_add(F.lit(D(f"{year}-01-01")), (F.col("id") % 300).cast("int"))
        return spark.range(n).select(
            F.col("id").cast("int").alias("e_id"), F.concat(F.lit("A"), F.col("id") % actors).alias("actor"), day.alias("time_norm")
        )

    left, events = cut_lineage(frame(100_000, 2_000, 2001)), cut_lineage(frame(1_000_000, 200_000, 2000))
    reachable = events.join(left.select("actor").distinct(), "actor", "left_semi").count()
    kept = reduce_to_frontier(events, left, "actor")
    assert reachable == 10_000
    assert reachable <= kept.count() <= 3 * reachable
    assert kept.join(left.select("actor").distinct(), "actor", "left_semi").count() == reachable
    with conf(spark, PLAIN):
        assert too_large_to_broadcast(left)
        # the filter is below the exchange of the events
        plan = plan_of(hop_actor(left, events, 1, reduce=True))
        assert plan.index("SortMergeJoin") < plan.rindex("Exchange hashpartitioning(actor2") < plan.index("LeftSemi")
        assert "LeftSemi" not in plan_of(hop_actor(left, events, 1))
    # within the broadcast limit the frontier itself is broadcast
    few = cut_lineage(left.limit(5))
    assert not too_large_to_broadcast(few)
    assert "LeftSemi" not in plan_of(hop_actor(few, events, 1, reduce=True))


def test_dates_bound_the_events(spark):
    left = make_events(spark, [(1, "A", "2000-06-01", 0.0, 0.0), (2, "A", "2000-05-01", 0.0, 0.0), (3, None, "2000-06-01", 0.0, 0.0)])
    days = ["2000-06-02", "2000-06-01", "2000-05-31", "2000-04-28", "2000-04-20", "1990-01-01"]
    events = make_events(spark, [(10 + i, "A", d, 0.0, 0.0) for i, d in enumerate(days)] + [(20, None, "1999-01-01", 0.0, 0.0)])

    def ids(df):
        return sorted(r.e_id for r in df.select("e_id").collect())

    assert ids(reduce_to_frontier(events, left, "actor")) == [12, 13, 14, 15]
    assert ids(reduce_to_frontier(events, left, "actor", max_days=5)) == [12, 13]
    assert ids(reduce_to_frontier(events, left.limit(0), "actor")) == []
    # one slot for every key: too many events, none too few
    assert ids(reduce_to_frontier(events, left, "actor", max_slots=1)) == [12, 13, 14, 15]


def test_hops_are_the_same_with_the_filter(spark):
    rows = [(*r, "x" if i % 3 else None) for i, r in enumerate(skewed_rows())]
    ev = cut_lineage(make_events(spark, rows, places=True).select("e_id", "actor", "time_norm", "lat", "lon", "city"))
    left = cut_lineage(ev.where("e_id % 4 = 0"))
    with conf(spark, SKEW_CONF):
        for hop in (hop_actor, hop_city):
            for kw in ({}, {"max_days": 3}, {"salt": 3}, {"how": "left"}):
                got, want = (sorted(map(str, hop(left, ev, 1, reduce=x, **kw).collect())) for x in (True, False))
                assert got == want and got


def test_trails_and_graphs_with_broadcasts_off(spark):
    ev = make_events(spark, [(*r, "x") for r in skewed_rows(n=40)], places=True)
    for second in ("geo", "city"):
        plain = sorted(map(str, trail(ev, 3, 3, second, 200.0).collect()))
        graph = [sorted(map(str, x.collect())) for x in trail_graph(ev, 3, 3, 200.0, second)]
        with conf(spark, SKEW_CONF):
            assert sorted(map(str, trail(ev, 3, 3, second, 200.0).collect())) == plain
            assert [sorted(map(str, x.collect())) for x in trail_graph(ev, 3, 3, 200.0, second)] == graph


def gazetteer(spark, rows):
    return spark.createDataFrame(rows, "place_id int, lat double, lon double, city string, country string")


def test_nearest_place_in_rings_on_a_dense_gazetteer(spark):
    rnd = random.Random(8)
    dense = [(i, 10 + rnd.random() / 2, 20 + rnd.random() / 2, f"c{i}", "X") for i in range(3000)]
    sparse = [(5000 + i, -40 + i * 0.3, 100.0, f"s{i}", "Y") for i in range(20)] + [(9000, 0.0, 180.0, "edge", "Z")]
    gz = cut_lineage(gazetteer(spark, dense + sparse))
    points = [(i, "A", "2000-01-01", 10 + rnd.random() / 2, 20 + rnd.random() / 2) for i in range(60)]
    points += [(100 + i, "A", "2000-01-01", -40 + i * 0.17, 100.1) for i in range(30)]
    points += [(200, "A", "2000-01-01", 0.0, -179.9), (201, "A", "2000-01-01", 60.0, 0.0), (202, "A", "2000-01-01", None, None)]
    ev = make_events(spark, points)
    radii = places.rings(gz, 50.0)
    assert len(radii) > 3 and radii[-1] == 50.0
    got = {r.e_id: r.city for r in places.enrich_places(ev, gz, 50.0).collect()}
    dist = haversine_km(F.col("p.lat"), F.col("p.lon"), F.col("g.lat"), F.col("g.lon"))
    pairs = ev.alias("p").crossJoin(gz.alias("g")).select("e_id", "place_id", "g.city", dist.alias("d")).where("d < 50")
    best = pairs.groupBy("e_id").agg(F.min(F.struct("d", "place_id", "city")).alias("b")).select("e_id", "b.city")
    want = {r.e_id: r.city for r in best.collect()}
    assert got == {p[0]: want.get(p[0]) for p in points}
    assert got[200] == "edge" and got[201] is None and got[202] is None
    # the first ring has few candidates a point, the full radius nearly all entries
    near = pairs.where(F.col("d") < radii[0]).groupBy("e_id").count().agg(F.max("count")).first()[0]
    assert near < 4 * places.CELL_ENTRIES < pairs.groupBy("e_id").count().agg(F.max("count")).first()[0]


def test_sparse_gazetteer_has_one_ring(spark):
    gz = gazetteer(spark, [(1, 0.0, 0.0, "a", "A"), (2, None, None, "b", "B")])
    assert places.rings(gz, 50.0) == [50.0] and places.rings(gz.limit(0), 50.0) == [50.0]
