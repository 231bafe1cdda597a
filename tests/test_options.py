"""Options not covered by the oracle queries."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from eventtrails.plans.counts import count_trails, most_related
from eventtrails.plans.places import enrich_places
from eventtrails.plans.search import actor_timeline, to_nodes

from .conftest import D, make_events


def _rows(seed=4, n=40):
    rnd = random.Random(seed)
    return [
        (i + 1, f"A{rnd.randrange(4)}", D(f"2000-01-{1 + rnd.randrange(9)}"),
         rnd.choice([0, 1, 2]) * 1.0, rnd.choice([0, 1]) * 1.0)
        for i in range(n)
    ]


def test_exact_counts_equal_bigint(spark):
    ev = make_events(spark, _rows())
    a = {r.e_id: r.trails for r in count_trails(ev, ev, 5, 150.0).collect()}
    b = {r.e_id: r.trails for r in count_trails(ev, ev, 5, 150.0, exact=True).collect()}
    assert dict((k, int(v)) for k, v in b.items()) == a
    assert dict(count_trails(ev, ev, 2, 150.0, exact=True).dtypes)["trails"] == "decimal(38,0)"


def test_most_related_limit_is_top_k(spark):
    ev = make_events(spark, _rows())
    full = most_related(ev, 2, 150.0).collect()
    top = most_related(ev, 2, 150.0, limit=2).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in full[:2]]
    counts = [r.related_events for r in full]
    assert counts == sorted(counts, reverse=True)


def test_enrich_nearest_with_tie_and_range(spark):
    ev = make_events(spark, [(1, "A", "2000-01-01", 10.0, 10.0), (2, "A", "2000-01-02", None, None),
                             (3, "B", "2000-01-03", 40.0, 40.0)])
    gz = spark.createDataFrame(
        [(7, 10.0, 10.1, "East", "X"), (5, 10.0, 9.9, "West", "Y"), (9, 10.3, 10.0, "North", "Z")],
        "place_id int, lat double, lon double, city string, country string",
    )
    got = {r.e_id: (r.city, r.country) for r in enrich_places(ev, gz, 50.0).collect()}
    # East and West are equally near: the smaller place_id wins; nothing near (40, 40)
    assert got == {1: ("West", "Y"), 2: (None, None), 3: (None, None)}


def test_nodes_without_actor_and_timeline_order(spark):
    ev = make_events(spark, [(2, "A", "2000-01-02", 1.0, 1.0), (1, "A", "2000-01-02", 1.0, 1.0),
                             (3, "A", "2000-01-01", None, None), (4, "B", "2000-01-01", 1.0, 1.0)])
    labels = {r.Id: r.Label for r in to_nodes(ev, with_actor=False).collect()}
    assert labels["1"] == "P1 - 2000-01-02"
    assert {r.Id: r.Label for r in to_nodes(ev).collect()}["4"] == "B - P4 - 2000-01-01"
    tl = actor_timeline(ev, "A").collect()
    assert [(r.e_id, r.time_norm) for r in tl] == [(3, dt.date(2000, 1, 1)), (1, dt.date(2000, 1, 2)),
                                                   (2, dt.date(2000, 1, 2))]
    assert tl[0].geo_name == "P3" and all(r.actor == "A" for r in tl)
    assert ev.where(F.col("actor") == "B").count() == 1


def test_depth_validation(spark):
    import pytest

    from eventtrails.plans.graph import trail_graph
    from eventtrails.plans.trails import trail

    ev = make_events(spark, _rows(n=5))
    with pytest.raises(ValueError):
        trail_graph(ev, 1, 0)
    with pytest.raises(ValueError):
        trail(ev, 1, -1)
    with pytest.raises(ValueError):
        count_trails(ev, depth=0)
    assert trail(ev, 1, 0).columns == ["e_id", "time_norm", "actor"]


def test_scale_conf():
    from eventtrails.session import scale_conf

    c = scale_conf(100 * 10**12, executor_cores=4)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 4 == 0 and 23_000 < parts < 24_000
    moved = scale_conf(100 * 10**12, executor_cores=4, shuffle_bytes=10**12)
    assert 3_700 < int(moved["spark.sql.shuffle.partitions"]) < 3_800
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(scale_conf(10, executor_cores=8)["spark.sql.shuffle.partitions"]) == 8


def test_positions_follow_a_sorted_frame(spark):
    from pyspark.sql import functions as F

    from eventtrails.operators import positions

    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), "id").repartition(5)
    rows = positions(df.orderBy(F.col("k").desc())).collect()
    by_place = [r.k for r in sorted(rows, key=lambda r: r.position)]
    assert by_place == sorted((r.k for r in rows), reverse=True)
    assert sorted(r.position for r in rows) == list(range(1, 5001))
    assert positions(df.limit(0)).count() == 0
