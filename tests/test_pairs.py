"""Hops with many pairs: divided by no other keys than their own, in rows that store small."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from eventtrails.operators import hop_city, hop_geo, hops
from eventtrails.session import cut_lineage

from .test_skew import SKEW_CONF, conf


def stored(df, path) -> int:
    df.coalesce(1).write.parquet(path)
    return sum(os.path.getsize(f"{path}/{x}") for x in os.listdir(path) if x.endswith(".parquet"))


def frame(spark, n, first, actors, days):
    """``n`` rows in one city at three places, ids and actors in no order."""
    at = (F.xxhash64("id") % 3 + 3).cast("float")
    return cut_lineage(
        spark.range(first, first + n).select(
            F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)).cast("int").alias("e_id"),
            F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(days)).cast("int")).alias("time_norm"),
            F.concat(F.lit("USER_"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(actors))).alias("actor"),
            at.alias("lat"), at.alias("lon"), F.lit("HERE").alias("city"),
        )
    )


def test_many_pairs_store_small(spark, tmp_path):
    roots = frame(spark, 1500, 0, 1500, 1).withColumn("time_norm", F.date_add("time_norm", 40))
    events = frame(spark, 2000, 10_000, 700, 30)
    out = ["e_id", "city", "e_id2", "time_norm2", "actor2"]
    got = hop_city(roots, events, spread=True).select(*out)
    # the grid's cells, joined row by row
    left, right, lk, rk = hops.spread_pairs(roots, hops.suffix(events, 2), ["city"], ["city2"])
    plain = left.join(right, [F.col(a) == F.col(b) for a, b in zip(lk, rk)]).select(*out)
    assert stored(got, f"{tmp_path}/got") < stored(plain, f"{tmp_path}/plain") / 2
    a, b = spark.read.parquet(f"{tmp_path}/got"), spark.read.parquet(f"{tmp_path}/plain")
    assert a.count() == 3_000_000
    same = F.sum(F.xxhash64(*out).cast("decimal(38,0)"))
    assert a.agg(same).first() == b.agg(same).first()


def test_geo_hop_is_divided_by_places_once(spark, monkeypatch):
    for name, value in (("LEAST_PAIRS", 100), ("MOST_PAIRS", 100), ("FEW_ROWS", 2)):
        monkeypatch.setattr(hops, name, value)
    events = frame(spark, 300, 0, 20, 30)
    with conf(spark, SKEW_CONF):
        plan = hop_geo(events, events, 1, 50.0, spread=True)._jdf.queryExecution().executedPlan().toString()
    # float keys are rewritten by a join, which dealt the pairs out anew by bytes
    assert "Exchange" in plan and "ENSURE_REQUIREMENTS" not in plan.split("REPARTITION_BY_NUM")[0]


def test_packs_lose_no_null_date_or_key(spark, monkeypatch):
    for name, value in (("LEAST_PAIRS", 10), ("MOST_PAIRS", 500), ("FEW_ROWS", 2), ("PACK", 4)):
        monkeypatch.setattr(hops, name, value)
    ev = frame(spark, 80, 0, 6, 9)
    odd = ev.limit(9).withColumn("time_norm", F.lit(None).cast("date")).unionByName(ev.limit(7).withColumn("city", F.lit(None).cast("string")))
    ev = cut_lineage(ev.unionByName(odd).unionByName(ev.limit(5)))
    for days in (None, 3):
        for hop in (lambda **k: hop_city(ev, ev, 1, days, **k), lambda **k: hop_geo(ev, ev, 1, 50.0, days, **k)):
            got, want = hop(spread=True), hop()
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 100


def test_edges_take_targets_that_are_text_already(spark):
    from eventtrails.plans.graph import trail_graph

    events = frame(spark, 60, 0, 5, 30).withColumn("geo_name", F.lit("P"))
    last = events.orderBy(F.desc("time_norm"), "e_id").limit(1)
    edges = trail_graph(events, last, 3, 50.0)[1]
    # a cast here would be one for each pair, not for each event
    assert edges.count() > 0 and "as string) AS Target" not in edges._jdf.queryExecution().executedPlan().toString()
