"""File-stream source: the same parse and searches on arriving files."""

from __future__ import annotations

import datetime as dt
import os

from eventtrails.plans.search import time_interval
from eventtrails.streaming import read_events_stream

HEADER = "e_id;geo_name;loc;geonamesid;time;time_norm;actor"


def test_stream_time_interval(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    (src / "a.csv").write_text(
        HEADER + "\n1;A;[u'1.0 2.0'];;t;2000-01-01;X\n2;B;[u''];;t;2000-01-02;Y\n"
    )
    (src / "b.csv").write_text(HEADER + "\n3;C;[u'3.0 4.0'];7;t;2000-1-3;Z\n4;D;[u'5.0 6.0'];;t;1999-12-31;Z\n")
    ev = read_events_stream(spark, str(src))
    assert ev.isStreaming
    q = (
        time_interval(ev, "2000-01-01", "2000-01-31", order=False)
        .writeStream.format("memory")
        .queryName("et_stream_interval")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = sorted((r.e_id, r.time_norm) for r in spark.table("et_stream_interval").collect())
    assert got == [(1, dt.date(2000, 1, 1)), (3, dt.date(2000, 1, 3))]


def test_enrich_stream(spark, tmp_path):
    from eventtrails.sources import read_events
    from eventtrails.streaming import enrich_stream

    src = tmp_path / "in"
    os.makedirs(src)
    (src / "a.csv").write_text(HEADER + "\n1;A;[u'10.0 10.0'];;t;2000-01-01;X\n2;B;[u''];;t;2000-01-02;Y\n")
    gz = spark.createDataFrame([(1, 10.05, 10.0, "Town", "Land")], "place_id int, lat double, lon double, city string, country string")
    q = enrich_stream(read_events_stream(spark, str(src)), gz, str(tmp_path / "out"), str(tmp_path / "ck"),
                      trigger={"availableNow": True})
    q.awaitTermination(120)
    got = sorted((r.e_id, r.city, r.country) for r in read_events(spark, str(tmp_path / "out"), places=True).collect())
    assert got == [(1, "Town", "Land"), (2, None, None)]
