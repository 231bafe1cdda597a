"""The command line runs a query end to end on a text file."""

from __future__ import annotations

from eventtrails.cli import main
from eventtrails.sinks import write_events_text
from eventtrails.sources.fixture import fixture_events, fixture_gazetteer

from .conftest import SF_SMALL


def _read_csv(spark, path):
    return spark.read.option("sep", ";").option("header", True).csv(path)


def test_cli_queries(spark, tmp_path):
    src = str(tmp_path / "events")
    write_events_text(fixture_events(spark, SF_SMALL, raw_blank=True), src, places=True)
    out = str(tmp_path / "ti")
    assert main(["time-interval", "--events", src, "--out", out, "--start", "2024-01-10", "--end", "2024-01-15",
                 "--single-file"]) == 0
    got = _read_csv(spark, out)
    assert got.columns == ["e_id", "actor", "geo_name", "time_norm"] and got.count() > 0
    out = str(tmp_path / "ac")
    main(["actor-countries", "--events", src, "--out", out, "--actor", "USER_7"])
    assert _read_csv(spark, out).columns == ["e_id", "actor", "geo_name", "time_norm", "country"]
    out = str(tmp_path / "mr")
    main(["most-related", "--events", src, "--out", out, "--depth", "2"])
    assert _read_csv(spark, out).columns == ["actor", "related_events"]
    out = str(tmp_path / "g")
    main(["graph", "--events", src, "--out", out, "--root", "999", "--depth", "2"])
    assert _read_csv(spark, out + "/edges").columns == ["Source", "Target", "Label"]
    gz = str(tmp_path / "gz")
    fixture_gazetteer(spark, SF_SMALL).write.parquet(gz)
    out = str(tmp_path / "en")
    main(["enrich", "--events", src, "--out", out, "--gazetteer", gz])
    from eventtrails.sources import read_events

    back = read_events(spark, out, places=True)
    assert back.count() == fixture_events(spark, SF_SMALL).count()
    assert back.where("city IS NOT NULL").count() == back.where("lat IS NOT NULL").count()


def test_cli_trails_and_near(spark, tmp_path):
    src = str(tmp_path / "events")
    write_events_text(fixture_events(spark, SF_SMALL, raw_blank=True), src, places=True)
    out = str(tmp_path / "near")
    main(["near", "--events", src, "--out", out, "--lat", "40", "--lon", "-104", "--km", "500", "--actor", "USER_7"])
    assert _read_csv(spark, out).columns == ["e_id", "actor", "time_norm", "gps_diff"]
    out = str(tmp_path / "trail")
    main(["trail", "--events", src, "--out", out, "--root", "999", "--depth", "2", "--km", "500", "--max-days", "3"])
    assert _read_csv(spark, out).columns == [
        "e_id", "time_norm", "actor", "e_id2", "time_norm2", "actor2", "date_diff",
        "e_id3", "time_norm3", "actor3", "date_diff2", "gps_diff2",
    ]
    out = str(tmp_path / "city")
    main(["trail", "--events", src, "--out", out, "--root", "999", "--depth", "2", "--second", "city"])
    assert _read_csv(spark, out).columns[-1] == "city2"
    out = str(tmp_path / "two")
    main(["two-hop", "--events", src, "--out", out, "--root", "999"])
    assert _read_csv(spark, out).columns == [
        "e_id", "actor", "time_norm", "e_id2", "actor2", "time_norm2", "e_id3", "actor3", "time_norm3"
    ]
