"""Text format reader/writer: the edge rows of the original file format."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventtrails.sinks import write_csv, write_events_text
from eventtrails.sources import parse_lines, read_events

HEADER7 = "e_id;geo_name;loc;geonamesid;time;time_norm;actor"
HEADER9 = HEADER7 + ";city;country"


def lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "value string")


def test_parse_basic_and_edges(spark):
    df = parse_lines(
        lines(
            spark,
            HEADER7,
            "1701;Berlin;[u'52.52 13.405'];2950159;1943;1943-11-01;Some Actor",
            "2;Nowhere;[u''];;sometime;1943-1-5;",
            HEADER7,  # header again, mid-file
            "3;Short;[u'1';7;x;1800-12-31;Other Actor",  # loc of exactly 5 characters
            "3;Dup;[u'0.5 -179.9'];8;y;1800-01-02;Other Actor",  # repeated e_id
        )
    )
    rows = {(r.e_id, r.geo_name): r for r in df.collect()}
    assert len(rows) == 4
    r = rows[(1701, "Berlin")]
    assert r.loc == pytest.approx([52.52, 13.405], rel=1e-6)
    assert r.lat == pytest.approx(52.52, rel=1e-6) and r.lon == pytest.approx(13.405, rel=1e-6)
    assert r.geonamesid == 2950159 and r.time_norm == dt.date(1943, 11, 1)
    r = rows[(2, "Nowhere")]
    assert r.loc == [] and r.lat is None and r.geonamesid is None
    assert r.time_norm == dt.date(1943, 1, 5)  # unpadded month and day
    assert r.actor == ""  # empty text stays empty, not null
    assert rows[(3, "Short")].loc == []
    assert rows[(3, "Dup")].lon == pytest.approx(-179.9, rel=1e-6)


def test_nine_columns_blank_city(spark):
    src = lines(
        spark,
        HEADER9,
        "1;A;[u'1.0 2.0'];;t;2000-01-01;X;Paris;France",
        "2;B;[u''];;t;2000-01-02;X; ; ",
        "3;C;[u''];;t;2000-01-03;X;;",
    )
    norm = {r.e_id: (r.city, r.country) for r in parse_lines(src, places=True).collect()}
    assert norm == {1: ("Paris", "France"), 2: (None, None), 3: (None, None)}
    kept = {r.e_id: (r.city, r.country) for r in parse_lines(src, places=True, keep_blank=True).collect()}
    assert kept == {1: ("Paris", "France"), 2: (" ", " "), 3: (None, None)}
    # a 9-column file read as 7 columns ignores the extra fields
    assert parse_lines(src).count() == 3


def test_malformed_fails_or_nulls(spark):
    bad = lines(spark, "x1;A;[u''];;t;2000-01-01;X")
    with pytest.raises(PySparkException):
        parse_lines(bad).collect()
    assert parse_lines(bad, mode="permissive").collect()[0].e_id is None
    bad_date = lines(spark, "1;A;[u''];;t;2000-13-01;X")
    with pytest.raises(PySparkException):
        parse_lines(bad_date).collect()


@pytest.mark.parametrize("line", [";P;[u'1 2'];;t;2000-01-01;A", "1;P;[u'1 2'];;t;;A", "6;P", "6;P;[u'1 2'];;t;2000-01-01", ";;;;;;"])
def test_no_row_is_dropped_or_blanked(spark, line):
    """An empty id or date and a short line fail; a permissive read keeps the row."""
    with pytest.raises(PySparkException):
        parse_lines(lines(spark, line)).collect()
    got = parse_lines(lines(spark, line, "", "\ufeffe_id;x", "e_id"), mode="permissive").collect()
    assert len(got) == 1 and (got[0].e_id is None or got[0].time_norm is None or got[0].actor is None)


def test_lines_are_split_once(spark):
    plan = parse_lines(lines(spark, HEADER7))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(value") <= 1 and plan.count("split(CASE") <= 1


def test_text_fields_keep_their_places(spark, tmp_path):
    schema = "e_id int, geo_name string, lat float, lon float, geonamesid int, time string, time_norm date, actor string, city string, country string"
    D = __import__("datetime").date
    rows = [(None, "P", 1.0, 2.0, 5, "t", D(2000, 1, 1), "A", "C", "D"), (2, None, None, None, None, None, None, "B", None, None)]
    path = str(tmp_path / "t")
    write_events_text(spark.createDataFrame(rows, schema), path, places=True)
    back = read_events(spark, path, places=True, mode="permissive").drop("loc").collect()
    got = sorted((tuple(r) for r in back), key=str)
    assert got == sorted([(None, "P", 1.0, 2.0, 5, "t", D(2000, 1, 1), "A", "C", "D"), (2, "", None, None, None, "", None, "B", None, None)], key=str)
    for bad in ("a;b", "a\nb", "a\rb"):
        for column in ("geo_name", "actor", "time", "city"):
            row = spark.createDataFrame(rows[:1], schema).withColumn(column, F.lit(bad))
            with pytest.raises(PySparkException):
                write_events_text(row, str(tmp_path / "x"), places=True, mode="overwrite")


def test_text_and_csv_round_trip(spark, tmp_path):
    src = lines(
        spark,
        HEADER9,
        "1;A;[u'52.5 13.25'];5;t;2000-01-01;X;Paris;France",
        "2;B;[u''];;t;2000-01-02;Y; ; ",
    )
    ev = parse_lines(src, places=True, keep_blank=True)
    path = str(tmp_path / "events_txt")
    write_events_text(ev, path, places=True)
    back = read_events(spark, path, places=True, keep_blank=True)
    cols = ["e_id", "geo_name", "lat", "lon", "geonamesid", "time", "time_norm", "actor", "city", "country"]
    assert sorted(back.select(cols).collect()) == sorted(ev.select(cols).collect())
    # CSV result sink keeps a blank city and writes ISO dates
    out = str(tmp_path / "result_csv")
    write_csv(ev.select("e_id", "time_norm", "city").orderBy("e_id"), out, single_file=True)
    got = spark.read.option("sep", ";").option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(out)
    assert sorted((r.e_id, r.time_norm, r.city) for r in got.collect()) == [
        ("1", "2000-01-01", "Paris"),
        ("2", "2000-01-02", " "),
    ]


def test_fixture_view_shape(spark):
    from eventtrails.sources.fixture import fixture_events

    ev = fixture_events(spark, "/root/testdata/sf0.001")
    assert ev.columns == [
        "e_id", "geo_name", "loc", "lat", "lon", "geonamesid", "time", "time_norm", "actor", "city", "country"
    ]
    row = ev.where(F.col("lat").isNull()).first()
    assert row.loc == [] and row.city is None and row.country is None


def test_header_never_parsed_under_later_filters(spark):
    # later predicates on parsed columns may be merged with the header filter
    # and evaluated first; the strict parse must still ignore header lines
    from eventtrails.plans.search import time_interval

    src = lines(spark, HEADER7, "1;A;[u'1.0 2.0'];;t;2000-01-05;X", HEADER7, "2;B;[u'1.0 2.0'];;t;1999-13-05;X")
    with pytest.raises(PySparkException):  # a malformed date still fails the job
        time_interval(parse_lines(src), "2000-01-01", "2000-12-31").collect()
    ok = lines(spark, HEADER7, "1;A;[u'1.0 2.0'];;t;2000-01-05;X", HEADER7)
    assert [r.e_id for r in time_interval(parse_lines(ok), "2000-01-01", "2000-12-31").collect()] == [1]


def test_events_table_round_trip_and_pushdown(spark, tmp_path):
    from eventtrails.sinks import write_events_table
    from eventtrails.sources import read_events_table
    from eventtrails.sources.fixture import fixture_events
    from eventtrails.plans.search import time_interval

    ev = fixture_events(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "events_tbl")
    write_events_table(ev, path, partitions=4)
    back = read_events_table(spark, path)
    assert back.columns == ev.columns
    assert sorted(back.collect()) == sorted(ev.collect())
    q = time_interval(back, "2024-01-10", "2024-01-15")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    plan = buf.getvalue()
    assert "GreaterThanOrEqual(time_norm,2024-01-10)" in plan and "LessThanOrEqual(time_norm,2024-01-15)" in plan
    assert sorted(q.collect()) == sorted(time_interval(ev, "2024-01-10", "2024-01-15").collect())


def test_byte_order_mark_header(spark):
    got = parse_lines(lines(spark, "\ufeff" + HEADER7, "1;A;[u'1.0 2.0'];;t;2000-01-05;X")).collect()
    assert [r.e_id for r in got] == [1]


def test_fixture_dates_do_not_depend_on_session_zone(spark):
    from eventtrails.sources.fixture import fixture_events

    from .test_skew import conf

    base = sorted((r.e_id, r.time_norm, r.time) for r in fixture_events(spark, "/root/testdata/sf0.001").collect())
    with conf(spark, {"spark.sql.session.timeZone": "Pacific/Kiritimati",
                      "spark.sql.parquet.inferTimestampNTZ.enabled": "false"}):
        other = sorted((r.e_id, r.time_norm, r.time) for r in fixture_events(spark, "/root/testdata/sf0.001").collect())
    assert other == base


def test_table_layouts_narrow_file_ranges(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from eventtrails.sinks import write_events_table

    ev = spark.range(4000).selectExpr(
        "cast(id as int) e_id", "'P' geo_name", "cast(id % 40 as float) lat", "cast(id % 60 as float) lon", "cast(null as int) geonamesid",
        "'t' time", "date_add(date'2000-01-01', cast(id % 365 as int)) time_norm", "concat('A', lpad(cast(id % 97 as string), 2, '0')) actor",
    )
    for layout, column in (("date", "time_norm"), ("actor", "actor"), ("cell", "lat")):
        path = str(tmp_path / layout)
        write_events_table(ev, path, layout=layout, rows_per_file=500)
        ranges = []
        for f in glob.glob(path + "/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            k = [c for c in range(meta.num_columns) if meta.row_group(0).column(c).path_in_schema == column][0]
            stats = meta.row_group(0).column(k).statistics
            ranges.append((stats.min, stats.max))
        everything = (min(a for a, _ in ranges), max(b for _, b in ranges))
        assert 4 <= len(ranges) <= 8 and all((a, b) != everything for a, b in ranges)
    with pytest.raises(ValueError):
        write_events_table(ev, str(tmp_path / "x"), layout="other")


def test_curve_layout_skips_by_latitude_and_longitude(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from eventtrails.plans.search import events_near
    from eventtrails.sinks import write_events_table
    from eventtrails.sources import read_events_table

    ev = spark.range(20_000).selectExpr(
        "cast(id as int) e_id", "'P' geo_name", "cast(abs(hash(id, 1)) % 18001 / 100 - 90 as float) lat",
        "cast(abs(hash(id, 2)) % 36001 / 100 - 180 as float) lon", "cast(null as int) geonamesid", "'t' time",
        "date_add(date'2000-01-01', cast(id % 365 as int)) time_norm", "'A' actor",
    )
    odd = spark.createDataFrame(
        [(-1, None, None), (-2, float("nan"), 0.0), (-3, 10.0, 190.0), (-4, 90.0, 180.0), (-5, -90.0, -180.0), (-6, 10.0, 180.0), (-7, 10.0, -180.0)],
        "e_id int, lat float, lon float",
    )
    ev = ev.unionByName(odd, allowMissingColumns=True).withColumn("time_norm", F.coalesce("time_norm", F.lit("2000-01-01").cast("date")))
    path = str(tmp_path / "curve")
    write_events_table(ev, path, layout="curve", rows_per_file=500)
    boxes = []
    for f in glob.glob(path + "/*.parquet"):
        group = pq.ParquetFile(f).metadata.row_group(0)
        stats = {group.column(k).path_in_schema: group.column(k).statistics for k in range(group.num_columns)}
        boxes.append((stats["lat"].max - stats["lat"].min, stats["lon"].max - stats["lon"].min))
    assert len(boxes) >= 30 and sum(a <= 90 and b <= 180 for a, b in boxes) >= 0.8 * len(boxes)
    stored = read_events_table(spark, path, curve=True)
    plain = read_events_table(spark, path)
    assert "curve_key" not in plain.columns
    for lat, lon, km in [(48.85, 2.35, 300), (0, 0, 50), (89, 10, 500), (-90, 0, 800), (10, 179.9, 400), (10, -180, 60), (10, 180, 60), (10, 170, 2_500), (-33, -70, 9_000), (0, 0, 25_000)]:
        got = {r.e_id for r in events_near(stored, lat, lon, km).collect()}
        assert got == {r.e_id for r in events_near(plain, lat, lon, km).collect()}
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        events_near(stored, 48.85, 2.35, 300).explain("formatted")
    (pushed,) = [line for line in plan.getvalue().splitlines() if line.startswith("PushedFilters")]
    assert "LessThanOrEqual(curve_key" in pushed and "GreaterThanOrEqual(curve_key" in pushed
    with pytest.raises(ValueError):
        write_events_table(ev, str(tmp_path / "date"))
        read_events_table(spark, str(tmp_path / "date"), curve=True)


def test_circle_ranges():
    from eventtrails.functions.curve import circle_ranges

    for lat, lon, km in [(48.85, 2.35, 300), (0, 0, 0.001), (0, 0, 100), (-89.9, 12, 40), (12, 179.99, 5), (0, 0, 30_000)]:
        ranges = circle_ranges(lat, lon, km)
        assert 1 <= len(ranges) <= 16 and all(0 <= a <= b < 1 << 32 for a, b in ranges)
        assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:], strict=False))
    # a circle reads little more than its box
    assert sum(b - a + 1 for a, b in circle_ranges(48.85, 2.35, 300)) < (1 << 32) * (5.4 / 180) * (8.3 / 360) * 3


def test_single_file_keeps_order_and_modes(spark, tmp_path):
    import glob

    from eventtrails.sinks import write_csv

    rows = spark.range(0, 5_000, 1, 7).selectExpr("id", "concat('v ', id) v")
    path = str(tmp_path / "one")
    write_csv(rows.orderBy(F.desc("id")), path, single_file=True)
    (file,) = glob.glob(path + "/*.csv")
    assert open(file).read().splitlines() == ["id;v"] + [f"{k};v {k}" for k in range(4_999, -1, -1)]
    with pytest.raises(FileExistsError):
        write_csv(rows, path, single_file=True)
    write_csv(rows.limit(3), path, mode="ignore", single_file=True)
    assert glob.glob(path + "/*.csv") == [file]
    write_csv(rows.where("id < 2"), path, mode="append", single_file=True)
    assert spark.read.csv(path, sep=";", header=True).count() == 5_002
    write_csv(rows.where("id < 0"), path, mode="overwrite", single_file=True)
    (file,) = glob.glob(path + "/*")
    assert open(file).read() == "id;v\n"
    write_csv(rows.where("id = 1"), path, mode="overwrite", single_file=True)
    assert [open(f).read() for f in glob.glob(path + "/*")] == ["id;v\n1;v 1\n"]


def test_latest_per_actor_packs_date_and_id(spark):
    from eventtrails.operators import latest_per_actor

    rows = [("a", "2000-01-02", 5, "x"), ("a", "2000-01-02", 7, "x"), ("a", "2000-01-02", 7, "y"), ("a", "1999-01-01", 99, "z"), ("a", None, 999, "n"), ("b", None, 3, "p"), ("b", None, None, "q"), (None, "0001-01-01", -(2**31), "m"), (None, "0001-01-01", None, "o"), ("c", "9999-12-31", 2**31 - 1, "w"), ("c", "9999-12-31", -1, "v"), ("d", "1500-01-01", None, "s"), ("d", "1499-12-31", 8, "t")]
    want = {("a", 7, "y"), ("b", 3, "p"), (None, -(2**31), "m"), ("c", 2**31 - 1, "w"), ("d", None, "s")}
    df = spark.createDataFrame(rows, "actor string, d string, e_id int, v string").withColumn("time_norm", F.to_date("d"))
    for frame in (df, df.withColumn("e_id", F.col("e_id").cast("long"))):
        got = latest_per_actor(frame)
        assert {(r.actor, r.e_id, r.v) for r in got.collect()} == want and got.count() == len(want)
    assert "SortAggregate" not in latest_per_actor(df)._jdf.queryExecution().executedPlan().toString()
