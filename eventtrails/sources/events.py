"""Event tables: declared schemas and the ``;``-separated text format.

The text format has one event per line, fields separated by ``;`` with no
quoting, and a header line whose first field is ``e_id`` (it may occur more
than once, e.g. after appends, and is dropped wherever it is). Columns:

``e_id;geo_name;loc;geonamesid;time;time_norm;actor[;city;country]``

``loc`` is a Python-literal list such as ``[u'48.85 2.35']``: latitude
then longitude separated by one space. Literals of 5 characters or fewer
(e.g. ``[u'']``) mean "unlocated".

Everything is parsed with native column expressions (split / substring /
try_cast); there is no RDD or Python row function, so a scan of a large
directory is split across tasks like any other text scan and downstream
filters are fused into the same codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared event schema (7 columns) and the place-enriched
# form (9 columns), in file order.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("e_id", T.IntegerType()),
        T.StructField("geo_name", T.StringType()),
        T.StructField("loc", T.ArrayType(T.FloatType())),
        T.StructField("geonamesid", T.IntegerType(), True),
        T.StructField("time", T.StringType()),
        T.StructField("time_norm", T.DateType()),
        T.StructField("actor", T.StringType()),
    ]
)
EVENT_PLACE_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields
    + [T.StructField("city", T.StringType(), True), T.StructField("country", T.StringType(), True)]
)

# Header marker, field separator, loc literal framing.
HEADER_FIRST_FIELD = "e_id"
FIELD_SEP = ";"
LOC_PREFIX = "[u'"
LOC_SUFFIX = "']"
LOC_MIN_LEN = 6  # literals of 5 characters or fewer are "unlocated"
DATE_PATTERN = "yyyy-M-d"

BASE_COLUMNS = ["e_id", "geo_name", "loc", "lat", "lon", "geonamesid", "time", "time_norm", "actor"]
PLACE_COLUMNS = BASE_COLUMNS + ["city", "country"]


def _strict(parsed: Column, raw: Column, what: str, mode: str, required: bool = True) -> Column:
    """Fail the job on a malformed value, or an empty or missing required one
    (``mode='failfast'``); null in its place with ``'permissive'``.

    Independent of the session's ANSI setting: ``try_*`` parses to null and
    ``raise_error`` turns that into a task failure with the offending text.
    """
    if mode == "permissive":
        return parsed
    if mode != "failfast":
        raise ValueError(f"mode must be 'failfast' or 'permissive', not {mode!r}")
    bad = parsed.isNull()
    if not required:
        bad = bad & raw.isNotNull() & (F.length(raw) > 0)
    message = F.concat(F.lit(f"malformed {what}: "), F.coalesce(raw, F.lit("missing")))
    return F.when(bad, F.raise_error(message)).otherwise(parsed)


def parse_loc(raw, mode: str = "failfast") -> Column:
    """``[u'lat lon']`` to ``array<float>``; short literals to an empty array.

    Drops the 3-character prefix and 2-character suffix, splits on single
    spaces, casts each part to float. A missing literal counts as unlocated.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    inner = raw.substr(F.lit(len(LOC_PREFIX) + 1), F.length(raw) - F.lit(len(LOC_PREFIX) + len(LOC_SUFFIX)))
    parts = F.split(inner, " ", -1)
    if mode == "failfast":
        as_float = F.transform(
            parts,
            lambda p: F.when(
                p.try_cast("float").isNull(), F.raise_error(F.concat(F.lit("malformed loc: "), raw))
            ).otherwise(p.try_cast("float")),
        )
    else:
        as_float = F.transform(parts, lambda p: p.try_cast("float"))
    return F.when(F.length(raw) >= LOC_MIN_LEN, as_float).otherwise(
        F.array().cast(T.ArrayType(T.FloatType()))
    )


def blank_to_null(c, keep_blank: bool = False) -> Column:
    """Unknown city/country to null.

    Default: blank or whitespace-only to null (the enricher writes a single
    space for "unknown"). ``keep_blank=True`` nulls only the empty string, so
    a ``" "`` value survives as a (joinable) place name, as in the original.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit("")) if keep_blank else F.nullif(F.trim(c), F.lit(""))


def with_point(df: DataFrame) -> DataFrame:
    """Add scalar ``lat``/``lon`` (float) from ``loc``; null when unlocated."""
    return df.withColumn("lat", F.get(F.col("loc"), 0)).withColumn("lon", F.get(F.col("loc"), 1))


def parse_lines(
    lines: DataFrame,
    places: bool = False,
    mode: str = "failfast",
    keep_blank: bool = False,
    column: str = "value",
) -> DataFrame:
    """Parse a frame of raw ``;`` lines (one string column) into events.

    Header lines are recognised by content (first field ``e_id``, after an
    optional byte-order mark) and dropped wherever they occur; only lines
    without any character are skipped. Extra trailing fields are ignored, so a
    9-column file reads fine as 7 columns. ``mode='failfast'`` aborts on
    malformed numbers or dates, on an empty or missing id or date and on a line
    with too few fields (as the original does); ``'permissive'`` keeps such rows
    with nulls. Checks run on the columns a query actually reads: a malformed
    value in a column pruned from the plan does not fail the job.
    """
    # a UTF-8 byte-order mark would hide the header marker of a file's first line
    line = F.col(column)
    line = F.when(line.startswith("\ufeff"), line.substr(F.lit(2), F.length(line))).otherwise(line)
    header = (line == HEADER_FIRST_FIELD) | line.startswith(HEADER_FIRST_FIELD + FIELD_SEP)
    rows = lines.where((F.length(line) > 0) & ~header)
    # the generator keeps the split in an operator of its own: each line is split
    # once, and later filters and projections read the fields instead of repeating it
    raw = rows.select(F.explode(F.array(F.split(line, FIELD_SEP, -1))).alias("_f"))
    f = lambda i: F.get(F.col("_f"), i)  # noqa: E731 - field accessor
    whole = F.size("_f") >= (9 if places else 7)

    def field(i: int) -> Column:
        """A text field; the line must have them all."""
        return f(i) if mode == "permissive" else F.when(whole, f(i)).otherwise(F.raise_error(F.concat(F.lit("short line: "), F.array_join("_f", FIELD_SEP))))

    cols = [
        _strict(f(0).try_cast("int"), f(0), "e_id", mode).alias("e_id"),
        field(1).alias("geo_name"),
        parse_loc(f(2), mode).alias("loc"),
        _strict(f(3).try_cast("int"), f(3), "geonamesid", mode, required=False).alias("geonamesid"),
        field(4).alias("time"),
        _strict(F.try_to_timestamp(f(5), F.lit(DATE_PATTERN)).cast("date"), f(5), "time_norm", mode).alias("time_norm"),
        field(6).alias("actor"),
    ]
    if places:
        cols += [
            blank_to_null(field(7), keep_blank).alias("city"),
            blank_to_null(field(8), keep_blank).alias("country"),
        ]
    out = with_point(raw.select(*cols))
    return out.select(*(PLACE_COLUMNS if places else BASE_COLUMNS))


def read_events(
    spark: SparkSession,
    path: str | list[str],
    places: bool = False,
    mode: str = "failfast",
    keep_blank: bool = False,
) -> DataFrame:
    """Scan ``;``-separated event text files (a file, a directory or a glob)."""
    return parse_lines(spark.read.text(path), places=places, mode=mode, keep_blank=keep_blank)


def loc_literal(lat="lat", lon="lon") -> Column:
    """Inverse of :func:`parse_loc`: ``[u'lat lon']``, or ``[u'']`` if unlocated."""
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    return F.when(
        la.isNotNull() & lo.isNotNull(),
        F.concat(F.lit(LOC_PREFIX), la.cast("string"), F.lit(" "), lo.cast("string"), F.lit(LOC_SUFFIX)),
    ).otherwise(F.lit(LOC_PREFIX + LOC_SUFFIX))


def _field(value: Column, null: str = "") -> Column:
    """A text field of a line; null as ``null``. A separator or line break inside
    a value would move the fields after it, so it fails the job."""
    bad = value.rlike(f"[{FIELD_SEP}\r\n]")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("separator or line break in a field: "), value))).otherwise(value)
    return F.coalesce(checked, F.lit(null))


def to_lines(df: DataFrame, places: bool = False, blank: str = " ") -> DataFrame:
    """Format events as raw ``;`` lines (column ``value``), no header.

    Every field keeps its position: nulls are written as empty fields, null
    city/country as ``blank`` (a single space, as the enricher does). Rows with
    a null id or date are written too; only a permissive read takes them back.
    """
    fields = [
        _field(F.col("e_id").cast("string")),
        _field(F.col("geo_name")),
        loc_literal(),
        _field(F.col("geonamesid").cast("string")),
        _field(F.col("time")),
        _field(F.date_format("time_norm", "yyyy-MM-dd")),
        _field(F.col("actor")),
    ]
    if places:
        fields += [_field(F.col("city"), blank), _field(F.col("country"), blank)]
    return df.select(F.concat_ws(FIELD_SEP, *fields).alias("value"))


def header_line(places: bool = False) -> str:
    names = [f.name for f in (EVENT_PLACE_SCHEMA if places else EVENT_SCHEMA).fields]
    return FIELD_SEP.join(names)


TABLE_COLUMNS = ["e_id", "geo_name", "lat", "lon", "geonamesid", "time", "time_norm", "actor"]


def read_events_table(spark: SparkSession, path: str, places: bool | None = None, curve: bool = False) -> DataFrame:
    """Read an event table written by :func:`write_events_table`.

    Scalar ``lat``/``lon`` are stored columns, so date and latitude filters
    are pushed into the Parquet reader and skip row groups by their
    statistics; ``loc`` is derived. ``places=None`` keeps city/country if the
    table has them. ``curve=True`` keeps the key of a table in the ``curve``
    layout, by which radius searches skip row groups.
    """
    df = spark.read.parquet(path)
    if curve and "curve_key" not in df.columns:
        raise ValueError(f"{path} is not in the curve layout")
    has_places = "city" in df.columns if places is None else places
    loc = F.when(
        F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.array(F.col("lat"), F.col("lon"))
    ).otherwise(F.array().cast(T.ArrayType(T.FloatType())))
    out = df.withColumn("loc", loc)
    return out.select(*(PLACE_COLUMNS if has_places else BASE_COLUMNS), *["curve_key"] * curve)
