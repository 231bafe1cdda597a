"""Event view over the driver's synthetic tables (``events`` + ``nation``).

The synthetic ``events`` table (event_id, ts, user_id, props='{"k": n}')
is mapped onto the event model. With ``k`` the JSON field as int:

* ``e_id``        event_id as int
* ``geo_name``    ``PLACE_<k>``
* ``lat``/``lon`` 25 + 3*(k mod 10), -120 + 4*floor(k/10) as float;
                  unlocated (null, empty ``loc``) when k mod 20 = 0
* ``geonamesid``  k, null when k mod 10 = 5
* ``time``        ``yyyy-MM`` of ts; ``time_norm`` the date of ts
* ``actor``       ``USER_<user_id>``
* ``city``        ``CITY_<k mod 25>``; ``country`` the ``n_name`` of nation
                  ``k mod 25``; both unknown when k mod 20 = 0

The same mapping is written in SQL for the DuckDB oracle
(``eventtrails.oracle``). A gazetteer for place enrichment is derived from
the same places, shifted by ``GAZETTEER_SHIFT_DEG``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .events import BASE_COLUMNS, PLACE_COLUMNS, blank_to_null

# The fixture mapping's constants.
LAT_BASE, LAT_STEP = 25, 3
LON_BASE, LON_STEP = -120, 4
UNLOCATED_EVERY = 20
NO_GEONAMES_MOD, NO_GEONAMES_REM = 10, 5
CITY_COUNT = 25
GAZETTEER_SHIFT_DEG = 0.1


def _with_k(df: DataFrame, name: str) -> DataFrame:
    """Add the JSON field ``k`` of ``props`` as int column ``name``.

    ``json_tuple`` is a generator, so its output is computed once per row
    and later filters are not rewritten to re-parse the JSON for every
    reference to a derived column (which is what happens with a plain
    ``get_json_object`` projection: Catalyst inlines it into each predicate).
    """
    keep = [c for c in df.columns if c != "props"]
    return df.select(*keep, F.json_tuple(F.col("props"), "k").alias("_k_raw")).select(
        *keep, F.col("_k_raw").cast("int").alias(name)
    )


def _grid_lat(k: Column) -> Column:
    return (F.lit(LAT_BASE) + F.lit(LAT_STEP) * (k % 10)).cast("float")


def _grid_lon(k: Column) -> Column:
    return (F.lit(LON_BASE) + F.lit(LON_STEP) * F.floor(k / 10)).cast("float")


def fixture_events(spark: SparkSession, sf_dir: str, places: bool = True, raw_blank: bool = False) -> DataFrame:
    """The event view of ``<sf_dir>/events.parquet`` (and ``nation``).

    ``raw_blank=True`` keeps unknown city/country as a single space, the way
    the enricher writes them; the default is the normalised null.
    """
    src = _with_k(
        spark.read.parquet(f"{sf_dir}/events.parquet").select(
            F.col("event_id").cast("int").alias("e_id"), "ts", "user_id", "props"
        ),
        "_k",
    )
    k = F.col("_k")
    located = (k % UNLOCATED_EVERY) != 0
    # ts is a zone-less timestamp; read as one, its date does not depend on
    # the session time zone. If a session reads it as a zoned timestamp, take
    # the date in UTC (the stored value) so no session zone shifts it.
    if dict(src.dtypes)["ts"] == "timestamp_ntz":
        day = F.to_date(F.col("ts"))
    else:
        day = F.date_from_unix_date(F.floor(F.unix_micros(F.col("ts")) / F.lit(86_400_000_000)).cast("int"))
    lat = F.when(located, _grid_lat(k))
    lon = F.when(located, _grid_lon(k))
    ev = src.select(
        "e_id",
        F.concat(F.lit("PLACE_"), k.cast("string")).alias("geo_name"),
        F.when(located, F.array(_grid_lat(k), _grid_lon(k)))
        .otherwise(F.array().cast(T.ArrayType(T.FloatType())))
        .alias("loc"),
        lat.alias("lat"),
        lon.alias("lon"),
        F.when(k % NO_GEONAMES_MOD != NO_GEONAMES_REM, k).alias("geonamesid"),
        F.date_format(day, "yyyy-MM").alias("time"),
        day.alias("time_norm"),
        F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("actor"),
        (k % CITY_COUNT).alias("_nk"),
        located.alias("_located"),
    )
    if not places:
        return ev.select(*BASE_COLUMNS)
    # nation is a 25-row dimension; Spark broadcasts it from file statistics.
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_nationkey").alias("_nk"), F.col("n_name")
    )
    blank = F.lit(" ")
    ev = ev.join(nation, "_nk", "left").select(
        *BASE_COLUMNS,
        F.when(F.col("_located"), F.concat(F.lit("CITY_"), F.col("_nk").cast("string")))
        .otherwise(blank)
        .alias("city"),
        F.when(F.col("_located"), F.col("n_name")).otherwise(blank).alias("country"),
    )
    if not raw_blank:
        ev = ev.select(
            *BASE_COLUMNS, blank_to_null("city").alias("city"), blank_to_null("country").alias("country")
        )
    return ev.select(*PLACE_COLUMNS)


def fixture_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer ``place_id, lat, lon, city, country`` derived from the data.

    One row per distinct place key seen in ``events`` that is located, at
    the place's grid point shifted by ``GAZETTEER_SHIFT_DEG`` in both axes.
    """
    keys = _with_k(spark.read.parquet(f"{sf_dir}/events.parquet").select("props"), "place_id").distinct()
    keys = keys.where(F.col("place_id") % UNLOCATED_EVERY != 0)
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("country")
    )
    k = F.col("place_id")
    return keys.withColumn("_nk", k % CITY_COUNT).join(nation, "_nk", "left").select(
        "place_id",
        (_grid_lat(k).cast("double") + F.lit(GAZETTEER_SHIFT_DEG)).alias("lat"),
        (_grid_lon(k).cast("double") + F.lit(GAZETTEER_SHIFT_DEG)).alias("lon"),
        F.concat(F.lit("CITY_"), F.col("_nk").cast("string")).alias("city"),
        "country",
    )
