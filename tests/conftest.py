from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from eventtrails.session import local_session  # noqa: E402
from eventtrails.sources.events import BASE_COLUMNS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="eventtrails-tests")
    yield s
    s.stop()


def D(s: str) -> dt.date:
    y, m, d = (int(x) for x in s.split("-"))
    return dt.date(y, m, d)


def make_events(spark, rows, places: bool = False):
    """Event frame from tuples ``(e_id, actor, date, lat, lon[, city])``."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("e_id", T.IntegerType()),
            T.StructField("actor", T.StringType()),
            T.StructField("time_norm", T.DateType()),
            T.StructField("lat", T.FloatType()),
            T.StructField("lon", T.FloatType()),
            T.StructField("city", T.StringType()),
        ]
    )
    norm = []
    for r in rows:
        r = list(r) + [None] * (6 - len(r))
        r[2] = D(r[2]) if isinstance(r[2], str) else r[2]
        norm.append(tuple(r))
    df = spark.createDataFrame(norm, schema)
    df = df.select(
        "e_id",
        F.concat(F.lit("P"), F.col("e_id").cast("string")).alias("geo_name"),
        F.when(F.col("lat").isNotNull(), F.array("lat", "lon"))
        .otherwise(F.array().cast(T.ArrayType(T.FloatType())))
        .alias("loc"),
        "lat",
        "lon",
        F.lit(None).cast("int").alias("geonamesid"),
        F.date_format("time_norm", "yyyy-MM").alias("time"),
        "time_norm",
        "actor",
        "city",
        F.lit(None).cast("string").alias("country"),
    )
    return df if places else df.select(*BASE_COLUMNS)
