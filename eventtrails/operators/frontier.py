"""A filter of the events by the keys and dates of a frontier.

A hop from a frontier too large to broadcast shuffles the events by the hop's key.
Only events of the frontier's keys, earlier than its dates, can have a pair. So the
frontier is summed up in a table of hash slots, each with the latest and earliest date
of its keys, and the events pass through it where they are read, before any shuffle.
The table has a fixed greatest number of rows, whatever the frontier holds; keys that
share a slot let too many events through, never too few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spatial import neighbour_places

#: Greatest number of slots: rows of a long and two dates, some 30 MB when broadcast.
MAX_SLOTS = 1 << 19
#: Slots for each row of the frontier, below that bound.
SLOTS_A_ROW = 8


def too_large_to_broadcast(df: DataFrame) -> bool:
    """Whether Spark's estimate of a frame (exact for a written table) passes its limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size > limit


def reduce_to_frontier(
    events: DataFrame, frontier: DataFrame, key: str, s: str = "", max_days: int | None = None, max_slots: int = MAX_SLOTS
) -> DataFrame:
    """``events`` without rows that no row of ``frontier`` can reach in one hop.

    ``key`` (of one type in both frames) and ``time_norm`` name the columns of the
    events; the frontier's have the suffix ``s``. Kept are the events whose slot the
    frontier uses and whose date is before the slot's latest date and, with
    ``max_days``, fewer than that many days before its earliest. The frontier is read
    twice (a count, the slots): pass a written table.
    """
    slots = 1
    while slots < min(max_slots, SLOTS_A_ROW * max(1, frontier.count())):
        slots *= 2

    def slot(name: str):
        return F.pmod(F.xxhash64(F.col(name)), F.lit(slots).cast("long"))

    used = (
        frontier.where(F.col(key + s).isNotNull() & F.col("time_norm" + s).isNotNull())
        .groupBy(slot(key + s).alias("_slot"))
        .agg(F.max("time_norm" + s).alias("_latest"), F.min("time_norm" + s).alias("_earliest"))
    )
    reach = (slot(key) == F.col("_slot")) & (F.col("time_norm") < F.col("_latest"))
    if max_days and max_days > 0:
        reach = reach & (F.datediff(F.col("_earliest"), F.col("time_norm")) < F.lit(int(max_days)))
    # at most ``max_slots`` rows
    return events.where(F.col(key).isNotNull()).join(F.broadcast(used), reach, "left_semi")


def _dates(frontier: DataFrame, keys: list[str], max_days: int | None, day: Column) -> DataFrame:
    """Per key (and bucket of ``max_days``), what decides which dates are reached.

    A date ``t`` of bucket ``b`` is reached by a later one ``d`` with
    ``d - t < max_days`` just if ``d`` is the bucket's greatest, ``_hi``, or the next
    bucket's least, ``_lo``: so one row a key and bucket stands for all of its dates.
    """
    rows = frontier.select(*keys, day.cast("long").alias("_d")).dropna()
    if not (max_days and max_days > 0):
        return rows.groupBy(*keys, F.lit(0).cast("long").alias("_b")).agg(F.max("_d").alias("_hi"), F.lit(None).cast("long").alias("_lo"))
    own = rows.groupBy(*keys, F.floor(F.col("_d") / int(max_days)).alias("_b")).agg(F.max("_d").alias("_hi"), F.min("_d").alias("_lo"))
    none = F.lit(None).cast("long")
    both = own.select(*keys, "_b", "_hi", none.alias("_lo"))
    both = both.unionByName(own.select(*keys, (F.col("_b") - 1).alias("_b"), none.alias("_hi"), "_lo"))
    return both.groupBy(*keys, "_b").agg(F.max("_hi").alias("_hi"), F.min("_lo").alias("_lo"))


def reached(
    events: DataFrame,
    frontier: DataFrame,
    keys: list[str],
    max_days: int | None = None,
    max_km: float | None = None,
    places: DataFrame | None = None,
    later: bool = False,
) -> DataFrame:
    """The rows of ``events`` that one hop from ``frontier`` arrives at, each once.

    The targets of a hop without its pairs, which can be as many as the product of both
    sides: the dates of a key are summed up (:func:`_dates`) and each event looks up
    one row. ``keys`` are equal on both sides, or, with ``max_km``, ``lat, lon`` are
    within that distance (``places``: those of the events). ``later`` turns time round:
    the rows from which a hop arrives at ``frontier``.
    """
    day = (F.lit(-1) if later else F.lit(1)) * F.unix_date("time_norm")
    dates = _dates(frontier, keys, max_days, day)
    if max_km is not None:
        near = neighbour_places(frontier, places, max_km)
        dates = near.join(dates, ["lat", "lon"]).groupBy(F.col("n_lat").alias("lat"), F.col("n_lon").alias("lon"), "_b")
        dates = dates.agg(F.max("_hi").alias("_hi"), F.min("_lo").alias("_lo"))
    dates = dates.withColumnsRenamed({c: f"_to_{c}" for c in keys})
    reach = F.coalesce(day < F.col("_hi"), F.lit(False))
    bucket = F.lit(0).cast("long")
    if max_days and max_days > 0:
        reach = reach | F.coalesce(F.col("_lo") - day < F.lit(int(max_days)), F.lit(False))
        bucket = F.floor(day / int(max_days))
    same = F.col("_b") == bucket
    for c in keys:
        same = same & (F.col(c) == F.col(f"_to_{c}"))
    return events.join(dates, same & reach, "left_semi")
