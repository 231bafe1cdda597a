"""Event searches: by date range, near a point, by actor, actor's countries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import event_label
from ..operators.filters import between_dates, by_actor, located, with_country, within_radius
from ..operators.ranking import ordered


def time_interval(events: DataFrame, start=None, end=None, order: bool = True) -> DataFrame:
    """Located events with ``start <= time_norm <= end`` (either side may be open).

    Out: ``e_id, actor, geo_name, time_norm``, ordered by date then id.
    """
    df = between_dates(located(events), start, end).select("e_id", "actor", "geo_name", "time_norm")
    return ordered(df) if order else df


def events_near(
    events: DataFrame,
    lat: float,
    lon: float,
    km: float,
    start=None,
    actor: str | None = None,
    digits: int | None = None,
    order: bool = True,
) -> DataFrame:
    """Located events strictly within ``km`` of (lat, lon), from ``start`` on.

    Out: ``e_id, actor, time_norm, gps_diff`` (km; rounded to ``digits`` if
    given), ordered by date then id. ``actor`` restricts to one actor.
    """
    df = located(events)
    if actor is not None:
        df = by_actor(df, actor)
    df = between_dates(df, start, None)
    df = within_radius(df, lat, lon, km, dist_col="gps_diff")
    dist = F.round("gps_diff", digits) if digits is not None else F.col("gps_diff")
    df = df.select("e_id", "actor", "time_norm", dist.alias("gps_diff"))
    return ordered(df) if order else df


def actor_countries(events: DataFrame, actor: str, start=None, end=None, order: bool = True) -> DataFrame:
    """One actor's events that have a country, in a date range.

    No located filter and no de-duplication. Out: ``e_id, actor, geo_name,
    time_norm, country``, ordered by date then id.
    """
    df = between_dates(by_actor(with_country(events), actor), start, end)
    df = df.select("e_id", "actor", "geo_name", "time_norm", "country")
    return ordered(df) if order else df


def actor_timeline(events: DataFrame, actor: str) -> DataFrame:
    """All events of one actor in date order (``e_id, geo_name, time_norm, actor``)."""
    df = by_actor(events, actor).select("e_id", "geo_name", "time_norm", "actor")
    return df.orderBy("actor", "time_norm", "e_id")


def to_nodes(df: DataFrame, with_actor: bool = True) -> DataFrame:
    """Node list of a search result: ``Id`` and ``Label`` (strings).

    Label is ``actor - geo_name - date``, or ``geo_name - date`` without the
    actor (the one-actor search labels its nodes that way).
    """
    if with_actor:
        label = event_label("actor", "geo_name", "time_norm")
    else:
        label = F.concat(F.col("geo_name"), F.lit(" - "), F.date_format("time_norm", "yyyy-MM-dd"))
    return df.select(F.col("e_id").cast("string").alias("Id"), label.alias("Label"))
