"""Trails back in time from root events.

A trail starts at a root event and takes ``depth`` hops, alternating a
same-actor hop (odd steps) with a nearby hop (``second='geo'``: earlier
event within ``max_km``) or a same-city hop (``second='city'``). Every hop
goes strictly back in time, so no event repeats on a trail and same-day
events never link. Rows are trails (bag semantics: a repeated ``e_id``
multiplies trails, as a join would).

Output columns (step suffix ``''`` for step 1, then ``2``, ``3`` ...): step 1
emits ``e_id, time_norm, actor``; every hop from step ``s`` emits
``e_id<s+1>, time_norm<s+1>, actor<s+1>``, then ``date_diff<s>`` when
``max_days`` is set, then ``gps_diff<s>`` (geo hop) or ``city<s>`` (city
hop, the shared city).

The number of trails grows exponentially with depth: this operator emits
them all and is meant for a root with a day cap or a small depth. Use
:func:`eventtrails.plans.counts.count_trails` to count them and
:func:`eventtrails.plans.graph.trail_graph` for the nodes and edges they
touch; both stay polynomial.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_lit
from ..operators.filters import located, root as root_by_id, with_city
from ..operators.hops import equi_hop, hop_actor, hop_actor_outer, hop_city, hop_geo, hot_keys, step_suffix
from ..operators.spatial import neighbour_spreader
from ..session import cut_lineage
from .counts import checked


def _roots(ev: DataFrame, root) -> DataFrame:
    """Root rows: an ``e_id`` (all rows with it), a list of ids, or a frame of event rows."""
    if isinstance(root, DataFrame):
        return root.select(*ev.columns)
    return root_by_id(ev, root)


def date_window(roots: DataFrame, depth: int, max_days: int | None):
    """Dates any trail event from ``roots`` can have: ``(lo, hi)``, inclusive,
    in days since 1970-01-01 (which have no smallest year).

    Every hop goes strictly back in time, and with a strict day cap a hop
    goes back at most ``max_days - 1`` days, so after ``depth`` hops an event
    lies in ``[min(root) - depth*(max_days-1), max(root) - 1]`` (``lo`` is
    ``None`` without a cap). Returns ``None`` when there are no roots. One
    small job: an aggregate of the roots' dates.
    """
    day = F.unix_date("time_norm")
    lo_hi = roots.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    if lo_hi is None or lo_hi["hi"] is None:
        return None
    lo = None
    if max_days and max_days > 0:
        lo = lo_hi["lo"] - depth * (int(max_days) - 1)
        if lo < FIRST_DAY:  # no event lies before the first date: no bound
            lo = None
    return lo, lo_hi["hi"] - 1


#: 0001-01-01 in days since 1970-01-01.
FIRST_DAY = -719_162


def prune_to_window(ev: DataFrame, roots: DataFrame, depth: int, max_days: int | None) -> tuple[DataFrame, DataFrame]:
    """Restrict the hop side of ``ev`` to the dates trails from ``roots`` can reach.

    The bounds are literals, so they reach the Parquet reader as pushed
    filters and a table sorted by date skips every row group outside the
    window (each hop then reads a slice instead of the whole table). The roots
    are written first: they are computed once, and the first hop is planned
    with their measured size (a few rows are broadcast; the events stay put).
    """
    roots = cut_lineage(roots)
    w = date_window(roots, depth, max_days)
    if w is None:
        return ev.where(F.lit(False)), roots
    lo, hi = w
    cond = F.col("time_norm") <= day_lit(hi)
    if lo is not None:
        cond = cond & (F.col("time_norm") >= day_lit(lo))
    return ev.where(cond), roots


def _hop_events(events: DataFrame, second: str) -> DataFrame:
    if second == "geo":
        return located(events)
    if second == "city":
        return with_city(events)
    raise ValueError("second must be 'geo' or 'city'")


def trail_columns(depth: int, second: str = "geo", max_days: int | None = None) -> list[str]:
    """Output column names of a trail of ``depth`` hops, in order."""
    cols = ["e_id", "time_norm", "actor"]
    capped = bool(max_days and max_days > 0)
    for step in range(1, depth + 1):
        s, n = step_suffix(step), step_suffix(step + 1)
        cols += ["e_id" + n, "time_norm" + n, "actor" + n]
        if capped:
            cols.append("date_diff" + s)
        if step % 2 == 0:
            cols.append(("gps_diff" if second == "geo" else "city") + s)
    return cols


def trail(
    events: DataFrame,
    root,
    depth: int,
    second: str = "geo",
    max_km: float = 500.0,
    max_days: int | None = None,
    digits: int | None = None,
    order: bool = False,
    checkpoint_every: int = 1,
    prune: bool = True,
    salt: int | None = None,
    different_actor: bool = False,
    hot_fraction: float | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """All trails of ``depth`` hops back from ``root`` (an ``e_id`` or root rows).

    ``second='geo'`` keeps located events only; ``'city'`` keeps events with
    a city. ``max_days`` (strict, per hop) bounds each hop's gap and is the
    practical guard against blow-up; a value ``<= 0`` means no cap.
    ``digits`` rounds the ``gps_diff`` columns. ``order`` sorts by the last
    step's date, as the original output was. After every ``checkpoint_every``
    hops (default: each) the trails so far are written to the shared folder
    (only the columns still needed): the next hop is planned with their
    measured size, so the events are not shuffled for a small frontier, and a
    lost executor costs no earlier hop. ``prune`` restricts the events to the date window
    the roots can reach (:func:`prune_to_window`; one small job). ``salt``
    spreads each actor, city or place over that many join partitions
    (see :func:`eventtrails.operators.hops.hop_actor`); with
    ``hot_fraction`` only the actors / cities holding more than that share of
    the events are salted (:func:`eventtrails.operators.hops.hot_keys`).
    ``different_actor`` requires another actor on each geo hop. With ``columns``
    (``e_id``, ``time_norm`` and ``actor`` of any steps) trails that agree in them are
    one row with their number, ``trails``: see :func:`_grouped`.
    """
    if depth < 0:
        raise ValueError("depth must not be negative")
    ev = _hop_events(events, second)
    keep = ["e_id", "time_norm", "actor", "lat", "lon"] + (["city"] if second == "city" else [])
    ev = ev.select(*keep)
    cur = _roots(ev, root)
    if prune:
        ev, cur = prune_to_window(ev, cur, depth, max_days)
    if columns is not None:
        if different_actor:
            raise ValueError("columns: not with different_actor")
        out = _grouped(ev, cur, depth, second, max_km, max_days, columns)
        last = "time_norm" + step_suffix(depth + 1)
        if order and last not in columns:
            raise ValueError(f"order needs {last} among the columns")
        return out.orderBy(last) if order else out
    places = ev.select("lat", "lon") if second == "geo" else None
    hot_actors = hot_cities = None
    if salt and hot_fraction:
        hot_actors = hot_keys(ev, "actor", hot_fraction)
        hot_cities = hot_keys(ev, "city", hot_fraction) if second == "city" else None
    written = prune  # the roots are a written table then
    for step in range(1, depth + 1):
        if step % 2 == 1:
            cur = hop_actor(cur, ev, step, max_days, salt=salt, hot=hot_actors, reduce=written, spread=written)
        elif second == "geo":
            one_salt = None if hot_fraction else salt
            cur = hop_geo(cur, ev, step, max_km, max_days, different_actor, places, one_salt, spread=written, digits=digits)
        else:
            cur = hop_city(cur, ev, step, max_days, salt=salt, hot=hot_cities, reduce=written, spread=written)
        if checkpoint_every and step % checkpoint_every == 0 and step < depth:
            n = step_suffix(step + 1)
            keep_now = trail_columns(step, second, max_days) + [c + n for c in keep if c not in ("e_id", "time_norm", "actor")]
            cur = cut_lineage(cur.select(*keep_now))
            written = True
        else:
            written = False
    cols = trail_columns(depth, second, max_days)
    out = cur.select(*cols)
    if order:
        out = out.orderBy("time_norm" + step_suffix(depth + 1))
    return out


def _grouped(
    ev: DataFrame, roots: DataFrame, depth: int, second: str, max_km: float, max_days: int | None, columns: list[str]
) -> DataFrame:
    """The trails as rows of ``columns`` and ``trails``, how many trails agree in them.

    A hop looks at nothing but the current event's date and its actor, city or place.
    So after each hop the trails are summed over these and the columns asked for so far,
    and the events too are summed before a hop joins them: the work follows the distinct
    values, not the number of trails. A geo hop first spreads the sums over the
    neighbouring places (:func:`eventtrails.operators.spatial.neighbour_spreader`).
    A number beyond 64 bits is an error.
    """
    own = ("e_id", "time_norm", "actor")
    order = [c + step_suffix(n) for n in range(1, depth + 2) for c in own]
    if not columns or set(columns) - set(order):
        raise ValueError("columns must be e_id, time_norm or actor of the trail's steps")

    def hop_keys(step: int) -> list[str]:
        return ["actor"] if step % 2 == 1 else ["lat", "lon"] if second == "geo" else ["city"]

    def needed(step: int) -> list[str]:
        asked = [c for c in own if c + step_suffix(step) in columns]
        return list(dict.fromkeys(asked + (["time_norm", *hop_keys(step)] if step <= depth else [])))

    cur = roots.groupBy(*needed(1)).agg(F.count(F.lit(1)).alias("trails"))
    for step in range(1, depth + 1):
        s, n = step_suffix(step), step_suffix(step + 1)
        keys = hop_keys(step)
        carried = [c for c in order if c in columns and c in cur.columns]
        if keys == ["lat", "lon"]:
            at = cur.withColumnsRenamed({"lat" + s: "lat", "lon" + s: "lon"})
            here = list(dict.fromkeys([*carried, "time_norm" + s]))
            spread = neighbour_spreader(ev.select("lat", "lon"), at.select("lat", "lon"), max_km)
            cur = spread(at, here, "trails").withColumnsRenamed({"lat": "lat" + s, "lon": "lon" + s})
            cur = cut_lineage(cur.withColumn("trails", checked(F.col("trails"))))
        there = list(dict.fromkeys([*needed(step + 1), "time_norm", *keys]))
        met = equi_hop(cur, ev.groupBy(*there).agg(F.count(F.lit(1)).alias("_m")), step, keys, max_days, spread=True)
        kept = list(dict.fromkeys([*carried, *[c + n for c in needed(step + 1)]]))
        ways = checked(F.try_multiply(F.col("trails"), F.col("_m" + n)))
        cur = met.groupBy(*kept).agg(F.try_sum(ways).alias("trails"))
        cur = cut_lineage(cur.withColumn("trails", checked(F.col("trails"))))
    return cur.select(*[c for c in order if c in columns], "trails")


def trail_two_hop(
    events: DataFrame, root, max_km: float = 500.0, order: bool = False, prune: bool = True, salt: int | None = None
) -> DataFrame:
    """Fixed two-hop trail: same actor earlier (outer), then a *different*
    actor's earlier event within ``max_km``.

    The first hop is a left outer join, but a root without an earlier event
    of its actor has no place to search from, so such rows cannot survive
    the second hop and the result equals that of an inner first hop.
    ``salt=S`` spreads each actor and each place over ``S`` join partitions.
    Out: ``e_id, actor, time_norm`` for steps 1, 2 and 3.
    """
    ev = located(events).select("e_id", "time_norm", "actor", "lat", "lon")
    roots = _roots(ev, root)
    if prune:
        ev, roots = prune_to_window(ev, roots, 2, None)
    first = hop_actor_outer(roots, ev, 1, salt=salt) if salt else hop_actor(roots, ev, 1, how="left")
    cur = cut_lineage(first)
    cur = hop_geo(cur, ev, 2, max_km, different_actor=True, places=ev.select("lat", "lon"), salt=salt)
    out = cur.select(
        "e_id", "actor", "time_norm", "e_id2", "actor2", "time_norm2", "e_id3", "actor3", "time_norm3"
    )
    return out.orderBy("time_norm2", "time_norm3") if order else out
