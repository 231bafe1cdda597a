"""One step back in time from the current event of each row.

A trail frame carries the columns of every visited event with a step
suffix: step 1 has no suffix (``e_id``), step n has ``str(n)`` (``e_id2``,
``e_id3`` ...). A hop from step ``s`` joins the event table, renamed with the
suffix of step ``s + 1``, under the hop condition:

* actor hop: same actor, strictly earlier date;
* city hop:  same city, strictly earlier date;
* geo hop:   strictly earlier date and haversine distance ``< max_km``.

An optional ``max_days`` adds ``datediff(t_s, t_{s+1}) < max_days`` and the
``date_diff<s>`` column; a geo hop adds ``gps_diff<s>``.

Every hop is an equi-join plus a residual: on the actor / city, on the
neighbouring place for geo hops (distinct places are paired once by the grid
join of :mod:`.spatial`), and, when ``max_days`` is set, also on a date
bucket of width ``max_days`` so a prolific actor or a busy place is split by
time instead of landing in one task. ``spread`` divides a hop by the pairs it gives
(:func:`pair_up`), which can be many times its input.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .frontier import reduce_to_frontier, too_large_to_broadcast
from .spatial import neighbour_places


def step_suffix(n: int) -> str:
    """Column suffix of step ``n``: ``''`` for step 1, else ``str(n)``."""
    return "" if n <= 1 else str(n)


def suffix(df: DataFrame, n: int) -> DataFrame:
    """Rename every event column with the suffix of step ``n``."""
    sfx = step_suffix(n)
    if not sfx:
        return df
    return df.withColumnsRenamed({c: c + sfx for c in df.columns})


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(int(width))).cast("long")


def _date_keys(cur_t: Column, max_days: int | None):
    """Buckets that can hold a date in ``[t - max_days + 1, t - 1]``."""
    if not max_days or max_days <= 0:
        return None
    lo = F.date_sub(cur_t, int(max_days) - 1)
    hi = F.date_sub(cur_t, 1)
    return F.sequence(_bucket(lo, max_days), _bucket(hi, max_days))


def _with_day_cap(cond: Column, cur_t: Column, nxt_t: Column, max_days: int | None) -> Column:
    if max_days and max_days > 0:
        cond = cond & (F.datediff(cur_t, nxt_t) < F.lit(int(max_days)))
    return cond


#: Pairs of a task: at least and at most; in between, a hop is divided into TASKS.
LEAST_PAIRS, MOST_PAIRS, TASKS = 1_000_000, 20_000_000, 64
#: A frontier of fewer rows is not counted: its pairs are few for each event read.
FEW_ROWS = 64


def spread_pairs(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], packs: bool = False):
    """Both sides of an inner equi-join, divided by the pairs that the join gives.

    A join's tasks follow the bytes of its sides, so few keys with many rows on each
    side, or a small file, give one task billions of pairs. Here the pairs of each key
    are counted first. A key with more than a task's pairs is laid out as a grid: its
    left rows are dealt over ``a`` rows of cells, its right rows over ``b`` columns (by
    a hash of the whole row), and each is copied to the other's cells, so that each
    pair meets in just one cell. ``a`` and ``b`` follow the sides' sizes, so the copies
    are as few as can be. Returns ``(left, right, left keys, right keys)`` with the
    cell's columns; unchanged where all pairs are few. ``left`` is read three times:
    pass a written table or a cheap join on one. ``packs`` numbers the left rows of a cell
    by packs of about ``PACK`` (``_pack``) and tells the right ones how many (``_packs``).
    """
    l_cell, r_cell = ["_la", "_lb"], ["_ra", "_rb"]
    here = left.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(left_keys)]).agg(F.count(F.lit(1)).alias("_nl"))
    same = [F.col(f"_k{i}") == F.col(c) for i, c in enumerate(right_keys)]
    keys = [f"_k{i}" for i in range(len(left_keys))]
    work = cut_lineage(right.select(*right_keys).join(here, same).groupBy(*keys, "_nl").agg(F.count(F.lit(1)).alias("_nr")))
    n_pairs = F.col("_nl").cast("double") * F.col("_nr")
    total = work.agg(F.sum(n_pairs)).first()[0] or 0.0
    if total <= LEAST_PAIRS:
        return left, right, left_keys, right_keys
    task = min(MOST_PAIRS, max(LEAST_PAIRS, total / TASKS))
    cells = F.ceil(n_pairs / F.lit(float(task)))
    across = F.round(F.sqrt(cells * F.col("_nr") / F.col("_nl")))
    grid = work if packs else work.where(n_pairs > F.lit(float(task)))
    grid = grid.withColumn("_b", F.greatest(F.lit(1.0), F.least(cells, across))).withColumn("_a", F.ceil(cells / F.col("_b")))
    n_packs = F.ceil(F.col("_nl") / F.col("_a") / PACK).cast("int").alias("_packs")
    grid = grid.select(*keys, F.col("_a").cast("int").alias("_a"), F.col("_b").cast("int").alias("_b"), *([n_packs] if packs else []))

    def dealt(side: DataFrame, names: list[str], own: str, other: str, cell: tuple[str, str], *more: Column) -> DataFrame:
        one = F.lit(1)
        n_own, n_other = F.coalesce(F.col(own), one), F.coalesce(F.col(other), one)
        out = side.join(grid, [F.col(k) == F.col(c) for k, c in zip(keys, names)], "left")
        place = F.pmod(F.xxhash64(*side.columns), n_own.cast("long")).cast("int").alias(cell[0])
        return out.select(*side.columns, place, F.explode(F.sequence(F.lit(0), n_other - 1)).alias(cell[1]), *more)

    n_packs = F.coalesce(F.col("_packs"), F.lit(1))
    # other bits of the hash than those of the cell
    pack = F.pmod(F.shiftrightunsigned(F.xxhash64(*left.columns), 32), n_packs.cast("long")).cast("int")
    left = dealt(left, left_keys, "_a", "_b", ("_la", "_lb"), *([pack.alias("_pack")] if packs else []))
    right = dealt(right, right_keys, "_b", "_a", ("_rb", "_ra"), *([n_packs.alias("_packs")] if packs else []))
    left_keys, right_keys = left_keys + l_cell, right_keys + r_cell
    parts = min(100_000, math.ceil(total / task))

    def exact(side: DataFrame, names: list[str], prefix: str) -> tuple[DataFrame, list[str]]:
        # a join rewrites float keys (-0.0 is 0.0), which undoes a division by them: as text
        floats = [c for c in names if side.schema[c].dataType in (T.FloatType(), T.DoubleType())]
        text = {prefix + c: (F.col(c) + 0).cast("string") for c in floats}
        return side.withColumns(text) if text else side, [prefix + c if c in floats else c for c in names]

    left, left_keys = exact(left, left_keys, "_l")
    right, right_keys = exact(right, right_keys, "_r")
    return left.repartition(parts, *left_keys), right.repartition(parts, *right_keys), left_keys, right_keys


#: Rows of the left side that are carried as one, about.
PACK = 256


def pair_up(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], cond: Column, earlier: tuple[str, str]) -> DataFrame:
    """The inner join on equal keys and ``cond``, divided by :func:`spread_pairs`.

    Where there is a grid, about ``PACK`` left rows of a cell are carried as one and
    taken apart behind the join. Within a task the events run past one pack after the
    other, so an event's columns stay the same for a pack's length and the left columns
    repeat every pack: a stored table holds such rows in a fraction of a byte each,
    whatever the order of the input. Nothing more is shuffled for it: an event meets
    its cell's packs as copies within its task. ``earlier`` names the right date that
    ``cond`` wants before the left one; a pack without a later date is passed over.
    """
    l, r, lk, rk = spread_pairs(left, right, left_keys, right_keys, packs=True)
    same = [F.col(a) == F.col(b) for a, b in zip(lk, rk)]
    if lk == left_keys:
        return l.join(r, reduce(and_, same) & cond, "inner")
    nxt_t, cur_t = earlier
    packs = l.dropna(subset=lk).groupBy(*lk, "_pack")
    packs = packs.agg(F.collect_list(F.struct(*left.columns)).alias("_rows"), F.max(cur_t).alias("_latest"))
    # the number of a row, used below, keeps the optimizer from dropping the order
    r = r.dropna(subset=rk).withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_packs") - 1)))
    r = r.sortWithinPartitions(*rk, "_at", nxt_t).withColumn("_seq", F.monotonically_increasing_id())
    # a difference, not an equality: the pack is no key to shuffle by
    meets = (F.col("_at") - F.col("_pack") == 0) & (F.col(nxt_t) < F.col("_latest")) & (F.col("_seq") >= 0)
    met = r.hint("merge").join(packs, reduce(and_, same) & meets, "inner")
    return met.select(F.inline("_rows"), *right.columns).where(cond)


def _many(df: DataFrame) -> bool:
    return df.limit(FEW_ROWS).count() >= FEW_ROWS


def hot_keys(events: DataFrame, key: str, fraction: float = 0.01) -> list:
    """Values of ``key`` held by more than ``fraction`` of the rows.

    There can be at most ``1 / fraction`` of them, so the list brought to the
    driver has a proven size bound. Two jobs: a count and a partial-aggregate
    count per key (reading only ``key``).
    """
    if not 0.001 <= fraction < 1:
        raise ValueError("fraction must be in [0.001, 1)")
    total = events.count()
    counts = events.where(F.col(key).isNotNull()).groupBy(key).count()
    hot = counts.where(F.col("count") > F.lit(fraction * total)).select(key).collect()
    return [r[0] for r in hot]


def equi_hop(
    left: DataFrame,
    events: DataFrame,
    step: int,
    key: str | list[str],
    max_days: int | None,
    how: str = "inner",
    salt: int | None = None,
    hot: list | None = None,
    reduce: bool = False,
    spread: bool = False,
) -> DataFrame:
    """The hop on equal ``key`` (one column, or several without ``salt`` and ``reduce``)."""
    on = [key] if isinstance(key, str) else key
    if salt and how != "inner":
        raise ValueError("salt needs an inner join: an outer one would emit a row per salt (see hop_actor_outer)")
    s, n = step_suffix(step), step_suffix(step + 1)
    if reduce and too_large_to_broadcast(left):
        events = reduce_to_frontier(events, left, key, s, max_days)
    nxt = suffix(events, step + 1)
    cur_t, nxt_t = F.col("time_norm" + s), F.col("time_norm" + n)
    cond = rest = _with_day_cap(nxt_t < cur_t, cur_t, nxt_t, max_days)
    for c in on:
        cond = cond & (F.col(c + n) == F.col(c + s))
    spread = spread and how == "inner" and not salt and _many(left)
    # buckets replicate left rows, which an outer join would emit repeatedly
    keys = _date_keys(cur_t, max_days) if how == "inner" else None
    if keys is not None:
        left = left.withColumn("_bk", F.explode(keys))
        nxt = nxt.withColumn("_bk" + n, _bucket(F.col("time_norm" + n), max_days))
        cond = cond & (F.col("_bk") == F.col("_bk" + n))
    salted = bool(salt and salt > 1 and how == "inner" and (hot is None or len(hot) > 0))
    if salted:
        # every left row probes all salts; each event sits in one (by id), so
        # a hot key is spread over ``salt`` join partitions, exactly once each.
        # With ``hot`` given, only those keys are salted (others use salt 0).
        all_salts = F.sequence(F.lit(0), F.lit(int(salt) - 1))
        ev_salt = F.pmod(F.xxhash64(F.col("e_id" + n)), F.lit(int(salt))).cast("int")
        if hot is not None:
            all_salts = F.when(F.col(key + s).isin(hot), all_salts).otherwise(F.array(F.lit(0)))
            ev_salt = F.when(F.col(key + n).isin(hot), ev_salt).otherwise(F.lit(0))
        left = left.withColumn("_salt", F.explode(all_salts))
        nxt = nxt.withColumn("_salt" + n, ev_salt)
        cond = cond & (F.col("_salt") == F.col("_salt" + n))
    if spread:
        bucket = ["_bk"] if keys is not None else []
        dates = ("time_norm" + n, "time_norm" + s)
        out = pair_up(left, nxt, [*[c + s for c in on], *bucket], [c + n for c in on + bucket], rest, dates)
    else:
        out = left.join(nxt, cond, how)
    if keys is not None:
        out = out.drop("_bk", "_bk" + n)
    if salted:
        out = out.drop("_salt", "_salt" + n)
    if max_days and max_days > 0:
        out = out.withColumn("date_diff" + s, F.datediff(cur_t, nxt_t))
    return out


def hop_actor(
    left: DataFrame,
    events: DataFrame,
    step: int = 1,
    max_days: int | None = None,
    how: str = "inner",
    salt: int | None = None,
    hot: list | None = None,
    reduce: bool = False,
    spread: bool = False,
):
    """Join each row's step-``step`` event to the same actor's earlier events.

    ``salt=S`` (inner joins) splits an actor over ``S`` join partitions:
    events are assigned a salt by a hash of their id and each left row is
    replicated to all ``S`` salts. Exact. ``hot`` (e.g. from
    :func:`hot_keys`) limits this to the listed actors, so only their left
    rows are replicated; without it every actor is salted. ``reduce`` (for a written
    ``left``, which is then read twice more) drops the events that no left row can
    reach before they are shuffled, unless ``left`` is small enough to be broadcast
    (:func:`eventtrails.operators.frontier.reduce_to_frontier`). ``spread`` (inner joins
    without ``salt``, of a written ``left``) divides the join by the pairs counted for
    each actor (:func:`spread_pairs`).
    """
    return equi_hop(left, events, step, "actor", max_days, how, salt, hot, reduce, spread)


def hop_actor_outer(
    left: DataFrame,
    events: DataFrame,
    step: int = 1,
    max_days: int | None = None,
    salt: int | None = None,
    hot: list | None = None,
) -> DataFrame:
    """:func:`hop_actor` that keeps rows without an earlier event, split like the
    inner one.

    The same rows as ``hop_actor(how="left")``, but an actor is divided by date
    buckets (``max_days``) and salts, which an outer join cannot do: the inner hop is
    written with a number for each left row, and the rows whose number has no pair
    are added with nulls. Only numbers are shuffled for that. Numbers belong to a
    written table, so a lost executor does not change them.
    """
    row = "_row"
    while row in left.columns or row in events.columns:
        row = "_" + row
    rows = cut_lineage(left.withColumn(row, F.monotonically_increasing_id()))
    pairs = cut_lineage(equi_hop(rows, events, step, "actor", max_days, "inner", salt, hot, reduce=True))
    alone = rows.join(pairs.select(row).distinct(), row, "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True).drop(row)


def hop_city(
    left: DataFrame,
    events: DataFrame,
    step: int = 1,
    max_days: int | None = None,
    how: str = "inner",
    salt: int | None = None,
    hot: list | None = None,
    reduce: bool = False,
    spread: bool = False,
):
    """Join each row's step-``step`` event to earlier events in the same city
    (``salt``, ``hot``, ``reduce`` and ``spread`` as in :func:`hop_actor`)."""
    return equi_hop(left, events, step, "city", max_days, how, salt, hot, reduce, spread)


def hop_geo(
    left: DataFrame,
    events: DataFrame,
    step: int = 1,
    max_km: float = 500.0,
    max_days: int | None = None,
    different_actor: bool = False,
    places: DataFrame | None = None,
    salt: int | None = None,
    spread: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Join each row's step-``step`` event to earlier events within ``max_km``.

    The distinct places of the current events are paired with the distinct
    places of ``events`` (``places`` may pass them in precomputed); rows are
    then expanded to the events at the neighbouring places by an equi-join
    on the place. ``different_actor`` requires another actor on the next
    event. ``salt=S`` splits a busy place over ``S`` join partitions and ``spread``
    divides the join by its pairs, as in :func:`hop_actor`. ``digits`` rounds the
    distance (once for each pair of places). Rows whose current event is unlocated find no neighbour, so an
    outer first hop followed by a geo hop yields the inner result.
    """
    s, n = step_suffix(step), step_suffix(step + 1)
    cur_lat, cur_lon = "lat" + s, "lon" + s
    centres = left.select(F.col(cur_lat).alias("lat"), F.col(cur_lon).alias("lon")).where(
        F.col("lat").isNotNull() & F.col("lon").isNotNull()
    )
    if places is None:
        places = events.select("lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    pairs = neighbour_places(centres, places, max_km).withColumnsRenamed(
        {"lat": "_plat", "lon": "_plon", "n_lat": "_nlat", "n_lon": "_nlon", "dist_km": "gps_diff" + s}
    )
    if digits is not None:
        pairs = pairs.withColumn("gps_diff" + s, F.round("gps_diff" + s, digits))
    spread = spread and not salt and _many(left)
    if spread:
        pairs = cut_lineage(pairs)
    # step 1: current event -> neighbouring places
    with_nb = left.join(
        pairs,
        (F.col(cur_lat) == F.col("_plat")) & (F.col(cur_lon) == F.col("_plon")),
        "inner",
    ).drop("_plat", "_plon")
    # step 2: neighbouring place -> its earlier events
    nxt = suffix(events, step + 1)
    cur_t, nxt_t = F.col("time_norm" + s), F.col("time_norm" + n)
    rest = _with_day_cap(nxt_t < cur_t, cur_t, nxt_t, max_days)
    if different_actor:
        rest = rest & (F.col("actor" + n) != F.col("actor" + s))
    cond = rest & (F.col("lat" + n) == F.col("_nlat")) & (F.col("lon" + n) == F.col("_nlon"))
    keys = _date_keys(cur_t, max_days)
    if keys is not None:
        with_nb = with_nb.withColumn("_bk", F.explode(keys))
        nxt = nxt.withColumn("_bk" + n, _bucket(F.col("time_norm" + n), max_days))
        cond = cond & (F.col("_bk") == F.col("_bk" + n))
    salted = bool(salt and salt > 1)
    if salted:
        with_nb = with_nb.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(int(salt) - 1))))
        nxt = nxt.withColumn("_salt" + n, F.pmod(F.xxhash64(F.col("e_id" + n)), F.lit(int(salt))).cast("int"))
        cond = cond & (F.col("_salt") == F.col("_salt" + n))
    if spread:
        bucket = ["_bk"] if keys is not None else []
        right = ["lat" + n, "lon" + n, *[b + n for b in bucket]]
        out = pair_up(with_nb, nxt, ["_nlat", "_nlon", *bucket], right, rest, ("time_norm" + n, "time_norm" + s))
    else:
        out = with_nb.join(nxt, cond, "inner")
    out = out.drop("_nlat", "_nlon", "_salt", "_salt" + n)
    if keys is not None:
        out = out.drop("_bk", "_bk" + n)
    if max_days and max_days > 0:
        out = out.withColumn("date_diff" + s, F.datediff(cur_t, nxt_t))
    gd = "gps_diff" + s
    return out.select(*[c for c in out.columns if c != gd], gd)
