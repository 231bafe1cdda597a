"""DuckDB oracle SQL for every registered query (see ``__spark_entry__``).

Written independently of the Spark code: plain joins with ``<`` on dates
and a nested-loop distance predicate instead of grids and windows, so a
match is evidence, not a tautology. Tables ``events`` and ``nation`` are
the driver's pre-registered parquet views.
"""

from __future__ import annotations

from . import params as P

EARTH_R = 6371.0


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Haversine km as a DuckDB expression over double columns."""
    a = (
        f"(sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2)"
        f" + sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2)"
        f" * cos(radians({lat1})) * cos(radians({lat2})))"
    )
    return f"({2 * EARTH_R} * atan2(sqrt({a}), sqrt(greatest(0.0, 1 - {a}))))"


# The event view (normalised: unknown city/country as NULL, unlocated lat/lon NULL).
EV = """
src AS (
  SELECT CAST(event_id AS INTEGER) AS e_id, ts, user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev AS (
  SELECT s.e_id,
         'PLACE_' || CAST(s.k AS VARCHAR) AS geo_name,
         CASE WHEN s.k % 20 <> 0 THEN CAST(CAST(25 + 3 * (s.k % 10) AS FLOAT) AS DOUBLE) END AS lat,
         CASE WHEN s.k % 20 <> 0 THEN CAST(CAST(-120 + 4 * (s.k // 10) AS FLOAT) AS DOUBLE) END AS lon,
         CASE WHEN s.k % 10 <> 5 THEN s.k END AS geonamesid,
         strftime(s.ts, '%Y-%m') AS time,
         CAST(s.ts AS DATE) AS time_norm,
         'USER_' || CAST(s.user_id AS VARCHAR) AS actor,
         CASE WHEN s.k % 20 <> 0 THEN 'CITY_' || CAST(s.k % 25 AS VARCHAR) END AS city,
         CASE WHEN s.k % 20 <> 0 THEN n.n_name END AS country
  FROM src s LEFT JOIN nation n ON n.n_nationkey = s.k % 25),
loc AS (SELECT * FROM ev WHERE lat IS NOT NULL AND lon IS NOT NULL)"""


def with_ev(body: str, extra_ctes: str = "") -> str:
    ctes = EV + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def d(x) -> str:
    return f"DATE '{x}'"


SCALAR = "e_id, geo_name, lat, lon, geonamesid, time, time_norm, actor"
CITYEV = "cityev AS (SELECT * FROM ev WHERE length(city) > 0)"


def latest(src: str, name: str, actor: str | None = None) -> str:
    """CTE ``name``: per actor the latest row of ``src`` (date, then id)."""
    where = f"WHERE actor = '{actor}'" if actor else ""
    return (
        f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY actor ORDER BY time_norm DESC, e_id DESC) AS rn FROM {src} {where}) WHERE rn = 1)"
    )


def days(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', {earlier}, {later}) AS INTEGER)"


def rnd(x: str) -> str:
    return f"round({x}, {P.DIGITS})"


# ---- sources -------------------------------------------------------------


def scan_events() -> str:
    return with_ev(f"SELECT {SCALAR} FROM ev")


def scan_events_places() -> str:
    return with_ev(f"SELECT {SCALAR}, city, country FROM ev")


def parse_loc() -> str:
    return with_ev(
        "SELECT e_id, CAST(CASE WHEN lat IS NULL THEN 0 ELSE 2 END AS INTEGER) AS n_parts, lat, lon FROM ev"
    )


def blank_to_null() -> str:
    return with_ev("SELECT e_id, coalesce(city, ' ') AS city_raw, city, country FROM ev")


def events_view_sql() -> str:
    return with_ev(
        "SELECT CAST(e_id AS VARCHAR) AS Id, "
        "actor || ' - ' || geo_name || ' - ' || CAST(time_norm AS VARCHAR) AS Label FROM ev"
    )


# ---- filters and scalars ---------------------------------------------------


def located_events() -> str:
    return with_ev(f"SELECT {SCALAR} FROM loc")


def events_with_city() -> str:
    return with_ev("SELECT e_id, actor, time_norm, city FROM ev WHERE length(city) > 0")


def haversine_km() -> str:
    return with_ev(f"SELECT e_id, {rnd(hav('lat', 'lon', P.POINT_LAT, P.POINT_LON))} AS dist_km FROM loc")


def event_label() -> str:
    return with_ev(
        "SELECT e_id, actor || ' - ' || geo_name || ' - ' || CAST(time_norm AS VARCHAR) AS Label FROM loc"
    )


# ---- searches ----------------------------------------------------------------


def time_interval() -> str:
    return with_ev(
        f"SELECT e_id, actor, geo_name, time_norm FROM loc "
        f"WHERE time_norm >= {d(P.INTERVAL_START)} AND time_norm <= {d(P.INTERVAL_END)}"
    )


def time_interval_early() -> str:
    moved = f"CAST(time_norm - INTERVAL {P.EARLY_YEARS} YEAR AS DATE)"
    return with_ev(
        f"SELECT e_id, actor, geo_name, {moved} AS time_norm FROM loc "
        f"WHERE {moved} >= {d(P.EARLY_START)} AND {moved} <= DATE '0524-01-15'"
    )


def time_interval_open() -> str:
    return with_ev(f"SELECT e_id, actor, geo_name, time_norm FROM loc WHERE time_norm >= {d(P.OPEN_START)}")


def _near(extra: str) -> str:
    h = hav("lat", "lon", P.POINT_LAT, P.POINT_LON)
    return with_ev(
        f"SELECT e_id, actor, time_norm, {rnd(h)} AS gps_diff FROM loc WHERE {h} < {P.POINT_KM} {extra}"
    )


def events_near_point() -> str:
    return _near(f"AND time_norm >= {d(P.POINT_START)}")


def events_near_point_by_actor() -> str:
    return _near(f"AND actor = '{P.ACTOR}'")


def actor_countries() -> str:
    return with_ev(
        f"SELECT e_id, actor, geo_name, time_norm, country FROM ev "
        f"WHERE length(country) > 0 AND actor = '{P.ACTOR}' "
        f"AND time_norm >= {d(P.COUNTRY_START)} AND time_norm <= {d(P.COUNTRY_END)}"
    )


def actor_timeline() -> str:
    return with_ev(f"SELECT e_id, geo_name, time_norm, actor FROM ev WHERE actor = '{P.ACTOR}'")


def _placed(sql: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})"


def trail_positions() -> str:
    per_date = f"SELECT time_norm3, count(*) AS trails FROM ({trail_max_days()}) GROUP BY time_norm3"
    upto = "sum(trails) OVER (ORDER BY time_norm3)"
    return (
        f"SELECT time_norm3, ({upto} - trails + 1)::BIGINT AS first, ({upto})::BIGINT AS last, trails "
        f"FROM ({per_date})"
    )


def result_nodes() -> str:
    return with_ev(
        "SELECT CAST(e_id AS VARCHAR) AS Id, "
        "actor || ' - ' || geo_name || ' - ' || CAST(time_norm AS VARCHAR) AS Label FROM loc "
        f"WHERE time_norm >= {d(P.INTERVAL_START)} AND time_norm <= {d(P.INTERVAL_END)}"
    )


def latest_per_actor() -> str:
    return with_ev(f"SELECT {SCALAR} FROM lt", latest("loc", "lt"))


def root_by_id() -> str:
    return with_ev(f"SELECT {SCALAR} FROM loc WHERE e_id IN (SELECT e_id FROM lt)", latest("loc", "lt", P.ACTOR))


def root_event() -> str:
    return with_ev(f"SELECT {SCALAR} FROM loc WHERE e_id IN (SELECT e_id FROM lt)", latest("loc", "lt"))


# ---- hops ------------------------------------------------------------------------


def hop_actor() -> str:
    return with_ev(
        "SELECT r.e_id, r.time_norm, r.actor, e.e_id AS e_id2, e.time_norm AS time_norm2, e.actor AS actor2 "
        "FROM lt r JOIN loc e ON e.actor = r.actor AND e.time_norm < r.time_norm",
        latest("loc", "lt"),
    )


def hop_actor_outer() -> str:
    return with_ev(
        "SELECT r.e_id, r.time_norm, r.actor, e.e_id AS e_id2, e.time_norm AS time_norm2 "
        "FROM lt r LEFT JOIN loc e ON e.actor = r.actor AND e.time_norm < r.time_norm",
        latest("loc", "lt"),
    )


def hop_actor_outer_split() -> str:
    g = days("r.time_norm", "e.time_norm")
    return with_ev(
        f"SELECT r.e_id, r.time_norm, r.actor, e.e_id AS e_id2, e.time_norm AS time_norm2, {g} AS date_diff "
        f"FROM loc r LEFT JOIN loc e ON e.actor = r.actor AND e.time_norm < r.time_norm AND {g} < {P.OUTER_DAYS}",
    )


def day_gap() -> str:
    g = days("r.time_norm", "e.time_norm")
    return with_ev(
        f"SELECT r.e_id, e.e_id AS e_id2, {g} AS date_diff "
        f"FROM lt r JOIN loc e ON e.actor = r.actor AND e.time_norm < r.time_norm AND {g} < {P.GAP_DAYS}",
        latest("loc", "lt"),
    )


def hop_geo() -> str:
    h = hav("r.lat", "r.lon", "e.lat", "e.lon")
    return with_ev(
        "SELECT r.e_id, r.time_norm, r.actor, e.e_id AS e_id2, e.time_norm AS time_norm2, e.actor AS actor2, "
        f"{rnd(h)} AS gps_diff FROM lt r JOIN loc e ON e.time_norm < r.time_norm AND {h} < {P.HOP_KM}",
        latest("loc", "lt"),
    )


def hop_city() -> str:
    return with_ev(
        "SELECT r.e_id, r.city, e.e_id AS e_id2, e.time_norm AS time_norm2, e.actor AS actor2 "
        "FROM lt r JOIN cityev e ON e.city = r.city AND e.time_norm < r.time_norm",
        CITYEV + "," + latest("cityev", "lt"),
    )


# ---- trails ------------------------------------------------------------------------


def sfx(n: int) -> str:
    return "" if n <= 1 else str(n)


def trail_sql(base: str, roots_cte: str, depth: int, second: str, km: float | None, max_days: int | None,
              extra_ctes: str = "") -> str:
    """Trail enumeration as a chain of joins (one CTE per hop)."""
    carry = ["e_id", "time_norm", "actor", "lat", "lon", "city"]
    ctes = [extra_ctes] if extra_ctes else []
    ctes.append(roots_cte)
    ctes.append(f"t0 AS (SELECT {', '.join(carry)} FROM rt)")
    out = ["e_id", "time_norm", "actor"]
    for step in range(1, depth + 1):
        s, n = sfx(step), sfx(step + 1)
        prev = f"t{step - 1}"
        sel = [f"t.*"] + [f"e.{c} AS {c}{n}" for c in carry]
        conds = [f"e.time_norm < t.time_norm{s}"]
        out += [f"e_id{n}", f"time_norm{n}", f"actor{n}"]
        if max_days and max_days > 0:
            g = days(f"t.time_norm{s}", "e.time_norm")
            conds.append(f"{g} < {max_days}")
            sel.append(f"{g} AS date_diff{s}")
            out.append(f"date_diff{s}")
        if step % 2 == 1:
            conds.append(f"e.actor = t.actor{s}")
        elif second == "geo":
            h = hav(f"t.lat{s}", f"t.lon{s}", "e.lat", "e.lon")
            conds.append(f"{h} < {km}")
            sel.append(f"{rnd(h)} AS gps_diff{s}")
            out.append(f"gps_diff{s}")
        else:
            conds.append(f"e.city = t.city{s}")
            out.append(f"city{s}")
        ctes.append(f"t{step} AS (SELECT {', '.join(sel)} FROM {prev} t JOIN {base} e ON {' AND '.join(conds)})")
    return with_ev(f"SELECT {', '.join(out)} FROM t{depth}", ",\n".join(ctes))


def trail_actor_geo() -> str:
    return trail_sql("loc", latest("loc", "rt", P.ACTOR), P.GEO_TRAIL_DEPTH, "geo", P.GEO_TRAIL_KM, P.TRAIL_DAYS)


def trail_by_id() -> str:
    return trail_sql("loc", latest("loc", "rt", P.ACTOR), P.GEO_TRAIL_DEPTH, "geo", P.GEO_TRAIL_KM, P.GEO_TRAIL_DAYS)


def trail_actor_city() -> str:
    return trail_sql(
        "cityev", latest("cityev", "rt", P.ACTOR), P.CITY_TRAIL_DEPTH, "city", None, P.TRAIL_DAYS, CITYEV
    )


def trail_max_days() -> str:
    return trail_sql("loc", latest("loc", "rt"), P.CAP_TRAIL_DEPTH, "geo", P.CAP_TRAIL_KM, P.CAP_TRAIL_DAYS)


def _two_hop(select: str) -> str:
    h = hav("t.lat2", "t.lon2", "e.lat", "e.lon")
    return with_ev(
        f"SELECT {select} FROM (SELECT r.e_id, r.actor, r.time_norm, e.e_id AS e_id2, e.actor AS actor2, "
        "e.time_norm AS time_norm2, e.lat AS lat2, e.lon AS lon2 "
        "FROM rt r LEFT JOIN loc e ON e.actor = r.actor AND e.time_norm < r.time_norm) t "
        f"JOIN loc e ON e.time_norm < t.time_norm2 AND e.actor <> t.actor2 AND {h} < {P.TWO_HOP_KM}",
        latest("loc", "rt", P.ACTOR),
    )


def trail_two_hop() -> str:
    return _two_hop(
        "t.e_id, t.actor, t.time_norm, t.e_id2, t.actor2, t.time_norm2, "
        "e.e_id AS e_id3, e.actor AS actor3, e.time_norm AS time_norm3"
    )


def abs_day_gap() -> str:
    return _two_hop(
        "t.e_id2, e.e_id AS e_id3, CAST(abs(date_diff('day', t.time_norm2, e.time_norm)) AS INTEGER) AS time_diff"
    )


# ---- graphs ----------------------------------------------------------------------------


def graph_sql(base: str, roots_cte: str, depth: int, second: str, km: float | None, max_days: int | None,
              extra_ctes: str = "") -> tuple[str, str]:
    """Node and edge SQL, expanding the distinct frontier hop by hop."""
    fc = "e_id, geo_name, time_norm, actor, lat, lon, city"
    ctes = [extra_ctes] if extra_ctes else []
    ctes += [roots_cte, f"f0 AS (SELECT DISTINCT {fc} FROM rt)"]
    lbl = lambda a: f"{a}.actor || ' - ' || {a}.geo_name || ' - ' || CAST({a}.time_norm AS VARCHAR)"
    if second == "geo":
        coords = lambda a: f"CAST(CAST({a}.lat AS FLOAT) AS VARCHAR) AS lat, CAST(CAST({a}.lon AS FLOAT) AS VARCHAR) AS lon"
        root_label = "s.actor"
    else:
        coords = lambda a: f"{a}.city AS City"
        root_label = lbl("s")
    node_parts, edge_parts = [], []
    for step in range(1, depth + 1):
        conds = ["e.time_norm < s.time_norm"]
        if max_days and max_days > 0:
            conds.append(f"{days('s.time_norm', 'e.time_norm')} < {max_days}")
        if step % 2 == 1:
            conds.append("e.actor = s.actor")
            label = "s.actor"
        elif second == "geo":
            conds.append(f"{hav('s.lat', 's.lon', 'e.lat', 'e.lon')} < {km}")
            label = "'Location'"
        else:
            conds.append("e.city = s.city")
            label = "'Location'"
        ctes.append(
            f"p{step} AS (SELECT s.e_id AS s_e_id, s.geo_name AS s_geo_name, s.time_norm AS s_time_norm, "
            f"s.actor AS s_actor, s.lat AS s_lat, s.lon AS s_lon, s.city AS s_city, {label} AS s_label, e.* "
            f"FROM f{step - 1} s JOIN {base} e ON {' AND '.join(conds)})"
        )
        ctes.append(f"f{step} AS (SELECT DISTINCT {fc} FROM p{step})")
        if step == 1:
            root = "(SELECT s_e_id AS e_id, s_geo_name AS geo_name, s_time_norm AS time_norm, s_actor AS actor, " \
                   "s_lat AS lat, s_lon AS lon, s_city AS city FROM p1)"
            node_parts.append(
                f"SELECT CAST(s.e_id AS VARCHAR) AS Id, {root_label} AS Label, {coords('s')} FROM {root} s"
            )
        node_parts.append(f"SELECT CAST(e.e_id AS VARCHAR) AS Id, {lbl('e')} AS Label, {coords('e')} FROM p{step} e")
        edge_parts.append(
            f"SELECT CAST(s_e_id AS VARCHAR) AS Source, CAST(e_id AS VARCHAR) AS Target, s_label AS Label FROM p{step}"
        )
    ctes_s = ",\n".join(ctes)
    nodes = with_ev("SELECT DISTINCT * FROM (" + " UNION ALL ".join(node_parts) + ")", ctes_s)
    edges = with_ev("SELECT DISTINCT * FROM (" + " UNION ALL ".join(edge_parts) + ")", ctes_s)
    return nodes, edges


def trail_graph(depth: int = P.GRAPH_DEPTH) -> tuple[str, str]:
    return graph_sql("loc", latest("loc", "rt", P.ACTOR), depth, "geo", P.GRAPH_KM, None)


def city_graph() -> tuple[str, str]:
    return graph_sql(
        "cityev", latest("cityev", "rt", P.ACTOR), P.CITY_GRAPH_DEPTH, "city", None, P.CITY_GRAPH_DAYS, CITYEV
    )


# ---- counts and enrichment --------------------------------------------------------------


def most_related_exact() -> str:
    """Every event ``EXACT_COPIES`` times: each hop has that many times the ways."""
    return most_related(f"CAST(c.f * {P.EXACT_COPIES ** P.RELATED_DEPTH} AS VARCHAR)")


def most_related(counted: str = "CAST(c.f AS BIGINT)") -> str:
    """Backward path counts with plain joins (no windows): f_k over state rows."""
    ctes = [
        "st AS (SELECT actor, time_norm, lat, lon, count(*) AS m FROM loc GROUP BY ALL)",
        "pl AS (SELECT DISTINCT lat, lon FROM st)",
        f"nb AS (SELECT a.lat, a.lon, b.lat AS n_lat, b.lon AS n_lon FROM pl a JOIN pl b "
        f"ON {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} < {P.RELATED_KM})",
        "f0 AS (SELECT actor, time_norm, lat, lon, m, CAST(1 AS HUGEINT) AS f FROM st)",
    ]
    kinds = ["actor" if i % 2 == 1 else "geo" for i in range(1, P.RELATED_DEPTH + 1)]
    for k, kind in enumerate(reversed(kinds), start=1):
        prev = f"f{k - 1}"
        if kind == "actor":
            join = f"LEFT JOIN {prev} y ON y.actor = x.actor AND y.time_norm < x.time_norm"
        else:
            join = (f"LEFT JOIN nb ON nb.lat = x.lat AND nb.lon = x.lon "
                    f"LEFT JOIN {prev} y ON y.lat = nb.n_lat AND y.lon = nb.n_lon AND y.time_norm < x.time_norm")
        ctes.append(
            f"f{k} AS (SELECT x.actor, x.time_norm, x.lat, x.lon, x.m, coalesce(sum(y.m * y.f), 0) AS f "
            f"FROM st x {join} GROUP BY x.actor, x.time_norm, x.lat, x.lon, x.m)"
        )
    ctes.append(latest("loc", "rt"))
    last = f"f{P.RELATED_DEPTH}"
    return with_ev(
        f"SELECT r.actor, {counted} AS related_events FROM rt r JOIN {last} c "
        "ON c.actor = r.actor AND c.time_norm = r.time_norm AND c.lat = r.lat AND c.lon = r.lon WHERE c.f > 0",
        ",\n".join(ctes),
    )


def enrich_places() -> str:
    shift = 0.1
    ctes = [
        "gk AS (SELECT DISTINCT k AS place_id FROM src WHERE k % 20 <> 0)",
        f"gz AS (SELECT g.place_id, CAST(CAST(25 + 3 * (g.place_id % 10) AS FLOAT) AS DOUBLE) + {shift} AS glat, "
        f"CAST(CAST(-120 + 4 * (g.place_id // 10) AS FLOAT) AS DOUBLE) + {shift} AS glon, "
        "'CITY_' || CAST(g.place_id % 25 AS VARCHAR) AS gcity, n.n_name AS gcountry "
        "FROM gk g LEFT JOIN nation n ON n.n_nationkey = g.place_id % 25)",
        "pts AS (SELECT DISTINCT lat, lon FROM loc)",
        f"cand AS (SELECT p.lat, p.lon, g.*, {hav('p.lat', 'p.lon', 'g.glat', 'g.glon')} AS dist "
        f"FROM pts p JOIN gz g ON {hav('p.lat', 'p.lon', 'g.glat', 'g.glon')} < {P.ENRICH_KM})",
        "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY dist, place_id) AS rn "
        "FROM cand) WHERE rn = 1)",
    ]
    return with_ev(
        "SELECT e.e_id, e.geo_name, e.lat, e.lon, e.geonamesid, e.time, e.time_norm, e.actor, "
        "b.gcity AS city, b.gcountry AS country FROM ev e LEFT JOIN best b ON b.lat = e.lat AND b.lon = e.lon",
        ",\n".join(ctes),
    )


def queries() -> dict[str, str]:
    tg_nodes, tg_edges = trail_graph()
    cg_nodes, cg_edges = city_graph()
    return {
        "scan_events": scan_events(),
        "scan_events_places": scan_events_places(),
        "parse_loc": parse_loc(),
        "blank_to_null": blank_to_null(),
        "events_view_sql": events_view_sql(),
        "located_events": located_events(),
        "events_with_city": events_with_city(),
        "haversine_km": haversine_km(),
        "event_label": event_label(),
        "time_interval": time_interval(),
        "time_interval_open": time_interval_open(),
        "time_interval_early": time_interval_early(),
        "csv_roundtrip": time_interval(),
        "csv_single_file": _placed(time_interval(), "time_norm, e_id"),
        "events_near_point": events_near_point(),
        "events_near_point_curve": events_near_point(),
        "events_near_point_by_actor": events_near_point_by_actor(),
        "actor_countries": actor_countries(),
        "actor_timeline": actor_timeline(),
        "time_interval_positions": _placed(time_interval(), "time_norm, e_id"),
        "actor_timeline_positions": _placed(actor_timeline(), "actor, time_norm, e_id"),
        "trail_positions": trail_positions(),
        "most_related_positions": _placed(most_related(), "related_events DESC, actor"),
        "result_nodes": result_nodes(),
        "latest_per_actor": latest_per_actor(),
        "root_event": root_event(),
        "root_by_id": root_by_id(),
        "hop_actor": hop_actor(),
        "hop_actor_outer": hop_actor_outer(),
        "hop_actor_outer_split": hop_actor_outer_split(),
        "day_gap": day_gap(),
        "hop_geo": hop_geo(),
        "hop_city": hop_city(),
        "trail_actor_geo": trail_actor_geo(),
        "trail_by_id": trail_by_id(),
        "trail_actor_city": trail_actor_city(),
        "trail_max_days": trail_max_days(),
        "trail_two_hop": trail_two_hop(),
        "abs_day_gap": abs_day_gap(),
        "graph_nodes_written": tg_nodes,
        "graph_edges_written": tg_edges,
        "trail_graph_nodes": tg_nodes,
        "trail_graph_edges": tg_edges,
        "trail_graph_edges_deep": trail_graph(P.DEEP_GRAPH_DEPTH)[1],
        "city_graph_nodes": cg_nodes,
        "city_graph_edges": cg_edges,
        "most_related": most_related(),
        "most_related_exact": most_related_exact(),
        "enrich_places": enrich_places(),
    }
