"""Command line: one query per run, as the original scripts were used.

``python -m eventtrails <query> --events PATH --out DIR [options]`` (or via
``spark-submit``) reads the events (``;`` text files, or a Parquet event
table with ``--table``), runs one query, writes a ``;`` CSV directory with a
header, and prints the wall time. The session comes from
``SparkSession.builder.getOrCreate()``, so master, memory and the shared
checkpoint folder are whatever the cluster submission sets.

Queries: ``time-interval``, ``near``, ``actor-countries``, ``trail``,
``two-hop``, ``graph``, ``most-related``, ``enrich``.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from .plans import counts, graph, places, search, trails
from .sinks import write_csv, write_events_text, write_graph
from .session import drop_intermediates
from .sources import read_events, read_events_table


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventtrails", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="query", required=True)

    def add(name, **kw):
        s = sub.add_parser(name, **kw)
        s.add_argument("--events", required=True, help="events: ; text file(s) or, with --table, Parquet")
        s.add_argument("--table", action="store_true", help="read a Parquet event table")
        s.add_argument("--places", action="store_true", help="the input has city and country columns")
        s.add_argument("--out", required=True, help="output directory")
        s.add_argument("--mode", default="errorifexists", help="write mode (errorifexists, overwrite)")
        s.add_argument("--single-file", action="store_true", help="write one CSV file (small results only)")
        return s

    s = add("time-interval", help="located events between two dates")
    s.add_argument("--start")
    s.add_argument("--end")
    s = add("near", help="events within a radius of a point")
    s.add_argument("--lat", type=float, required=True)
    s.add_argument("--lon", type=float, required=True)
    s.add_argument("--km", type=float, required=True)
    s.add_argument("--start")
    s.add_argument("--actor")
    s = add("actor-countries", help="one actor's events with a country")
    s.add_argument("--actor", required=True)
    s.add_argument("--start")
    s.add_argument("--end")
    for name in ("trail", "graph"):
        s = add(name, help="trails back from a root event" if name == "trail" else "nodes and edges of the trails")
        s.add_argument("--root", type=int, required=True)
        s.add_argument("--depth", type=int, default=6)
        s.add_argument("--second", choices=["geo", "city"], default="geo")
        s.add_argument("--km", type=float, default=500.0 if name == "trail" else 300.0)
        s.add_argument("--max-days", type=int)
        s.add_argument("--salt", type=int, help="split hot actors/cities over this many join partitions")
        s.add_argument("--hot-fraction", type=float, help="salt only keys above this share of the events")
    s = add("two-hop", help="same actor earlier, then another actor nearby")
    s.add_argument("--root", type=int, required=True)
    s.add_argument("--km", type=float, default=500.0)
    s = add("most-related", help="trail counts from each actor's latest event")
    s.add_argument("--depth", type=int, default=6)
    s.add_argument("--km", type=float, default=300.0)
    s.add_argument("--max-days", type=int)
    s.add_argument("--cell-split", type=int, help="k: sum whole cells k times finer than the radius")
    s = add("enrich", help="add city and country from a gazetteer (writes the 9-column text format)")
    s.add_argument("--gazetteer", required=True, help="Parquet: place_id, lat, lon, city, country")
    s.add_argument("--km", type=float, default=50.0)
    return p


def run(args: argparse.Namespace, spark: SparkSession) -> None:
    if args.table:
        ev = read_events_table(spark, args.events)
    else:
        places_needed = args.query == "actor-countries" or getattr(args, "second", "geo") == "city"
        ev = read_events(spark, args.events, places=args.places or places_needed)
    out = dict(path=args.out, mode=args.mode, single_file=args.single_file)
    q = args.query
    if q == "time-interval":
        write_csv(search.time_interval(ev, args.start, args.end), **out)
    elif q == "near":
        write_csv(search.events_near(ev, args.lat, args.lon, args.km, start=args.start, actor=args.actor), **out)
    elif q == "actor-countries":
        write_csv(search.actor_countries(ev, args.actor, args.start, args.end), **out)
    elif q == "trail":
        t = trails.trail(ev, args.root, args.depth, args.second, args.km, args.max_days, order=True,
                         salt=args.salt, hot_fraction=args.hot_fraction)
        write_csv(t, **out)
    elif q == "two-hop":
        write_csv(trails.trail_two_hop(ev, args.root, args.km), **out)
    elif q == "graph":
        nodes, edges = graph.trail_graph(ev, args.root, args.depth, args.km, args.second, args.max_days,
                                         salt=args.salt, hot_fraction=args.hot_fraction)
        write_graph(nodes, edges, **out)
    elif q == "most-related":
        write_csv(counts.most_related(ev, args.depth, args.km, args.max_days, cell_split=args.cell_split), **out)
    elif q == "enrich":
        gz = spark.read.parquet(args.gazetteer)
        write_events_text(places.enrich_places(ev, gz, args.km), args.out, places=True, mode=args.mode)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"eventtrails {args.query}").getOrCreate()
    t0 = time.time()
    run(args, spark)
    drop_intermediates(spark)
    print(f"{args.query} execution time: {time.time() - t0:.3f} s", file=sys.stderr)
    return 0
