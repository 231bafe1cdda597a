"""eventtrails: dated, located events with actors, as Spark DataFrame functions.

Searches by date range, distance, actor and country; trails back in time
through alternating same-actor and nearby (or same-city) hops; trail graphs;
per-actor trail counts; place enrichment from a gazetteer. Every function
takes and returns DataFrames and runs as native Spark plans (no Python UDFs,
no cartesian joins).
"""

__version__ = "0.1.0"
