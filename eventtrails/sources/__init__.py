"""Event sources: the ``;`` text format, parquet event tables, the fixture view."""

from .events import (
    BASE_COLUMNS,
    EVENT_PLACE_SCHEMA,
    EVENT_SCHEMA,
    PLACE_COLUMNS,
    blank_to_null,
    header_line,
    loc_literal,
    parse_lines,
    parse_loc,
    read_events,
    read_events_table,
    to_lines,
    with_point,
)
from .fixture import fixture_events, fixture_gazetteer


def register(spark, df, name: str):
    """Register ``df`` as a temp view so it can be queried with ``spark.sql``."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


__all__ = [
    "BASE_COLUMNS",
    "EVENT_PLACE_SCHEMA",
    "EVENT_SCHEMA",
    "PLACE_COLUMNS",
    "blank_to_null",
    "fixture_events",
    "fixture_gazetteer",
    "header_line",
    "loc_literal",
    "parse_lines",
    "parse_loc",
    "read_events",
    "read_events_table",
    "register",
    "to_lines",
    "with_point",
]
