"""Relational building blocks: filters, the distance join, hops, picks."""

from .filters import (
    between_dates,
    by_actor,
    latitude_band,
    located,
    root,
    with_city,
    with_country,
    within_radius,
)
from .hops import hop_actor, hop_actor_outer, hop_city, hop_geo, hot_keys, step_suffix, suffix
from .ranking import latest_per_actor, ordered, positions
from .spatial import (
    distance_join,
    neighbour_places,
    neighbour_spreader,
    neighbour_sums,
    with_cell,
    with_neighbour_cells,
)

__all__ = [
    "between_dates",
    "by_actor",
    "distance_join",
    "hop_actor",
    "hop_actor_outer",
    "hop_city",
    "hop_geo",
    "hot_keys",
    "latest_per_actor",
    "latitude_band",
    "located",
    "neighbour_places",
    "neighbour_spreader",
    "neighbour_sums",
    "ordered",
    "positions",
    "root",
    "step_suffix",
    "suffix",
    "with_cell",
    "with_city",
    "with_country",
    "with_neighbour_cells",
    "within_radius",
]
