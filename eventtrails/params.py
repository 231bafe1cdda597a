"""Parameters of the registered queries, shared by Spark and the oracle SQL.

Chosen once for the fixture event view (``FIXTURES.md`` section 4): the
data spans 2024-01-01 to 2024-01-30 on a grid of 100 places, so ranges,
radii and day caps select some events and not all.
"""

INTERVAL_START = "2024-01-10"
INTERVAL_END = "2024-01-15"
#: The interval of the event view shifted back by EARLY_YEARS.
EARLY_YEARS = 1500
EARLY_START, EARLY_END = "0524-01-10", "524-1-15"
OPEN_START = "2024-01-20"

ACTOR = "USER_7"

POINT_LAT, POINT_LON, POINT_KM = 40.0, -104.0, 500.0
POINT_START = "2024-01-08"

COUNTRY_START, COUNTRY_END = "2024-01-05", "2024-01-25"

GEO_TRAIL_DEPTH, GEO_TRAIL_KM, GEO_TRAIL_DAYS = 4, 500.0, 2
CITY_TRAIL_DEPTH = 4
#: The original threshold of the actor/geo and actor/city trails: each hop's whole history.
TRAIL_DAYS = 365 * 200
CAP_TRAIL_DEPTH, CAP_TRAIL_KM, CAP_TRAIL_DAYS = 2, 300.0, 3
TWO_HOP_KM = 500.0

GRAPH_DEPTH, GRAPH_KM = 3, 300.0
#: The depth of the original graph, over the whole history.
DEEP_GRAPH_DEPTH = 6
CITY_GRAPH_DEPTH, CITY_GRAPH_DAYS = 3, 3

RELATED_DEPTH, RELATED_KM = 6, 300.0
#: Copies of each event in the exact counts: 100 ** 6 times the trails.
EXACT_COPIES = 100

ENRICH_KM = 50.0

HOP_KM = 300.0
GAP_DAYS = 5
#: Day cap and salts of the outer hop from all events.
OUTER_DAYS, OUTER_SALT = 2, 4

DIGITS = 3
