"""Date expressions used by ranges and trail hops."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_gap(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` (``datediff(later, earlier)``)."""
    return F.datediff(_c(later), _c(earlier))


def abs_day_gap(a, b) -> Column:
    """Undirected gap in days between two dates."""
    return F.abs(F.datediff(_c(a), _c(b)))


def date_lit(value) -> Column:
    """A DATE literal from ``date``/``datetime``/ISO text (``yyyy-M-d`` allowed).

    Built from its parts, which holds for any year (a Python ``date`` literal
    does not before the year 1000); Catalyst folds it to a constant that is
    pushed to the scan like any other.
    """
    if isinstance(value, _dt.date):
        y, m, d = value.year, value.month, value.day
    else:
        y, m, d = (int(p) for p in str(value).strip().split("-"))
    return F.make_date(F.lit(y), F.lit(m), F.lit(d))


def day_lit(days: int) -> Column:
    """A DATE literal from days since 1970-01-01, in any year."""
    return F.date_from_unix_date(F.lit(int(days)))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
