"""Every registered query against its DuckDB oracle (sf0.001), as the driver does."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from eventtrails import oracle, registry

from .conftest import SF_SMALL

TABLES = ["events", "nation"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, repr(round(v, 9)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    return (1, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    yield c
    c.close()


def test_every_query_has_oracle():
    assert set(oracle.queries()) == set(registry.queries())
    assert set(registry.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["actor", "related_events"]
    assert df.count() > 0


CLUSTER_LIKE = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "23",
}


@pytest.mark.parametrize(
    "key", ["hop_geo", "trail_actor_geo", "trail_two_hop", "trail_graph_edges", "most_related", "enrich_places"]
)
def test_matches_oracle_without_aqe_or_broadcast(spark, con, key):
    """Sort-merge joins everywhere (as at scale), no runtime re-planning."""
    from .test_skew import conf

    with conf(spark, CLUSTER_LIKE):
        df = E.queries()[key](spark, SF_SMALL)
        cols = sorted(df.columns)
        got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[key])
    idx = [rel.columns.index(c) for c in cols]
    assert got == sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
