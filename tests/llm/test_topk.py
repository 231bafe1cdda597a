from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest

from eventtrails.llm import sql
from eventtrails.llm import topk as T

NAN, INF = float("nan"), float("inf")


def rows_of(seed=1, n=400, dims=8):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, [0.5] * dims) for i in range(60)]  # one common vector
    rows += [(n + 100, None), (n + 150, []), (n + 200, [0.1, None] * 4), (n + 250, [NAN] * dims), (n + 300, [INF] * dims)]
    rows += [(None, [0.9] * dims), (50, rows[50][1]), (100, [0.7] * dims), (1000, [0.3] * 3), (1001, [0.2] * 3), (2000, [0.4] * 5)]
    return rows


def brute(rows, k=5):
    usable = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, qv in usable:
        if q % 50:
            continue
        top = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in usable if i != q and len(v) == len(qv))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(top)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, query int, dims string")


@pytest.mark.parametrize("blocks", [(T.CANDIDATES_PER_BLOCK, T.QUERIES_PER_BLOCK), (37, 3)])
def test_matches_brute_force(spark, blocks):
    rows = rows_of()
    got = T.top_k(frame(spark, rows), candidates_per_block=blocks[0], queries_per_block=blocks[1])
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(1 << 20) + i, -float(1 << 21), 3.0]) for i in range(60)]
    assert sorted(map(tuple, T.top_k(frame(spark, rows)).collect())) == brute(rows)


def test_matches_sql(spark):
    rows = rows_of(2)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    rel = con.sql(sql.top_k())
    assert sorted(map(tuple, T.top_k(frame(spark, rows)).select(*rel.columns).collect())) == sorted(rel.fetchall())


def test_the_threshold_stops_early():
    """On skewed data the lists are not read to the end, and ties survive."""
    rng = np.random.default_rng(0)
    x = np.floor(rng.exponential(1, (5000, 4)) ** 3 * 10)
    ids, q = np.arange(5000), x[:3]
    reads = []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.ndim == 1:
                reads.append(len(at))
            return super().__getitem__(at)

    found = dict(T.threshold_topk(ids, x.view(Counting), np.arange(3), q, 5))
    for r in range(3):
        want = sorted((-float(s), int(i)) for i, s in enumerate(x @ q[r]) if i != r)[:5]
        assert [(-s, i) for s, i in found[r]] == want
    assert sum(reads) < 5000


def test_empty_and_few(spark):
    assert T.top_k(frame(spark, [(1, [1.0])]).limit(0)).count() == 0
    assert sorted(map(tuple, T.top_k(frame(spark, [(0, [1.0]), (1, [2.0])])).collect())) == [(0, 1, 1, 256 * 512)]
