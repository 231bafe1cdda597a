"""Exact top-k inner products by the threshold algorithm (Fagin, Lotem, Naor).

Candidates are dealt into blocks, queries into blocks, and each pair of blocks is
one group. Within a group every dimension has the block's candidates sorted by
their component. Sorted access goes down all lists at once, from the end that the
sign of the query's component favours; every vector met is scored in full (random
access). No vector not yet met can score above the sum of the query's components
times the list values reached, so a query stops once its k-th score beats that
bound, strictly, since equal scores go to the smaller id. Block results, at most k
rows a query and block, are merged by a last aggregate.

Sizes. A group holds one block of each side whatever the table's size; the sides
are copied once per block of the other. Block counts follow the exact row counts.

Defined cases: vectors that are null, empty, or hold null or non-finite
components, and rows with a null id, take no part; equal rows (id and vector)
count once; different vectors under one id are separate rows, none of which is a
candidate of a query with that id; vectors of different lengths are not compared;
a query with fewer than k candidates returns all; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared as S

CANDIDATES_PER_BLOCK = 16384
QUERIES_PER_BLOCK = 2048
#: Depth of the first round of sorted access; it doubles every round.
FIRST_DEPTH = 16
#: Largest score that float64 sums exactly.
EXACT = float(1 << 53)


def scaled(vector: Column, factor: float) -> Column:
    """Every component as ``floor(factor * x)``, kept as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))).cast("double"))


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def threshold_topk(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """The threshold algorithm over one block; yields each query's best ``(score, id)``.

    Queries go down the lists in step, so a round's random accesses are one
    matrix product for all queries that have not stopped.
    """
    n, dims = x.shape
    ascending = np.argsort(x, axis=0, kind="stable")  # the sorted lists, one a dimension
    met = np.zeros(n, dtype=bool)
    active = np.arange(len(q))
    best_score = np.full((len(q), 0), -np.inf)
    best_id = np.zeros((len(q), 0), dtype=np.int64)
    depth, reached = FIRST_DEPTH, 0
    columns = np.arange(dims)
    while len(active):
        depth = min(depth, n)
        front = np.unique(np.concatenate([ascending[reached:depth].ravel(), ascending[n - depth : n - reached].ravel()]))
        front = front[~met[front]]
        met[front] = True
        for lo in range(0, len(front), 4096):
            part = front[lo : lo + 4096]
            scores = q[active] @ x[part].T
            scores[query_ids[active][:, None] == ids[part][None, :]] = -np.inf
            all_scores = np.concatenate([best_score[active], scores], axis=1)
            all_ids = np.concatenate([best_id[active], np.broadcast_to(ids[part], scores.shape)], axis=1)
            if all_scores.shape[1] > k:
                # whatever ties with the k-th score stays until ids decide
                kth = -np.partition(-all_scores, k - 1, axis=1)[:, k - 1]
                top = np.empty((len(active), k)), np.empty((len(active), k), dtype=np.int64)
                for r in range(len(active)):
                    at = np.flatnonzero(all_scores[r] >= kth[r])
                    at = at[np.lexsort((all_ids[r, at], -all_scores[r, at]))[:k]]
                    top[0][r], top[1][r] = all_scores[r, at], all_ids[r, at]
                all_scores, all_ids = top
            if all_scores.shape[1] != best_score.shape[1]:
                grown = np.full((len(q), all_scores.shape[1]), -np.inf), np.zeros((len(q), all_scores.shape[1]), dtype=np.int64)
                grown[0][:, : best_score.shape[1]], grown[1][:, : best_id.shape[1]] = best_score, best_id
                best_score, best_id = grown
            best_score[active], best_id[active] = all_scores, all_ids
        reached = depth
        if reached >= n:
            break
        low, high = x[ascending[reached - 1], columns], x[ascending[n - reached], columns]
        bound = np.where(q[active] > 0, q[active] * high, q[active] * low).sum(axis=1)
        if best_score.shape[1] >= k:
            active = active[best_score[active][:, k - 1] <= bound]
        depth *= 2
    for r in range(len(q)):
        yield r, [(s, i) for s, i in zip(best_score[r], best_id[r], strict=True) if s > -np.inf]


def _exact(x: np.ndarray, q: np.ndarray):
    """Arrays whose products are exact: float64, or Python integers for huge values."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    if most < EXACT:
        return x, q
    as_int = np.frompyfunc(int, 1, 1)
    return as_int(x), as_int(q)


def _block(k: int):
    def run(key, queries: pd.DataFrame, cands: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(cands):
            x, q = np.stack(cands["v"].to_numpy()), np.stack(queries["v"].to_numpy())
            ids, query_ids = cands["id"].to_numpy(), queries["id"].to_numpy()
            row = queries["query"].to_numpy()
            x, q = _exact(x, q)
            if x.dtype == object:
                scores = q.dot(x.T)
                found = (
                    (r, sorted(((s, i) for s, i in zip(scores[r], ids, strict=True) if i != query_ids[r]), key=lambda t: (-t[0], t[1]))[:k])
                    for r in range(len(q))
                )
            else:
                found = threshold_topk(ids, x, query_ids, q, k)
            out = [(row[r], query_ids[r], int(i), int(s)) for r, top in found for s, i in top]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidates_per_block: int = CANDIDATES_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """Each query's ``k`` best candidates: ``(query_id, rank, vec_id, score)``.

    Queries are the rows whose id ``every`` divides. Components become
    ``floor(scale * x)``, so scores are exact integers.
    """
    S.ship_code(vectors.sparkSession)
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        .filter(F.col("id").isNotNull() & _usable(F.col("v")))
        .select("id", scaled(F.col("v"), scale).alias("v"))
        .withColumn("dims", F.size("v"))
        .withColumn("query", F.xxhash64("id", "v"))
        .distinct()
    )
    n = vectors.count()
    c_blocks, q_blocks = max(1, -(-n // candidates_per_block)), max(1, -(-(n // every) // queries_per_block))
    spread = F.abs(F.col("query"))
    cands = rows.withColumn("cb", spread % c_blocks).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    asked = (
        rows.filter(F.col("id") % every == 0)
        .withColumn("qb", (spread % q_blocks).cast("int"))
        .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))
    )
    keys = ["dims", "cb", "qb"]
    cols = [*keys, "query", "id", "v"]
    found = (
        asked.select(*cols)
        .groupBy(*keys)
        .cogroup(cands.select(*cols).groupBy(*keys))
        .applyInPandas(_block(k), "query long, query_id long, vec_id long, score long")
    )
    best = W.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
