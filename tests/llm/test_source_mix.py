from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest

from eventtrails.llm import source_mix as M
from eventtrails.llm import sql


def targets(sizes, weights, cap):
    """Water-filling round by round, in exact arithmetic."""
    out, free, left = {}, {s for s in sizes if sizes[s]}, Fraction(sum(sizes.values()))
    out |= {s: Fraction(0) for s in sizes if not sizes[s]}
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * weights[s] for s in free}
        out |= {s: Fraction(cap * sizes[s]) for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return out


def rows_of(seed=1):
    rng = random.Random(seed)
    sources = ["a", "b", "Ä", "ß", None, "z0", "z1", "hot"]
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(sources[:-1])) for i in range(150)]
    rows += [(1000 + i, "w " * rng.randint(1, 40), "hot") for i in range(200)]
    rows += [(2000, "one two", "tiny"), (2001, None, "wordless"), (2002, "\t\n ", "wordless"), (None, "a b c", "a")]
    return rows + [(3000, "x " * 100_000, "b")] + [(4000, "same row", "same")] * 9


@pytest.fixture(scope="module")
def mixed(docs_of):
    rows = rows_of()
    return rows, [r.asDict() for r in M.mix_sources(docs_of(rows)).collect()]


def test_targets_match_exact_water_filling(mixed):
    rows, got = mixed
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = targets(sizes, {s: k % 3 + 1 for k, s in enumerate(order)}, 3)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
    total = sum({r["source"]: r["target"] for r in got}.values())
    assert total == pytest.approx(sum(sizes.values()))


def test_taken_words_meet_the_targets(mixed):
    _, got = mixed
    taken, target, copies = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        copies[r["source"]] += 1
    for s in taken:  # equal rows share a fraction, rounded down in each
        assert abs(taken[s] - target[s]) <= (9 if s == "same" else 1), s


def test_matches_sql_and_reruns(docs_of, mixed):
    rows, got = mixed
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    rel = con.sql(sql.MIX_SOURCES)
    want = sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rel.fetchall()), key=str)
    mine = sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in rel.columns)) for r in got), key=str)
    assert mine == want
    again = M.mix_sources(docs_of(rows).repartition(7))
    assert sorted(map(str, (r.asDict() for r in again.collect()))) == sorted(map(str, got))


def test_mixed_documents_repeat_whole_rows(docs_of):
    rows = rows_of(5)
    docs = docs_of(rows)
    times = {(r.doc_id, r.source): round(r.taken / r.size + 1e-9) for r in M.mix_sources(docs).collect() if r.size and r.source != "same"}
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        if r.source != "same":
            got[(r.doc_id, r.source)] += 1
            assert (r.doc_id, r.text, r.source) in rows
    assert got == {k: v for k, v in times.items() if v}


def test_other_weights_and_empty_table(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a b c d", "x"), (2, "e f", "y")])
    even = M.mix_sources(docs, weights=lambda s: s.withColumn("weight", F.lit(1).cast("long")))
    assert {r.source: r.target for r in even.collect()} == {"x": 3.0, "y": 3.0}
    assert M.mix_sources(docs.limit(0)).count() == 0
    assert M.mix_sources(docs_of([(1, None, None), (2, "", "s")])).count() == 2
