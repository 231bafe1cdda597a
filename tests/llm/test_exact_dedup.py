from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from eventtrails.llm import exact_dedup as D


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, order[0], len(ids), k == 0, sha) for k, i in enumerate(order)]
    return sorted(out, key=str)


def rows_of(seed=1, n=400):
    rng = random.Random(seed)
    texts = ["", None, "a b", "a\t\n b", "a  b ", " a b", "x" * 50_000, "é ß\x0b日"] + [f"t {k}" for k in range(60)]
    rows = [(i, rng.choice(texts)) for i in range(n)] + [(None, "a b"), (None, "t 1"), (None, "only here"), (5, "t 3"), (5, "t 3")]
    return rows + [(1000 + i, "hot  text") for i in range(200)]


def test_matches_brute_force(docs_of):
    rows = rows_of()
    got = D.exact_duplicates(docs_of(rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_full_filter_changes_nothing(docs_of):
    """At the bound of one block most rows are false positives: same result."""
    rows = rows_of(2) + [(5000 + i, f"single {i}") for i in range(3000)]
    got = D.exact_duplicates(docs_of(rows), max_filter_bytes=16)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_dropping_keeps_one_row_of_each_text_and_all_columns(docs_of):
    rows = rows_of(3)
    docs = docs_of(rows)
    kept = D.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    want = sorted(((i, t) for i, _, _, k, t in brute(rows) if k), key=str)
    got = sorted(((r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in kept.collect()), key=str)
    assert got == want


def test_empty_table(docs_of, spark):
    empty = docs_of([(1, "a")]).limit(0)
    assert D.exact_duplicates(empty).count() == 0 and D.drop_exact_duplicates(empty).count() == 0


def test_main_path_runs_no_python(docs_of):
    plan = D.exact_duplicates(docs_of(rows_of()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
