from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from eventtrails.llm import collocations as C
from eventtrails.llm import sql

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _counts(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for d in range(1, 6):
                f.update((lang, tuple(w[i : i + d])) for i in range(len(w) - d + 1))
    return f, n


def _expected(rows, least, top):
    f, n = _counts(rows)
    phrases = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in phrases.items():
        if any(
            lang == other and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (other, q), b in phrases.items()
            if len(q) > len(p)
        ):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank, ranked = Counter(), []
    for r in out:
        rank[r[0]] += 1
        if rank[r[0]] <= top:
            ranked.append((r[0], rank[r[0]], *r[1:]))
    return ranked


def _frame(spark, rows):
    data = [(*r, 1, "x", 2, "y") for r in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, h long, word string, n int, phrase string")


def _got(df):
    return sorted(tuple(r) for r in df.collect())


def _rows(seed, docs=60):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "a|b", "é", "𝒳y", "state", "art", "new", "York", "x y", "-"] + [f"w{k}" for k in range(30)]
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", "! "]
    rows = []
    for i in range(docs):
        words = rng.choices(vocab, weights=[9] * 12 + [1] * 30, k=rng.randrange(0, 80))
        if i % 3 == 0:
            words += ["state", "of", "the", "art", "new"] * rng.randrange(1, 3)
        text = "".join(w + rng.choice(ends) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "fr", None])))
    return rows + [(900, None, "en"), (901, "", None), (902, " \t.\n", "xx"), rows[3], rows[3], (903, "one two", "yy")]


@pytest.mark.parametrize("group_leaves", [1 << 19, 40, 1])
def test_phrases_equal_brute_force(spark, group_leaves):
    rows = _rows(1)
    got = _got(C.collocations(_frame(spark, rows), least=4, top=50, group_leaves=group_leaves))
    want = sorted(_expected(rows, 4, 50))
    assert got == want and len(want) > 60


def test_sql_equals_brute_force():
    rows = _rows(2)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    got = con.execute(sql.collocations(least=4, top=50)).fetchall()
    assert sorted(got) == sorted(_expected(rows, 4, 50))


def test_groups_keep_their_budget(spark):
    seen = []
    rng = random.Random(4)
    rows = [(tuple(rng.choices([1, 2, 3], weights=[6, 2, 1], k=5)), i) for i in range(400)]
    leaves = spark.createDataFrame([("en", *w, 1 + n % 3) for w, n in rows], "lang string, w1 long, w2 long, w3 long, w4 long, w5 long, n long")
    leaves = leaves.groupBy("lang", *C._PARTS).agg(F.sum("n").alias("n"))
    f = Counter()
    for r in leaves.collect():
        w = tuple(r[f"w{k}"] for k in range(1, 6))
        f.update({w[:d]: r["n"] for d in range(2, 6)})
    whole = C._subtree

    def watched(depth, least):
        build = whole(depth, least)

        def checked(group):
            assert len(group) <= 2 * 10
            return build(group)

        seen.append(depth)
        return checked

    C._subtree = watched
    try:
        got = {tuple(r.phrase): r.f for r in C.subtree_counts(leaves, least=1, group_leaves=10).collect()}
    finally:
        C._subtree = whole
    assert got == dict(f) and max(seen) > 1


def test_equal_hashes_take_another_seed(spark, monkeypatch):
    real = C._hashed

    def colliding(strings, seed):
        h = real(strings, seed)
        return h if seed else h & 7

    monkeypatch.setattr(C, "_hashed", colliding)
    rows = _rows(5, 10)
    words, seed = C.vocabulary(_frame(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")))
    assert seed in (0, 1)  # the tasks' own copy of the function may be the real one


def test_full_filters_lose_nothing(spark):
    rows = _rows(6, 30)
    got = _got(C.collocations(_frame(spark, rows), least=3, top=1000, max_filter_bytes=4096))
    assert got == sorted(_expected(rows, 3, 1000))


def test_exact_scores_beyond_64_bits(spark):
    text = "big deal, " * 3
    rows = [(1, text, "en")] * 5
    assert _got(C.collocations(_frame(spark, rows), least=4, top=5)) == [("en", 1, "big deal", 15, 15, 15, 30, 2000)]
    huge = spark.sql("select cast(1000 as decimal(38,0)) a").select(
        F.expr("(1000 * cast(9000000000000 as decimal(17,0)) * cast(90000000000000000 as decimal(17,0))) div (cast(9000000000000 as decimal(19,0)) * cast(9000000000007 as decimal(19,0)))").alias("x")
    )
    assert huge.first().x == 1000 * 9000000000000 * 90000000000000000 // (9000000000000 * 9000000000007)


def test_empty_table_and_very_long_text(spark):
    assert C.collocations(_frame(spark, [(1, "x y", "en")]).limit(0)).count() == 0
    rows = [(1, "to be or not to be " * 150_000, "en"), (2, "y" * 3_000_000, "en")]
    assert _got(C.collocations(_frame(spark, rows))) == sorted(_expected(rows, 100, 2000))
