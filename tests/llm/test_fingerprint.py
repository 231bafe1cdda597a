from __future__ import annotations

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from eventtrails.llm import fingerprint as P

DIGITS = "0123456789abcdef"


def _signed(n):
    return n - (1 << 64) if n >> 63 else n


def _hash_long(v, seed=42):
    return _signed(xxhash.xxh64(struct.pack("<q", v), seed=seed & (2**64 - 1)).intdigest())


def _xx_int(v, seed):
    # four bytes go through the same tail step as in a byte string of that length
    return _signed(xxhash.xxh64(struct.pack("<i", v), seed=seed & (2**64 - 1)).intdigest())


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = [_signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in words]
    groups = [h[i : i + 5] for i in range(len(h) - 4)] if len(h) >= 5 else [h] if h else []
    out = []
    for g in groups:
        acc = 42
        for x in g:
            acc = _hash_long(x, acc)
        out.append(acc)
    return out


def _brute_print(text):
    least = {}
    for h in _shingles(text):
        b = (h >> 55) + 256
        least[b] = min(h, least.get(b, h))
    if not least:
        return ""
    out = []
    for b in range(512):
        if b in least:
            v = least[b]
        else:
            tried = (_xx_int(n, _xx_int(b, 42)) % 512 for n in range(P.TRIES))
            at = next((t for t in tried if t in least), None)
            if at is None:
                at = min(least, key=lambda t: _xx_int(-1, _xx_int(t, _xx_int(b, 42))))
            v = least[at]
        out.append(DIGITS[v & 15])
    return "".join(out)


def _likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    share = sum(x == y for x, y in zip(a, b)) / 512
    return max(0.0, (share - 1 / 16) / (1 - 1 / 16))


def _brute(rows):
    """rows: (id, text); results by id for distinct rows."""
    keyed = sorted(
        {(i is None, -1 if i is None else i, hashlib.sha256((t or "").encode()).digest(), t or "") for i, t in rows}
    )
    out = {}
    for n, (none, i, _, t) in enumerate(keyed):
        nxt = keyed[(n + 1) % len(keyed)][3]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        a, b, c = _brute_print(t), _brute_print(edited), _brute_print(nxt)
        row = (len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, _likeness(a, b), _likeness(a, c))
        out.setdefault(None if none else i, []).append(row)
    return out


def _rows(df):
    return [
        (r.doc_id, (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next))
        for r in df.collect()
    ]


def _same(got, want):
    assert got[:4] == want[:4]
    assert got[4] == pytest.approx(want[4]) and got[5] == pytest.approx(want[5])


def test_report_equals_brute_force(docs_of):
    rng = random.Random(3)
    vocab = [f"w{k}é" for k in range(400)]
    rows = [(i * 3, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 5, 9, 60, 700])))) for i in range(40)]
    rows += [(4, None), (7, ""), (8, " \n\t "), (10, rows[0][1]), (None, "last one of all here now"), (1, "a b\x0bc"), (2, "😀 " * 37)]
    want = _brute(rows)
    got = _rows(P.edited_report(docs_of(rows)))
    assert len(got) == len(rows)
    for i, r in got:
        _same(r, want[i][0])


def test_repeated_rows_and_ids_are_defined(docs_of):
    rows = [(5, "same text of two rows here")] * 4 + [(5, "another text of the same id"), (6, "the end of it all")]
    want = _brute(rows)
    got = _rows(P.edited_report(docs_of(rows)))
    assert len(got) == 6
    for i, r in got:
        assert any(r[:4] == w[:4] for w in want[i])
    assert sorted(r[1][1] for r in got if r[0] == 5).count(want[5][0][1]) in (1, 4)


def test_one_document_empty_table_and_very_long_text(docs_of):
    (only,) = _rows(P.edited_report(docs_of([(1, "one two three four five six seven eight")])))
    _same(only[1], _brute([(1, "one two three four five six seven eight")])[1][0])
    assert P.edited_report(docs_of([(1, "x")]).limit(0)).count() == 0
    long = " ".join(f"t{k % 70_000}" for k in range(200_000))
    got = dict(_rows(P.edited_report(docs_of([(1, long), (2, "short")]))))
    _same(got[1], _brute([(1, long), (2, "short")])[1][0])


def test_likeness_is_near_the_true_similarity(spark):
    rng = random.Random(11)
    rows = []
    for k in range(120):
        words = [f"v{rng.randrange(10**6)}" for _ in range(rng.choice([30, 200, 1500]))]
        other = words[: int(len(words) * rng.random())]
        other += [f"u{rng.randrange(10**6)}" for _ in range(len(words) - len(other))]
        a, b = set(_shingles(" ".join(words))), set(_shingles(" ".join(other)))
        rows.append((" ".join(words), " ".join(other), len(a & b) / len(a | b)))
    df = spark.createDataFrame(rows, "a string, b string, jaccard double")
    got = df.select("jaccard", P.likeness(P.fingerprint("a"), P.fingerprint("b")).alias("x")).collect()
    errors = [r.x - r.jaccard for r in got]
    assert abs(sum(errors) / len(errors)) < 0.015  # the correction leaves no bias
    assert max(map(abs, errors)) < 0.12


def test_following_over_ranges(spark):
    rows = spark.createDataFrame([(k, f"x{k}") for k in range(0, 3000, 3)], "id long, v string").repartition(7)
    got = {r.id: r.nxt.id for r in P.following(rows, [F.col("id").asc()], ["id", "v"], "nxt").collect()}
    ids = list(range(0, 3000, 3))
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_each_text_is_fingerprinted_once(docs_of, monkeypatch):
    """A text's own fingerprint and the one for the document before it are one."""
    from eventtrails.llm import fingerprint as module

    calls = []
    real = module.fingerprint
    monkeypatch.setattr(module, "fingerprint", lambda text: calls.append(text) or real(text))
    rows = module.edited_report(docs_of([(i, f"a{i} b c d e f g{i}") for i in range(5)])).collect()
    assert sorted(calls) == ["edited", "text"]
    assert len(rows) == 5 and all(len(r.fingerprint) == module.BINS for r in rows)
