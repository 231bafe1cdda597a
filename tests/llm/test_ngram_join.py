from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from eventtrails.llm import ngram_join as J


def brute(rows, threshold=0.8):
    """Class, smallest connected id and links of every row."""

    def shingles(t):
        w = (t or "").encode().split()
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    classes = defaultdict(list)
    for i, t in rows:
        classes[shingles(t)].append(i)
    least = {s: min(ids, key=lambda i: (i is None, i or 0)) for s, ids in classes.items()}
    sets, index, common = list(classes), defaultdict(list), Counter()
    for k, s in enumerate(sets):
        for x in s:
            common.update((j, k) for j in index[x])
            index[x].append(k)
    root, links = list(range(len(sets))), [len(classes[s]) - 1 for s in sets]

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), n in common.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= threshold:
            links[a] += len(classes[sets[b]])
            links[b] += len(classes[sets[a]])
            root[find(a)] = find(b)
    top = {}
    for k, s in enumerate(sets):
        top[find(k)] = min(top.get(find(k), least[s]), least[s], key=lambda i: (i is None, i or 0))
    at = {s: k for k, s in enumerate(sets)}
    out = []
    for i, t in rows:
        s = shingles(t)
        out.append((i, least[s], top[find(at[s])], links[at[s]]))
    return sorted(out, key=str)


def rows_of(seed=1):
    rng = random.Random(seed)

    def prose(n):
        return [rng.choice("the of and in a to is it for on with as at by from or".split()) + str(rng.randint(0, 300)) for _ in range(n)]

    texts = []
    passage = prose(60)
    for _ in range(25):
        base = prose(rng.randint(5, 200))
        texts += [base, base]
        for _ in range(rng.randint(0, 5)):
            near = list(base)
            for _ in range(rng.randint(1, 3)):
                near[rng.randrange(len(near))] = "edit" + str(rng.randint(0, 9))
            texts.append(near)
        texts.append(base[: len(base) // 2] + passage)
    hot = prose(120)
    for k in range(60):  # a hot group of near copies
        near = list(hot)
        near[rng.randrange(120)] = f"e{k}"
        texts.append(near)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(5000, ""), (5001, None), (5002, " \n"), (5003, "one"), (5004, "one  "), (5005, "one two three four"), (None, rows[0][1]), (None, "only null id")]
    return rows + [(6000, "w " * 30_000), (6001, "w " * 30_001), (3, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("block", [J.BLOCK, 8])
def test_matches_brute_force(docs_of, block):
    rows = rows_of()
    got = J.ngram_join(docs_of(rows), block=block)
    assert got.columns == ["doc_id", "copy_of", "class_id", "n_links"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_one_document_of_each_group_stays(docs_of):
    rows = rows_of(4)
    docs = docs_of(rows)
    kept = J.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = Counter(r.doc_id for r in kept.collect())
    # rows that agree in id and text are one document
    want = {c for _, _, c, _ in brute(rows)}
    assert set(got) == want and all(n == sum(1 for i, _ in rows if i == d) for d, n in got.items() if d is not None)


def test_prefixes_shorten_to_the_target():
    assert J.last_depth(0.8, 0.9999, trees=20, path=5) == 4
    assert J.last_depth(0.8, 0.9, trees=20, path=5) == 5
    assert J.chance(0.8, 4, 20) > 0.9999 > J.chance(0.8, 5, 20)


def test_components(spark):
    rng = random.Random(2)
    chain = [(f"{k:03d}", f"{k + 1:03d}") for k in range(40)]
    edges = chain + [("x", "y"), ("y", "z"), ("z", "x"), ("s", "s")] + [("hub", f"h{k}") for k in range(50)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in J.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"{k:03d}"] for k in range(41)} == {"000"} and got["z"] == "x" and got["h7"] == "h0" and "s" not in got


def test_empty_and_single(docs_of):
    empty = docs_of([(1, "a")]).limit(0)
    assert J.ngram_join(empty).count() == 0 and J.drop_near_duplicates(empty).count() == 0
    assert [tuple(r) for r in J.ngram_join(docs_of([(1, "a b")])).collect()] == [(1, 1, 1, 0)]
