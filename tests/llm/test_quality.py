from __future__ import annotations

import numpy as np
import pytest

from eventtrails.llm import quality as Q
from eventtrails.llm import shared as S

SF = "/root/testdata/sf0.01"


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(3)
    n, k = 40_000, len(Q.LABELLERS)
    good = rng.random(n) < 0.8
    right = np.linspace(0.75, 0.97, k)
    v = np.where(rng.random((n, k)) < right, ~good[:, None], good[:, None]).astype(int)
    v[rng.random((n, k)) < 0.2] = Q.NONE
    patterns, counts = np.unique((v * 3 ** np.arange(k)).sum(axis=1), return_counts=True)
    model = Q.fit_label_model(patterns, counts)
    assert model.good == pytest.approx(0.8, abs=0.02)
    assert np.allclose(model.outcome[0][:, Q.GOOD], right, atol=0.03)
    assert np.allclose(model.outcome[1][:, Q.BAD], right, atol=0.05)


def test_scores_agree_with_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = Q.score_quality(docs).join(labels, "doc_id").select("quality", "keep").collect()
    right = sum(r.keep == (r.quality == 1) for r in rows) / len(rows)
    kept = [r.keep for r in rows if r.quality == 1]
    assert right >= 0.98 and sum(kept) / len(kept) >= 0.99


def test_hard_rows(docs_of, spark):
    good = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    rows = [(i, t) for i, t in enumerate(good)]
    rows += [(900, None), (901, ""), (902, " \n"), (None, good[0]), (903, good[0]), (903, good[0]), (904, "buy buy " * 60_000), (905, "é" * 100_000)]
    docs = docs_of(rows)
    got = Q.score_quality(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert not any(by[k].keep for k in (900, 901, 902, 904)) and by[900].score == 0
    assert by[None].score == by[0].score == by[903].score
    kept = Q.keep_quality(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)


def test_empty_and_wordless_tables(docs_of):
    empty = docs_of([(1, "a")]).limit(0)
    assert Q.score_quality(empty).count() == 0 and Q.keep_quality(empty).count() == 0
    assert [r.keep for r in Q.score_quality(docs_of([(1, None), (2, "")])).collect()] == [False, False]


def test_copies_do_not_shrink_the_sample(docs_of, spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(300).collect()]
    docs = docs_of(list(enumerate(texts)))
    copies = spark.range(40_000).selectExpr("id + 1000 AS doc_id").crossJoin(docs.filter("doc_id = 0").drop("doc_id"))
    assert Q.keep_quality(copies).count() == 40_000
    assert S.least_hashes(docs.unionByName(copies), "text", Q.SAMPLE) == S.least_hashes(docs, "text", Q.SAMPLE)


def test_small_samples_are_the_smallest_distinct_hashes(docs_of):
    docs = docs_of([(i, f"text {i % 50}") for i in range(500)])
    least = S.least_hashes(docs, "text", 1000)
    assert len(least) == 50 and least == sorted(set(least)) and S.least_hashes(docs, "text", 7) == least[:7]


def test_without_a_sample_the_weak_label_scores(docs_of, spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(100).collect()]
    got = Q.score_quality(docs_of(rows), sample=0).collect()
    assert all(r.score == r.weak_label for r in got) and any(r.keep for r in got)
