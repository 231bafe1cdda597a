from __future__ import annotations

from collections import Counter

import corpus_pipeline as P
from eventtrails.llm import exact_dedup, ngram_join, quality, source_mix

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in P.STAGES] == ["quality classifier", "exact dedup", "near duplicates", "mix sources", "encode"]
    before = docs
    for k, (_, stage) in enumerate(P.STAGES):
        after = spark.createDataFrame(stage(spark, before, SF).collect(), *([docs.schema] if k < 4 else []))
        if k < 4:
            assert after.columns == docs.columns
        if k == 0:
            keep = {r.doc_id for r in quality.score_quality(before).collect() if r.keep}
        elif k == 1:
            keep = {r.doc_id for r in exact_dedup.exact_duplicates(before).collect() if r.kept}
        elif k == 2:
            keep = {r.class_id for r in ngram_join.ngram_join(before).collect()}
        elif k == 3:
            want = {r.doc_id: round(r.taken / r.size) for r in source_mix.mix_sources(before).collect()}
            assert Counter(r.doc_id for r in after.collect()) == {i: n for i, n in want.items() if n}
        if k < 3:
            assert {r.doc_id for r in after.collect()} == keep and 0 < after.count() <= before.count()
        before = after
    last = before.collect()
    assert last and all(r.exact for r in last)


def test_run_is_the_stages(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_ids", "ids", "exact"] and out.count() > 50
