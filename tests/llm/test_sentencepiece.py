from __future__ import annotations

import gc
import itertools
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece

from eventtrails.llm import sentencepiece_codec as C
from eventtrails.llm import shared as S

ALPHABET = "abc theing▁ \n\té日😀 ﷐ "


@pytest.fixture(scope="module")
def vocab():
    return C.load_vocabulary()


def texts(seed=1, n=250):
    rng = random.Random(seed)
    out = ["", " ", "a", "  two  spaces ", "hello\n\tworld", "▁x", "日本語 テスト 😀", "x" * 700 + " y", "ab" * 3000]
    return out + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 150))) for _ in range(n)]


def test_streaming_and_batch_equal_the_library(vocab):
    sp = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    coder = C.BatchEncoder(vocab)
    sample = texts()
    ids, counts = coder.encode(sample)
    at = 0
    for t, n in zip(sample, counts, strict=True):
        mine, at = ids[at : at + n].tolist(), at + n
        assert mine == list(C.viterbi(vocab, C.to_symbols(t), coder.fits))
        assert C.decode(vocab, mine) == t
        if C.MARK in t:  # the library takes a mark for a space
            assert sp.encode(t.replace(C.MARK, " ")) != mine
        else:
            assert mine == sp.encode(t)


def test_whole_documents_get_the_librarys_ids(vocab):
    sp = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    docs = [t or "" for t in docs if C.MARK not in (t or "")]
    got = []
    for counts, ids, exact in C.BatchEncoder(vocab).encode_rows(docs):
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert all(exact)
    assert got == sp.encode(docs)


def test_pieces_fit_as_merging_their_text_says(vocab):
    fits, rng = C.Fits(vocab), random.Random(5)
    pieces = [p for p in vocab.ids if fits.merged(p) == [p]]
    begins: dict[str, list[str]] = {}
    for p in pieces:
        begins.setdefault(p[0], []).append(p)
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(5000)]
    # pairs of which the joined beginning is a piece, so that merges do cross
    longer = [rng.choice([p for p in pieces if len(p) > 2]) for _ in range(5000)]
    pairs += [(p[:k], rng.choice(begins[p[k]])) for p in longer for k in [rng.randint(1, len(p) - 1)] if p[:k] in vocab.ids and p[k] in begins]
    pairs = [(a, b) for a, b in pairs if fits.merged(a) == [a]]
    answers = [fits.apart(a, b) for a, b in pairs]
    assert answers == [fits.merged(a + b) == [a, b] for a, b in pairs]
    assert 500 < sum(answers) < len(pairs) - 500


def test_merges_of_equal_or_unordered_scores():
    # "bc" is better than "ab" but forms "abc" only by a worse merge; "aa" ties with itself
    scores = {"a": 0.0, "b": 0.0, "c": 0.0, "d": 0.0, "aa": -1.0, "bc": -3.0, "ab": -4.0, "abc": -2.0, "cd": -2.0}
    ids = {p: i for i, p in enumerate(scores)}
    vocab = C.Vocabulary(ids, scores, [0] * 256, [p.encode() for p in ids], 3)
    fits = C.Fits(vocab)
    for n in range(1, 7):
        for letters in itertools.product("abcd", repeat=n):
            text = "".join(letters)
            assert [vocab.pieces[i].decode() for i in C.viterbi(vocab, text, fits)] == fits.merged(text)


def test_long_texts_are_read_in_chunks(vocab, monkeypatch):
    sp = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    monkeypatch.setattr(C, "SLICE_CHARS", 64)
    coder = C.BatchEncoder(vocab)
    long = ["one two  three\n four " * 40, "x" * 500, " " * 300, "日本語" * 100 + " y " * 50]
    sample = ["short", "", *long, "a b", long[0][:70]]
    got = []
    for counts, ids, exact in coder.encode_rows(sample):
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert all(exact)
    assert got == sp.encode(sample)
    assert max(len(c) for c, _ in coder.chunks(long[0])) <= 80


def test_the_library_decodes_the_ids(vocab):
    sp = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    for t in ["Hello world", "  two  spaces ", "naïve\ncafé ▁ 日本 😀"]:
        assert sp.decode(list(C.viterbi(vocab, C.to_symbols(t)))) == t


def test_the_window_stays_bounded(vocab):
    search = C.StreamingViterbi(vocab)
    ids = search.feed(C.to_symbols("the quick brown fox " * 3000)) + search.close()
    assert search.widest <= 8 * vocab.longest and len(ids) > 3000


def test_documents_round_trip(docs_of):
    sample = texts(2, 60)
    rows = [(i, t) for i, t in enumerate(sample)] + [(None, None), (7, "again"), (7, "again")]
    coded = C.encode_documents(docs_of(rows))
    got = coded.collect()
    assert all(r.exact and len(r.ids) == r.n_ids for r in got) and len(got) == len(rows)
    assert sorted(map(tuple, C.decode_documents(coded).collect()), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_empty_table(docs_of):
    assert C.encode_documents(docs_of([(1, "a")]).limit(0)).count() == 0


def encoders_left(batches):
    """Reports how many encoders live in this Python worker."""
    for batch in batches:
        n = sum(type(x).__name__ == "BatchEncoder" for x in gc.get_objects())
        yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], names=["n"])


def test_workers_drop_the_encoder_with_the_first_other_task(spark, docs_of):
    coded = C.encode_documents(docs_of([(i, f"some text {i}") for i in range(40)]).repartition(8))
    assert coded.count() == 40
    S.ship_code(spark)
    count = spark.range(0, 64, 1, 16).mapInArrow(encoders_left, "n long")
    assert [r.n for r in count.collect()] == [0] * 64


def test_rows_are_read_a_slice_at_a_time(vocab, monkeypatch):
    monkeypatch.setattr(C, "SLICE_CHARS", 100)
    read = []
    rows = (read.append(i) or "ten chars " for i in range(1000))
    for k, (counts, _, exact) in enumerate(C.BatchEncoder(vocab).encode_rows(rows)):
        assert len(counts) == 10 and all(exact)
        assert len(read) <= 10 * (k + 1) + 1
    assert len(read) == 1000


def test_known_pairs_and_words_take_bounded_memory(vocab, monkeypatch):
    monkeypatch.setattr(C, "CACHE_WORDS", 50)
    monkeypatch.setattr(C, "CACHE_PAIRS", 40)
    coder = C.BatchEncoder(vocab)
    sp = sentencepiece.SentencePieceProcessor(model_file=C.MODEL)
    for t in texts(3, 60):
        ids, _ = coder.encode([t])
        if C.MARK not in t:
            assert ids.tolist() == sp.encode(t)
        assert len(coder.fits.known) <= 40 and all(type(k) is int for k in coder.fits.known)
        assert len(coder.index) <= 50 + len(t)
