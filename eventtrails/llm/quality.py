"""Document quality from weak labels: EM over heuristic labellers, then a scorer.

Labellers look at a document and vote good, bad or not at all. How often each is
right is not known; expectation-maximisation estimates it, with the share of good
documents, from the counts of vote patterns over all documents (at most 3 to the
number of labellers, counted by one aggregate, so the fit sees the whole corpus).
The posterior of a document's pattern is its weak label. A linear scorer over
hashed features (byte-class 4-grams, words, votes) is trained on the weak labels of
a bounded sample and scores every document; no human label is read.

Bounds. The training sample is the ``SAMPLE`` distinct texts of smallest hash, or
all where there are fewer, however many copies they have; patterns and weights are
small constants. Texts are read four times (votes, hashes, sample, scores); only
hashes and the sample are shuffled.

Defined cases: null and empty texts have no words, get no votes and are rejected
with the score 0; equal texts get equal scores; null ids are kept; an empty table
gives an empty result; extra columns stay where rows are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared as S

SAMPLE = 4000
#: Rows of the sample that a task describes at once.
DESCRIBED = 256
FEATURES = 4096
KEEP = 0.5
GOOD, BAD, NONE = 0, 1, 2

# Frequent function words of four languages.
FUNCTION_WORDS = (
    "the of and to in is that it for was on with as at by this be from or are an not "
    "der die das und zu den von mit ist im nicht ein eine auf für des dem als auch "
    "le la les de un une et est en du que qui dans pour sur par pas au aux avec "
    "el los las y por con para del se es al lo su como más"
).split()

# Classes of bytes, by the features that count them.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".!?"]] = 5
_CLASS[[ord(c) for c in ",;:'\"()-"]] = 6
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 7
_CLASS[0xC2:0xF5] = 8
_CLASS[0x80:0xC0] = 9

_STOP, _BARE = 1, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hash of a word; the two low bits say function word, no letter or digit."""

    stop = frozenset(w.encode() for w in FUNCTION_WORDS)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        plain = word.strip(b".,;:!?\"'()").lower()
        bare = not any(c >= 0x80 or chr(c).isalnum() for c in word)
        h = xxhash.xxh64_intdigest(word) >> 2 << 2 | (_STOP * (plain in self.stop)) | (_BARE * bare)
        self[word] = h
        return h


class Look(NamedTuple):
    """What labellers see of a document."""

    words: np.ndarray
    classes: np.ndarray
    counts: np.ndarray
    lines: float
    bangs: int


def look(text: bytes, words: _Words) -> Look:
    parts = text.split()
    w = np.fromiter(map(words.__getitem__, parts), dtype=np.uint64, count=len(parts))
    classes = _CLASS[np.frombuffer(text, dtype=np.uint8)]
    lines = [x for x in text.split(b"\n") if x]
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    return Look(w, classes, np.bincount(classes, minlength=10), repeated, text.count(b"!!"))


def _vote(value: float, good_below: float, bad_above: float) -> int:
    return GOOD if value < good_below else BAD if value > bad_above else NONE


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _repeats(d: Look) -> int:
    return _vote(_share(int((d.words[1:] == d.words[:-1]).sum()), len(d.words)), 0.05, 0.2)


def _symbols(d: Look) -> int:
    return _vote(_share(int(d.counts[7]), len(d.classes)), 0.01, 0.05)


def _capitals(d: Look) -> int:
    return _vote(_share(int(d.counts[2]), int(d.counts[1] + d.counts[2])), 0.15, 0.5)


def _bare(d: Look) -> int:
    return _vote(_share(int((d.words & np.uint64(_BARE) != 0).sum()), len(d.words)), 0.03, 0.15)


def _function_words(d: Look) -> int:
    if len(d.words) < 25:
        return NONE
    return _vote(-_share(int((d.words & np.uint64(_STOP) != 0).sum()), len(d.words)), -0.15, -0.03)


def _sentences(d: Look) -> int:
    if len(d.words) < 25:
        return NONE
    return _vote(_share(len(d.words), int(d.counts[5]) or 0.5), 30, 50)


def _exclaims(d: Look) -> int:
    return _vote(_share(d.bangs, len(d.words)), 0.02, 0.1)


def _lines(d: Look) -> int:
    return _vote(d.lines, 0.1, 0.4)


def _pairs(d: Look) -> int:
    """Distinct word pairs among all pairs."""
    if len(d.words) < 10:
        return NONE
    pairs = d.words[:-1] * _MIX + d.words[1:]
    return _vote(-_share(len(np.unique(pairs)), len(pairs)), -0.7, -0.4)


def _runs(d: Look) -> int:
    """The longest run of one word."""
    if len(d.words) < 4:
        return NONE
    ends = np.flatnonzero(np.concatenate([d.words[1:] != d.words[:-1], [True]]))
    return _vote(int(np.diff(np.concatenate([[-1], ends])).max()), 4, 6)


LABELLERS = (_repeats, _pairs, _runs, _symbols, _capitals, _bare, _function_words, _sentences, _exclaims, _lines)


def votes(d: Look) -> list[int]:
    return [f(d) for f in LABELLERS] if len(d.words) else [NONE] * len(LABELLERS)


def pattern(v: list[int]) -> int:
    return int(sum(x * 3**k for k, x in enumerate(v)))


def unpack(p: np.ndarray) -> np.ndarray:
    return (np.asarray(p)[:, None] // 3 ** np.arange(len(LABELLERS))[None, :]) % 3


class LabelModel(NamedTuple):
    """The share of good documents and ``outcome[class, labeller, vote]``.

    A labeller that does not vote says nothing: its columns are for votes only.
    """

    good: float
    outcome: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        v = unpack(patterns)
        k = np.arange(v.shape[1])[None, :]
        ratio = np.concatenate([np.log(self.outcome[0] / self.outcome[1]), np.zeros((v.shape[1], 1))], axis=1)
        odds = np.log(self.good / (1 - self.good)) + ratio[k, v].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """EM for two classes with labellers independent within a class.

    It starts from the belief that bad votes are rare on good documents, which
    names the classes; everything else is estimated. A pseudo-count keeps
    probabilities off 0.
    """
    v, n = unpack(patterns), counts.astype(np.float64)
    one_hot = np.stack([v == GOOD, v == BAD], axis=2).astype(np.float64)
    outcome = np.empty((2, v.shape[1], 2))
    outcome[0], outcome[1] = (0.98, 0.02), (0.6, 0.4)
    model = LabelModel(0.8, outcome)
    for _ in range(rounds):
        p = model.posterior(patterns)
        shares = []
        for weight in (p * n, (1 - p) * n):
            seen = np.einsum("p,plv->lv", weight, one_hot) + 0.5
            shares.append(seen / seen.sum(axis=1, keepdims=True))
        good = float(np.clip((p * n).sum() / n.sum(), 0.01, 0.99))
        moved = max(abs(good - model.good), float(np.abs(np.stack(shares) - model.outcome).max()))
        model = LabelModel(good, np.stack(shares))
        if moved < 1e-6:
            break
    return model


def features(d: Look, v: list[int]) -> np.ndarray:
    """Hashed features, each kind of unit length."""
    out = np.zeros(FEATURES, dtype=np.float32)
    half = FEATURES // 2
    c = d.classes.astype(np.uint64)
    if len(c) >= 4:
        grams = (c[:-3] * 1000 + c[1:-2] * 100 + c[2:-1] * 10 + c[3:]) * _MIX >> np.uint64(53)
        out[:half] = np.sqrt(np.bincount(grams.astype(np.int64), minlength=half)[:half] / len(grams))
    if len(d.words):
        slots = ((d.words >> np.uint64(2)) * _MIX >> np.uint64(53)).astype(np.int64) % (half - 64)
        out[half : FEATURES - 64] = np.sqrt(np.bincount(slots, minlength=half - 64) / len(slots))
    for k, x in enumerate(v):
        if x != NONE:
            out[FEATURES - 64 + 2 * k + x] = 0.5
    return out


def fit_scorer(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes weighing the same (Adam)."""
    weight = np.where(y >= 0.5, 0.5 / max(1, (y >= 0.5).sum()), 0.5 / max(1, (y < 0.5).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    m, s = np.zeros(x.shape[1] + 1, dtype=np.float32), np.zeros(x.shape[1] + 1, dtype=np.float32)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = (p - y).astype(np.float32) * weight
        g = np.concatenate([x.T @ e + decay * w, [e.sum()]]).astype(np.float32)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


class QualityModel(NamedTuple):
    """Both models; without weights the weak label is the score."""

    labels: LabelModel
    weights: np.ndarray | None
    bias: float

    def score(self, text: bytes, words: _Words) -> tuple[float, float]:
        """The weak label and the score of a text."""
        d = look(text, words)
        if not len(d.words):
            return 0.0, 0.0
        v = votes(d)
        weak = float(self.labels.posterior(np.array([pattern(v)]))[0])
        if self.weights is None:
            return weak, weak
        z = float(features(d, v) @ self.weights) + self.bias
        return weak, float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _bytes(texts: pa.Array) -> Iterator[bytes]:
    """One text after the other, not a copy of the whole batch."""
    return (t.as_buffer().to_pybytes() for t in texts)


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> QualityModel | None:
    """Fits both models on a corpus; None if it has no rows."""
    S.ship_code(docs.sparkSession)
    texts = docs.select(S.text_or_empty(text_col).alias("text"))

    def cast_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            seen = Counter(pattern(votes(look(t, words))) for t in _bytes(batch.column(0)))
            columns = [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["pattern", "n"])

    counted = texts.mapInArrow(cast_votes, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = counted.collect()  # at most 3 ** len(LABELLERS) rows
    if not rows:
        return None
    labels = fit_label_model(np.array([r["pattern"] for r in rows]), np.array([r["n"] for r in rows]))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for lo in range(0, batch.num_rows, DESCRIBED):
                patterns, x = [], []
                for t in _bytes(batch.column(0).slice(lo, DESCRIBED)):
                    d = look(t, words)
                    v = votes(d)
                    patterns.append(pattern(v))
                    x.append(features(d, v).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.int64()), pa.array(x, pa.binary())], names=["pattern", "x"])

    # copies of a text count once; they could fill the sample
    least = S.least_hashes(texts, "text", sample)
    chosen = texts.filter(F.xxhash64("text") <= least[-1]).distinct().mapInArrow(describe, "pattern long, x binary").toPandas() if least else []
    if not len(chosen):
        return QualityModel(labels, None, 0.0)
    x = np.stack([np.frombuffer(b, dtype=np.float32) for b in chosen["x"]])
    y = labels.posterior(chosen["pattern"].to_numpy()).astype(np.float32)
    return QualityModel(labels, *fit_scorer(x, y))


def _scored(docs: DataFrame, model: QualityModel | None, text_col: str, names: list[str]) -> DataFrame:
    """``docs`` with the weak label and the score as columns ``names``."""
    S.ship_code(docs.sparkSession)
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<weak:double,score:double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _Words()
        for batch in batches:
            m = shared_model.value
            both = np.array([m.score(t, words) if m else (0.0, 0.0) for t in _bytes(batch)], dtype=np.float64).reshape(-1, 2)
            yield pa.StructArray.from_arrays([pa.array(x) for x in both.T], names=["weak", "score"])

    both = S.free_name(docs, "scored")
    out = docs.withColumn(both, score(S.text_or_empty(text_col)))
    return out.withColumns({names[0]: F.col(both)["weak"], names[1]: F.col(both)["score"]}).drop(both)


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """One row per document: ``(id, weak_label, score, keep)``."""
    model = fit(docs, text_col, sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = _scored(rows, model, "text", ["weak_label", "score"])
    return scored.select(F.col("id").alias(id_col), "weak_label", "score", (F.col("score") >= keep).alias("keep"))


def keep_quality(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """The documents whose score reaches ``keep``, in the same columns."""
    weak, score = S.free_name(docs, "weak_label"), S.free_name(docs, "score")
    scored = _scored(docs, fit(docs, text_col, sample), text_col, [weak, score])
    return scored.filter(F.col(score) >= keep).select(*[F.col(f"`{c}`") for c in docs.columns])
