"""SentencePiece encoding and decoding with a streaming Viterbi search.

The model is a BPE model: a piece's score is the rank of its merge, and its encoding
is what merging best pairs first gives. Merging has two properties that make it a
path search. Every prefix of a text has exactly one last piece, and the encoding up to
that piece is the encoding of the shorter prefix; and pieces in a row are an encoding
exactly if each two neighbours are one of their own joined text. So the search goes
through the text once and gives each position the one piece that fits the last piece
of the position where it begins; whether two pieces fit is found by merging their
text (at most two pieces long) and remembered.

Only positions within the longest piece's length can still be extended; whenever the
backpointer paths from all of them run through one boundary, the ids before it are
final: they are handed out and forgotten, so memory is bounded by the window, not by
the text. Some boundaries are known beforehand: if no piece has the word mark after
another character, all paths meet before every word, so what the search
hands out for a word is remembered, and long texts are read in chunks of words.

The ids are those of the sentencepiece library for the same model, but for a text that
holds the mark U+2581 itself: the library takes it for a space, here it becomes byte
pieces like any character without a piece. Texts follow the model's other conventions: one
mark is put in front, and spaces are marks. Decoding undoes exactly that.

Defined cases: null and empty texts have no ids and decode to the empty text;
repeated rows and extra columns do no harm; an empty table gives an empty result.
Texts are read ``SLICE_CHARS`` at a time, however many rows a batch has and however
long one text is (a chunk ends before a space after another character).

Memory of a Python worker: a slice, ``CACHE_WORDS`` words and ``CACHE_PAIRS`` pairs.
What is remembered lives as long as the broadcast vocabulary: the tasks of one encoding
share it, and a worker drops it with the first task of other work.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared as S

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
SLICE_CHARS = 1 << 19
CACHE_WORDS = 200_000
CACHE_PAIRS = 500_000
#: Longer words are searched again each time instead of being remembered.
CACHED_WORD = 256
#: In place of a piece: the start of the text, a character without a piece.
START, UNKNOWN = -1, -2


class Vocabulary(NamedTuple):
    """What the search needs of a model; bounded by the model's size."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    pieces: list[bytes]
    longest: int


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Reads a SentencePiece BPE model on the driver; tasks get the small result."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, byte_ids, pieces = {}, {}, [-1] * 256, []
    for i in range(sp.vocab_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            pieces.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i):
            pieces.append(b"")
        elif sp.is_unused(i):
            raise ValueError("a model with unused pieces is not supported")
        else:
            piece = piece.replace(MARK, " ")
            ids[piece] = i
            scores[piece] = sp.get_score(i)
            pieces.append(piece.encode())
    if -1 in byte_ids:
        raise ValueError("the model has no byte pieces, so texts could not be decoded exactly")
    return Vocabulary(ids, scores, byte_ids, pieces, max(map(len, ids), default=1))


def to_symbols(text: str, begins: bool = True) -> str:
    """The text as the search sees it, with one space more where it begins. Spaces stand
    for the model's marks: so most words take one byte a character, not two."""
    return " " + text if text and begins else text


def _fallback(vocab: Vocabulary, char: str) -> list[int]:
    return [vocab.byte_ids[b] for b in char.encode("utf-8")]


class Fits:
    """Which pieces may follow which, worked out once a pair.

    Two pieces stay apart if, while they form, no two parts that face each other could
    have been merged before one of them grew. The parts facing right in a piece are the
    piece, the right half of its last merge, the right half of that, and so on; a part
    grows by the merge of the next one. Where merges of better rank come of worse ones,
    the order of growing is not that of ranks, and the joined text is merged instead.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        #: by the two ids in one number, ``before * width + this``
        self.known: dict[int, bool] = {}
        self.width = len(vocab.pieces)
        self.edges: dict[tuple[str, bool], list[tuple[str, float]] | None] = {}
        #: all ends of pieces; those that are pieces with their id
        self.tails = {p[k:]: UNKNOWN for p in vocab.ids for k in range(len(p))} | vocab.ids

    def merged(self, symbols: str, last: list[str] | None = None) -> list[str]:
        """A short text by merging its best pair, the leftmost of equals, until none is
        left; ``last`` takes the two halves of every merge."""
        scores, parts = self.vocab.scores, list(symbols)
        while True:
            found = [(-s, i) for i in range(len(parts) - 1) if (s := scores.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return parts
            at = min(found)[1]
            if last is not None:
                last[:] = parts[at : at + 2]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def edge(self, piece: str, right: bool) -> list[tuple[str, float]] | None:
        """The parts at one edge of a piece, smallest first, each with the score of the
        merge by which it grows (the whole piece never does); None without an order."""
        key = (piece, right)
        if key not in self.edges:
            out, grows, part = [], float("-inf"), piece
            while out is not None:
                out.append((part, grows))
                if len(part) == 1:
                    break
                halves: list[str] = []
                score = self.vocab.scores[part]
                whole = self.merged(part, halves) == [part]
                if not whole or score < grows or any(len(h) > 1 and self.vocab.scores[h] < score for h in halves):
                    out = None
                else:
                    grows, part = score, halves[right]
            self.edges[key] = out and out[::-1]
        return self.edges[key]

    def apart(self, left: str, right: str) -> bool:
        """Whether the joined text of two pieces is merged into just these two."""
        ends, starts = self.edge(left, True), self.edge(right, False)
        if ends is None or starts is None:
            return self.merged(left + right) == [left, right]
        scores, i, j = self.vocab.scores, 0, 0
        while True:
            (a, a_grows), (b, b_grows) = ends[i], starts[j]
            joined = scores.get(a + b)
            # of equal scores the leftmost merge comes first
            if joined is not None and joined > a_grows and joined >= b_grows:
                return False
            if i + 1 == len(ends) and j + 1 == len(starts):
                return True
            if a_grows >= b_grows:
                i += 1
            else:
                j += 1

    def __call__(self, before: int, left: str, this: int, right: str) -> bool:
        key = before * self.width + this
        fits = self.known.get(key)
        if fits is None:
            fits = self.merged(right) == [right] if before < 0 else self.apart(left, right)
            if len(self.known) >= CACHE_PAIRS:
                self.known.clear()
            self.known[key] = fits
        return fits


class StreamingViterbi:
    """The search over a stream of symbols; ``feed`` and ``close`` return final ids."""

    def __init__(self, vocab: Vocabulary, fits: Fits | None = None):
        self.vocab = vocab
        self.fits = fits or Fits(vocab)
        self.chars = ""  # symbols since the last committed boundary
        self.last, self.back = [START], [0]  # the last piece up to each position, its length
        self.piece_before = ""  # the piece that ends at the committed boundary
        self.widest = 0

    def feed(self, symbols: str) -> array:
        out = array("i")
        longest, lo = self.vocab.longest, 0
        while lo < len(symbols):
            # up to the next place where paths are followed back
            size = len(self.chars)
            full = max(2 * longest, (size // longest + 1) * longest)
            part = symbols[lo : lo + full - size]
            self._search(part)
            lo += len(part)
            if len(self.chars) == full:
                out.extend(self._commit(self._meeting(), full))
        return out

    def _search(self, symbols: str) -> None:
        """Gives each new position the piece that fits the one where it begins."""
        begin = len(self.chars)
        self.chars += symbols
        chars, last, back = self.chars, self.last, self.back
        longest, known, tail = self.vocab.longest, self.fits.known.get, self.fits.tails.get
        width = self.fits.width
        for end in range(begin + 1, len(chars) + 1):
            this, length, start = UNKNOWN, 1, end
            furthest = end - longest if end > longest else 0
            while start > furthest:
                start -= 1
                piece = chars[start:end]
                i = tail(piece)
                if i is None:  # no piece ends so
                    break
                if i < 0:
                    continue
                before = last[start]
                fits = known(before * width + i)
                if fits is None:
                    left = chars[start - back[start] : start] if start else self.piece_before
                    fits = self.fits(before, left, i, piece)
                if fits:
                    this, length = i, end - start
                    break
            last.append(this)
            back.append(length)

    def word(self, symbols: str, shared: int) -> list[int]:
        """The ids of a word shorter than two longest pieces whose first ``shared``
        symbols are those of the word before: their positions are kept."""
        self.chars = self.chars[:shared]
        del self.last[shared + 1 :], self.back[shared + 1 :]
        self._search(symbols[shared:])
        return self._path(len(symbols))

    def close(self) -> array:
        return self._commit(len(self.chars), len(self.chars))

    def _meeting(self) -> int:
        """The last boundary on the paths from every position still open."""
        end = len(self.chars)
        open_ = set(range(max(0, end - self.vocab.longest + 1), end + 1))
        while len(open_) > 1:
            latest = max(open_)
            open_.discard(latest)
            open_.add(latest - self.back[latest])
        return open_.pop()

    def _commit(self, upto: int, end: int) -> array:
        self.widest = max(self.widest, end)
        if not upto:
            return array("i")
        ids = array("i", self._path(upto))
        self.piece_before = self.chars[upto - self.back[upto] : upto]
        self.chars, self.last, self.back = self.chars[upto:], self.last[upto:], self.back[upto:]
        self.back[0] = 0
        return ids

    def _path(self, upto: int) -> list[int]:
        """The ids on the path to a position."""
        ids, at, last, back = [], upto, self.last, self.back
        while at > 0:
            if last[at] != UNKNOWN:
                ids.append(last[at])
            else:
                ids += reversed(_fallback(self.vocab, self.chars[at - 1]))
            at -= back[at]
        ids.reverse()
        return ids


def viterbi(vocab: Vocabulary, symbols: str, fits: Fits | None = None) -> array:
    search = StreamingViterbi(vocab, fits)
    return search.feed(symbols) + search.close()


class BatchEncoder:
    """Encodes texts by their words; what the search gives for a word is remembered."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.fits = Fits(vocab)
        multi = [p for p in vocab.ids if len(p) > 1]
        inner = {p[i] for p in multi for i in range(len(p))}
        alone = "".join(c for c in "\n\t\r" if c not in inner)
        # paths meet before a word's space unless a piece holds one after another character
        self.splits = not any(a != " " and b == " " for p in multi for a, b in zip(p, p[1:], strict=False))
        a = re.escape(alone)
        self.word = re.compile(rf"[{a}]| *[^ {a}]+| +" if alone else " *[^ ]+| +")
        self.cut = re.compile("(?<=[^ ]) ")
        self._clear()

    def _clear(self):
        self.index: dict[str, int] = {}
        # the ids of all words in a row; where each word's begin, how many they are
        self.flat, self.starts, self.sizes = array("i"), array("q"), array("q")

    def _learn(self, words: list[str]) -> None:
        """Searches new words in order: a word's search goes on from the prefix that it
        shares with the word before."""
        search, before = StreamingViterbi(self.vocab, self.fits), ""
        for word in sorted(words):
            if len(word) < 2 * self.vocab.longest:
                shared = 0
                for a, b in zip(before, word):  # noqa: B905 (up to the shorter's end)
                    if a != b:
                        break
                    shared += 1
                ids = search.word(word, shared)
                before = word
            else:
                ids = viterbi(self.vocab, word, self.fits)
            self.index[word] = len(self.starts)
            self.starts.append(len(self.flat))
            self.sizes.append(len(ids))
            self.flat.extend(ids)

    def chunks(self, text: str) -> Iterator[tuple[str, bool]]:
        """A text in parts of about ``SLICE_CHARS``, cut where paths are known to meet."""
        lo = 0
        while lo < len(text):
            at = self.cut.search(text, lo + SLICE_CHARS) if self.splits and len(text) - lo > SLICE_CHARS else None
            hi = at.start() if at else len(text)
            yield text[lo:hi], lo == 0
            lo = hi

    def encode(self, texts: list[str], begins: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        symbols = [to_symbols(t, b) for t, b in zip(texts, begins or [True] * len(texts), strict=True)]
        if not self.splits:
            found = [viterbi(self.vocab, x, self.fits) for x in symbols]
            flat = [np.frombuffer(x, dtype=np.int32) for x in found]
            return np.concatenate([np.zeros(0, dtype=np.int32), *flat]), np.array([len(x) for x in found], dtype=np.int64)
        words = [self.word.findall(x) for x in symbols]
        if len(self.index) > CACHE_WORDS:
            self._clear()
        new = {x for part in words for x in part}.difference(self.index)
        if new:
            self._learn(list(new))
        which = np.fromiter((self.index[x] for part in words for x in part), dtype=np.int64)
        per_text = np.array([len(part) for part in words], dtype=np.int64)
        starts, sizes = (np.frombuffer(x, dtype=np.int64)[which] for x in (self.starts, self.sizes))
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        out = np.frombuffer(self.flat, dtype=np.int32)[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]
        upto = np.concatenate([[0], ends])
        bounds = upto[np.concatenate([[0], np.cumsum(per_text)])]
        if any(len(x) > CACHED_WORD for x in new):
            self._clear()
        return out, np.diff(bounds)

    def encode_rows(self, texts: Iterable[str]) -> Iterator[tuple[list[int], np.ndarray, list[bool]]]:
        """The texts' ids, in slices of rows: how many each row has, all ids, exact or not."""
        part, held = [], 0
        for text in texts:
            if part and held + len(text) > SLICE_CHARS:
                yield self._slice(part)
                part, held = [], 0
            part.append(text)
            held += len(text)
        if part:
            yield self._slice(part)

    def _slice(self, texts: list[str]) -> tuple[list[int], np.ndarray, list[bool]]:
        if sum(map(len, texts)) <= SLICE_CHARS:
            groups = [(texts, [True] * len(texts))]
        else:  # one long text
            groups = [([chunk], [first]) for chunk, first in self.chunks(texts[0])]
        sizes, exact, every = [], [], []
        for chunks, begins in groups:
            ids, counts = self.encode(chunks, begins)
            every.append(ids)
            sizes.append(counts)
            ends, listed = np.cumsum(counts).tolist(), ids.tolist()
            for a, b, t, first in zip([0, *ends], ends, chunks, begins, strict=False):
                exact.append(decode(self.vocab, listed[a:b], first) == t)
        if len(groups) > 1:
            return [sum(int(x.sum()) for x in sizes)], np.concatenate(every), [all(exact)]
        return sizes[0].tolist(), every[0], exact


class Shared:
    """What is broadcast: the vocabulary and, in a Python worker, the one encoder made of
    it, in which later tasks find the words of earlier ones. Spark takes the broadcast
    from a worker that goes on to tasks without it, and the encoder goes too."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab

    @cached_property
    def coder(self) -> BatchEncoder:
        return BatchEncoder(self.vocab)


def decode(vocab: Vocabulary, ids, begins: bool = True) -> str:
    """The text of a list of ids: pieces joined, the mark in front taken off where it begins."""
    raw = b"".join([vocab.pieces[i] for i in ids])
    return (raw[1:] if begins and raw[:1] == b" " else raw).decode("utf-8", errors="replace")


def encode_documents(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(id, n_ids, ids, exact)``.

    ``exact`` says that the decoded ids are the text again.
    """
    S.ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Shared(load_vocabulary(model)))
    rows = docs.select(F.col(id_col).alias("id"), S.text_or_empty(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value.coder
        for batch in batches:
            lo = 0
            for counts, ids, exact in coder.encode_rows(x.as_py() for x in batch.column(1)):
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, type=pa.int32()))
                columns = [batch.column(0).slice(lo, len(counts)), pa.array(counts, type=pa.int64()), lists, pa.array(exact)]
                lo += len(counts)
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_ids", "ids", "exact"])

    out = rows.mapInArrow(run, f"id {id_type}, n_ids long, ids array<int>, exact boolean")
    return out.withColumnRenamed("id", id_col)


def decode_documents(coded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` of coded documents; null ids decode to the empty text."""
    S.ship_code(coded.sparkSession)
    vocab = coded.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    rows = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode(vocab.value, ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["id", "text"])

    return rows.mapInArrow(run, f"id {id_type}, text string").withColumnRenamed("id", id_col)
