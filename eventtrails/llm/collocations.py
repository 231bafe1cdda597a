"""Phrase collocations by a vertically partitioned suffix tree.

A text becomes the suffixes of its pieces, cut off after ``LONGEST`` words: the tree
never gets deeper. It is built in the manner of ERA, prefix by prefix. First words,
then pairs of words are counted; a suffix is cut before the first word that does not
follow the one before it often enough, since no node below can be counted ``LEAST``
times. Equal suffixes are merged where they are read, with their number: they are
the leaves. Word prefixes with more leaves than the memory budget are extended by a
word, level by level; the others are packed into groups within the budget, and each
group's subtree is built by one task on its own from its sorted leaves. A node's count
is the sum of its leaves' totals. Prefixes that were extended are counted from them.

Words are 64-bit hashes of language and word in all of that. Every word of the corpus
is in the vocabulary table, where a repeated hash would show; then another seed is
taken, so counts are exact. What decides which words and pairs are frequent is a bit
filter of at most ``MAX_FILTER_BYTES`` of frequent hashes; more of them only let more
suffixes through, which counting removes.

Defined cases: null text is empty, null language is ``und``; repeated rows count each
time; texts of any length are read whole, in slices of words; an empty table gives an
empty result; extra columns are not read. Equal scores go by count, then phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared as S

# What ends a piece, and what stands between words.
PIECE_END = r"[.,;:!?\x0A-\x0D]"
BETWEEN = r"[\x20\x09]+"

LONGEST = 5
LEAST = 100
TOP = 2000
#: Leaves of one group's subtree, at most twice as many (a leaf takes some 100 bytes).
GROUP_LEAVES = 1 << 19
MAX_FILTER_BYTES = 32 << 20
#: Code points that are cut into words at a time; one text is never divided.
SLICE_CHARS = 1 << 22

_PARTS = [f"w{k}" for k in range(1, LONGEST + 1)]
_MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _hashed(strings: pa.Array, seed: int) -> np.ndarray:
    values = strings.to_numpy(zero_copy_only=False)
    return pd.util.hash_array(values, hash_key=f"collocations{seed:04d}", categorize=False) if len(values) else np.zeros(0, np.uint64)


class _Words:
    """The words of some texts: ``lang`` and ``word`` as codes, ``h`` the hash of both,
    ``follows`` whether the next word is of the same piece."""

    def __init__(self, lang: pa.Array, text: pa.Array, seed: int):
        pieces = pc.split_pattern_regex(pc.ascii_lower(text), PIECE_END)
        doc = pc.list_parent_indices(pieces).to_numpy()
        words = pc.split_pattern_regex(pieces.flatten(), BETWEEN)
        piece = pc.list_parent_indices(words).to_numpy()
        words = words.flatten()
        real = pc.not_equal(words, "")
        piece, words = piece[real.to_numpy(zero_copy_only=False)], words.filter(real).dictionary_encode()
        self.word = words.indices.to_numpy().astype(np.int64)
        self.words = words.dictionary
        langs = lang.dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy()[doc[piece]].astype(np.int64) if len(piece) else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            self.h = _mixed(_hashed(self.words, seed)[self.word] + _MIX1 * _hashed(self.langs, seed)[self.lang])
        self.follows = np.zeros(len(piece), bool)
        self.follows[:-1] = piece[1:] == piece[:-1]


def _slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[_Words]:
    """Words of the documents, some ``SLICE_CHARS`` code points at a time."""
    for batch in batches:
        sizes = pc.cumulative_sum(pc.binary_length(batch.column("text")).cast(pa.int64())).to_numpy()
        at = 0
        while at < batch.num_rows:
            base = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, base + SLICE_CHARS, side="right")))
            part = batch.slice(at, to - at)
            yield _Words(part.column("lang"), part.column("text"), seed)
            at = to


def _count_words(seed: int):
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("h", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _slices(batches, seed):
            both = w.lang * max(1, len(w.words)) + w.word
            _, first, n = np.unique(both, return_index=True, return_counts=True)
            columns = [w.langs.take(pa.array(w.lang[first])), w.words.take(pa.array(w.word[first]))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(w.h[first].view(np.int64)), pa.array(n)], schema=schema)

    return count


def _pairs(h: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words; one for each but the last word."""
    with np.errstate(over="ignore"):
        return _mixed(h[:-1] * _MIX1 + h[1:])


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether a bit filter has the hashes."""
    slot = h & np.uint64(len(bits) * 8 - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _count_pairs(seed: int, words):
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _slices(batches, seed):
            often = _passes(words.value, w.h)
            both = often[:-1] & often[1:] & w.follows[:-1]
            h, n = np.unique(_pairs(w.h)[both], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], schema=schema)

    return count


def _leaf_suffixes(seed: int, words, pairs):
    schema = pa.schema([("lang", pa.string()), *[(c, pa.int64()) for c in _PARTS], ("n", pa.int64())])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _slices(batches, seed):
            size = len(w.h)
            often = _passes(words.value, w.h)
            joins = np.zeros(size, bool)
            joins[:-1] = w.follows[:-1] & often[:-1] & often[1:] & _passes(pairs.value, _pairs(w.h))
            # a suffix of one word alone has nothing to add to the vocabulary
            start = np.flatnonzero(joins)
            suffix = np.zeros((len(start), LONGEST), np.uint64)
            alive = np.ones(len(start), bool)
            for k in range(LONGEST):
                at = np.minimum(start + k, size - 1)
                suffix[alive, k] = w.h[at[alive]]
                alive &= (start + k < size) & joins[at]
            order = np.lexsort(suffix.T[::-1])
            suffix, start = suffix[order], start[order]
            new = np.ones(len(order), bool)
            new[1:] = (suffix[1:] != suffix[:-1]).any(axis=1)
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(order)))
            columns = [pa.array(np.ascontiguousarray(suffix[first, k]).view(np.int64)) for k in range(LONGEST)]
            yield pa.RecordBatch.from_arrays([w.langs.take(pa.array(w.lang[start[first]])), *columns, pa.array(n)], schema=schema)

    return leaves


def _bit_filter(spark: SparkSession, hashes: DataFrame, max_bytes: int):
    """A broadcast bit filter of the hashes ``h`` of a written table, ``max_bytes`` at most."""
    slots = S.filter_slots(hashes.count(), 16, max_bytes * 8)
    slot = F.col("h").bitwiseAND(F.lit(slots - 1))
    blocks = (
        hashes.select(S.slot_block(slot).alias("block"), S.slot_bit(slot).alias("bit"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bits = np.zeros(slots // 8, np.uint8)
    width = S.BLOCK_SLOTS // 8
    for r in blocks.toLocalIterator():  # no more than max_bytes
        bits[r["block"] * width : (r["block"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return spark.sparkContext.broadcast(bits)


def vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """Every word with its count, ``(lang, word, h, n)``, and the seed of the hashes;
    written. No two words of the table have the same hash."""
    for seed in range(100):
        counted = texts.mapInArrow(_count_words(seed), "lang string, word string, h long, n long")
        words = S.table(counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("n")), "phrase-words")
        # 0 stands for the end of a suffix
        if words.groupBy("h").count().filter("count > 1 or h = 0").isEmpty():
            return words, seed
    raise RuntimeError("no seed without equal hashes")


def _subtree(depth: int, least: int):
    """A group's nodes below its prefixes of ``depth`` words."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(_PARTS, kind="stable")
        words, n = group[_PARTS].to_numpy(), group["n"].to_numpy()
        upto = np.concatenate([[0], np.cumsum(n)])
        lang = group["lang"].to_numpy()
        new, langs, phrases, totals = np.zeros(len(n), bool), [], [], []
        new[:1] = True
        for d in range(1, LONGEST + 1):
            new[1:] |= words[1:, d - 1] != words[:-1, d - 1]
            if d < max(depth, 2):
                continue
            first = np.flatnonzero(new)
            total = upto[np.append(first[1:], len(n))] - upto[first]
            often = (total >= least) & (words[first, d - 1] != 0)
            langs.extend(lang[first[often]])
            phrases.extend(words[first[often], :d])
            totals.extend(total[often])
        return pd.DataFrame({"lang": pd.Series(langs, dtype=object), "phrase": pd.Series(phrases, dtype=object), "f": np.array(totals, np.int64)})

    return build


def subtree_counts(leaves: DataFrame, least: int = LEAST, group_leaves: int = GROUP_LEAVES) -> DataFrame:
    """``(lang, phrase, f)``: the nodes of two words and more counted ``least`` times.

    ``phrase`` is an array of word hashes.
    """
    nodes, rest = [], leaves
    for depth in range(1, LONGEST + 1):
        prefix = _PARTS[:depth]
        sizes = rest.groupBy("lang", *prefix).agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("f"))
        sizes = S.table(sizes, f"phrase-prefixes-{depth}")
        large = F.col("size") > group_leaves
        if depth == LONGEST:  # a whole suffix is a single leaf
            large = F.lit(False)
        # prefixes packed in order of their hashes, within buckets of some 64 groups
        small = sizes.filter(~large)
        total = small.agg(F.sum("size")).first()[0] or 0
        buckets = 1 + total // (64 * group_leaves)
        bucket = F.pmod(F.xxhash64(*prefix), F.lit(buckets)).alias("bucket")
        upto = F.sum("size").over(Window.partitionBy("bucket").orderBy(*prefix, "lang").rowsBetween(Window.unboundedPreceding, 0))
        packed = small.select("lang", *prefix, "size", bucket).withColumn("pack", F.floor((upto - 1) / group_leaves))
        packed = S.table(packed.select("lang", *prefix, "bucket", "pack"), f"phrase-groups-{depth}")
        grouped = rest.join(packed, ["lang", *prefix]).groupBy("bucket", "pack")
        nodes.append(grouped.applyInPandas(_subtree(depth, least), "lang string, phrase array<long>, f long"))
        over = sizes.filter(large)
        if over.isEmpty():
            break
        if depth > 1:
            nodes.append(over.filter(F.col("f") >= least).filter(F.col(prefix[-1]) != 0).select("lang", F.array(*prefix).alias("phrase"), "f"))
        over = over.select("lang", *prefix)
        rest = S.table(rest.join(over, ["lang", *prefix], "left_semi"), f"phrase-rest-{depth}")
    out = nodes[0]
    for x in nodes[1:]:
        out = out.unionByName(x)
    return out


def _whole(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def phrase_counts(docs: DataFrame, text_col="text", lang_col="lang", least: int = LEAST, **limits) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of one to ``LONGEST`` words that occur ``least`` times,
    ``(lang, phrase, f)`` with hashes as words, and the vocabulary; both written."""
    spark = docs.sparkSession
    S.ship_code(spark)
    texts = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), S.text_or_empty(text_col).alias("text"))
    words, seed = vocabulary(texts)
    max_bytes = limits.get("max_filter_bytes", MAX_FILTER_BYTES)
    often = words.filter(F.col("n") >= least)
    word_filter = _bit_filter(spark, often.select("h"), max_bytes)
    pairs = texts.mapInArrow(_count_pairs(seed, word_filter), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    pairs = S.table(pairs.filter(F.col("n") >= least).select("h"), "phrase-pairs")
    pair_filter = _bit_filter(spark, pairs, max_bytes)
    schema = f"lang string, {', '.join(f'{c} long' for c in _PARTS)}, n long"
    leaves = texts.mapInArrow(_leaf_suffixes(seed, word_filter, pair_filter), schema)
    leaves = S.table(leaves.groupBy("lang", *_PARTS).agg(F.sum("n").alias("n")), "phrase-leaves")
    nodes = subtree_counts(leaves, least, limits.get("group_leaves", GROUP_LEAVES))
    single = often.select("lang", F.array("h").alias("phrase"), F.col("n").alias("f"))
    return S.table(nodes.unionByName(single), "phrase-counts"), words


def collocations(docs: DataFrame, text_col="text", lang_col="lang", least: int = LEAST, top: int = TOP, **limits) -> DataFrame:
    """Each language's ``top`` phrases: ``(lang, rank, phrase, a, l, r, n, score)``."""
    counts, words = phrase_counts(docs, text_col, lang_col, least, **limits)
    phrases = counts.filter(F.size("phrase") > 1)
    # a longer phrase as frequent as this one: then so is one that is longer by a word
    size = F.size("phrase")
    inside = phrases.filter(size > 2).select(
        "lang", "f", F.explode(F.array(F.slice("phrase", F.lit(1), size - 1), F.slice("phrase", F.lit(2), size - 1))).alias("phrase")
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = phrases.join(inside, ["lang", "phrase"], "left").filter("longer is null or longer < f").drop("longer")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("phrase", F.lit(1), F.col("k"))).withColumn("right", F.slice("phrase", F.col("k") + 1, size - F.col("k")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = cuts.join(F.broadcast(totals), "lang") if totals.count() < 10_000 else cuts.join(totals, "lang")
    score = F.expr("(1000 * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "n", "cut.*")
    by = [F.col("score").desc(), F.col("a").desc()]
    # ties at the end stay until the phrases can be read
    near = scored.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= top)
    near = S.table(near.drop("rank"), "phrase-near")
    spelt = near.select("lang", F.col("phrase").alias("hashes"), F.posexplode("phrase").alias("i", "h"))
    spelt = spelt.join(words.select("lang", "h", "word"), ["lang", "h"]).groupBy("lang", "hashes")
    spelt = spelt.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("spelt"))
    named = near.withColumnRenamed("phrase", "hashes").join(spelt, ["lang", "hashes"]).withColumnRenamed("spelt", "phrase")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by, F.col("phrase").asc()))
    out = named.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
