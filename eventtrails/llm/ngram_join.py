"""N-gram Jaccard self-join with a MinHash LSH forest and exact verification.

Texts become sets of hashed five-word shingles. Texts with equal sets form a
class and are joined once, by their digest; classes are what the rest works on.

Forest. A class's MinHash signature gives a path in each of ``TREES`` tries; in
the tables sorted by path, classes under one node share a prefix. Matching starts
at the full path length and is shortened by one until the recall reaches the
target. The recall is estimated from the pairs found, each weighted by the chance
that its similarity shows at that prefix length; the prefix length that meets the
target even for pairs at the threshold is the last one tried.

Verification. Under a node, members are compared in blocks of at most
``2 * BLOCK`` rows, by vectorised loops inside tasks. A pair belongs to the first
tree in which it meets, so it is verified once. Signatures pick the promising pairs
(a margin of four standard errors below the threshold); only their members fetch
their shingle sets, and the Jaccard similarity of the sets decides. Pairs are
counted and merged where they are found and never become rows: a block returns a
row per member, with its links and the smallest member it is linked with.

Scale. Hot nodes are split into block pairs; copies of a text meet in an aggregate;
texts are shuffled only for classes with promising pairs, found by a broadcast bit
filter of bounded size. Components are found by rounds of joins over written tables.

Defined cases: null and empty texts have no shingles, form one class and have no
other links; a text of one to four words is one shingle; rows with equal texts are
links of each other; null ids are kept, and come last where the smallest id of a
class is taken; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared as S

WORDS = 5
THRESHOLD = 0.8
TREES = 20
PATH = 5
TARGET_RECALL = 0.9999
BLOCK = 512
#: Pairs compared in one vectorised step of a task.
STEP = 1 << 15
FILTER_BYTES = 64 << 20
_WORD_CACHE = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: bytes, hashes: dict, words: int = WORDS) -> np.ndarray:
    """The sorted set of hashed word n-grams of a UTF-8 text."""
    parts = text.split()  # of bytes: exactly the six white space characters
    w = np.fromiter(map(hashes.__getitem__, parts), dtype=np.uint64, count=len(parts))
    if not len(w):
        return w
    n = min(words, len(w))
    h = w[: len(w) - n + 1].copy()
    for k in range(1, n):
        h = h * _P + w[k : len(w) - n + 1 + k]
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return np.unique(h)


def _family(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240901)
    return rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, size, dtype=np.uint64)


def signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits each) of a shingle set."""
    low = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(s), 1024):
        np.minimum(low, (a[:, None] * s[None, lo : lo + 1024] + b[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(">u4")


def _signatures(rows: DataFrame, words: int, size: int) -> DataFrame:
    """``(id, h, digest, n, sig)`` of rows ``(id, h, text)``."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _family(size)
        hashes = _WordHashes()
        for batch in batches:
            texts = batch.column(2)
            digest, count, sig = [], [], []
            for k in range(batch.num_rows):
                s = shingles(texts[k].as_py(), hashes, words)
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                count.append(len(s))
                sig.append(signature(s, a, b).tobytes())
            cols = [batch.column(0), batch.column(1), pa.array(digest, pa.binary()), pa.array(count, pa.int32()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "h", "digest", "n", "sig"])

    return rows.mapInArrow(run, f"id {id_type}, h binary, digest binary, n int, sig binary")


def chance(similarity, depth: int, trees: int = TREES):
    """The probability that a pair shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def last_depth(threshold: float, target: float, trees: int = TREES, path: int = PATH) -> int:
    """The longest prefix that meets the target for pairs at the threshold."""
    return max([d for d in range(1, path + 1) if chance(threshold, d, trees) >= target], default=1)


def _members(reps: DataFrame, depth: int, trees: int, path: int, block: int) -> DataFrame:
    """A row per class and block pair of every shared node at a prefix length.

    ``(tree, prefix, bi, bj, side, digest, n, sig, size)``; rows of one key are
    one block pair, ``side`` telling its blocks apart.
    """
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    paths = reps.filter("n > 0").select("digest", "sig", tree.alias("tree"))
    paths = paths.select("digest", "tree", F.substring("sig", F.col("tree") * (4 * path) + 1, F.lit(4 * depth)).alias("prefix"))
    nodes = paths.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    nodes = S.table(nodes, "forest-nodes")
    shared_ = paths.join(nodes, ["tree", "prefix"])
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("digest"), blocks).cast("int")
    split = shared_.select("tree", "prefix", "digest", own.alias("side"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    split = split.select("tree", "prefix", F.least("side", "other").alias("bi"), F.greatest("side", "other").alias("bj"), "side", "digest")
    return split.join(reps.select("digest", "n", "sig", "size"), "digest")


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole key groups, several at a time: rows and the end row of each row's group.

    Rows come sorted by key; the last group of a batch waits for the next batch.
    """
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        starts = _starts(rows, key)
        cut = int(starts[-1])
        if cut:
            yield rows.slice(0, cut), _ends(starts[:-1], cut)
        rest = rows.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest, _ends(np.array([0]), rest.num_rows)


def _starts(rows: pa.Table, key: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for c in key:
        col = rows.column(c).combine_chunks()
        new[1:] |= np.asarray(pa.compute.not_equal(col.slice(1), col.slice(0, len(col) - 1)))
    return np.flatnonzero(new)


def _ends(starts: np.ndarray, total: int) -> np.ndarray:
    sizes = np.diff(np.concatenate([starts, [total]]))
    return np.repeat(starts + sizes, sizes)


def promising_pairs(rows: pa.Table, ends: np.ndarray, depth: int, trees: int, path: int, threshold: float):
    """Pairs of row numbers that may reach the threshold, with estimated similarity.

    Only pairs whose first common node this is, and of two blocks in a key of two.
    """
    size = trees * path
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype=">u4").astype(np.uint32).reshape(-1, size)
    n = rows.column("n").to_numpy().astype(np.float64)
    tree, side = rows.column("tree").to_numpy(), rows.column("side").to_numpy()
    two = rows.column("bi").to_numpy() != rows.column("bj").to_numpy()
    floor = threshold - 4 * np.sqrt(threshold * (1 - threshold) / size)
    upto = np.cumsum(ends - 1 - np.arange(len(ends)))
    lo = 0
    while lo < len(ends):
        base = int(upto[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, base + STEP, side="right")))
        counts = ends[lo:hi] - 1 - np.arange(lo, hi)
        a = np.repeat(np.arange(lo, hi), counts)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
        ok = np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b])
        ok &= ~two[a] | (side[a] != side[b])
        a, b = a[ok], b[ok]
        same = sig[a] == sig[b]
        alike = same.mean(axis=1)
        ok = alike >= floor
        a, b, alike, same = a[ok], b[ok], alike[ok], same[ok]
        met = same.reshape(-1, trees, path)[:, :, :depth].all(axis=2)
        ok = met.argmax(axis=1) == tree[a]
        yield a[ok], b[ok], alike[ok]
        lo = hi


_KEY = ["tree", "prefix", "bi", "bj"]


def _promising(members: DataFrame, depth: int, trees: int, path: int, threshold: float) -> DataFrame:
    """The members with promising pairs: key and digest, with the number of their
    pairs and the number to expect had every such pair shown at this prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ends in _groups(batches, _KEY):
            pairs, expected = np.zeros(len(ends), dtype=np.int64), np.zeros(len(ends))
            has = np.zeros(len(ends), dtype=bool)
            for a, b, alike in promising_pairs(rows, ends, depth, trees, path, threshold):
                has[a] = has[b] = True
                likely = alike >= threshold
                np.add.at(pairs, a[likely], 1)
                np.add.at(expected, a[likely], 1 / chance(alike[likely], depth, trees))
            kept = rows.select([*_KEY, "side", "digest"]).filter(pa.array(has))
            kept = kept.append_column("pairs", pa.array(pairs[has])).append_column("expected", pa.array(expected[has]))
            yield from kept.to_batches()

    dealt = members.repartition(*_KEY).sortWithinPartitions(*_KEY)
    return dealt.mapInArrow(run, "tree int, prefix binary, bi int, bj int, side int, digest binary, pairs long, expected double")


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sorted sets without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = len(y) - 1
    both = int((y[at] == x).sum())
    return both / (len(x) + len(y) - both)


def _verified(members: DataFrame, depth: int, trees: int, path: int, threshold: float) -> DataFrame:
    """``(digest, root, links)`` per member of a block with verified pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ends in _groups(batches, _KEY):
            sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("shingles").to_pylist()]
            size = rows.column("size").to_numpy()
            digests = rows.column("digest").to_pylist()
            links = np.zeros(len(ends), dtype=np.int64)
            root = list(range(len(ends)))

            def find(k: int) -> int:
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for a, b, _ in promising_pairs(rows, ends, depth, trees, path, threshold):
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    if jaccard(sets[i], sets[j]) >= threshold:
                        links[i] += size[j]
                        links[j] += size[i]
                        x, y = find(i), find(j)
                        if x != y:
                            x, y = (x, y) if digests[x] < digests[y] else (y, x)
                            root[y] = x
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digests[k] for k in at], pa.binary()), pa.array([digests[find(k)] for k in at], pa.binary()), pa.array(links[at])],
                names=["digest", "root", "links"],
            )

    dealt = members.repartition(*_KEY).sortWithinPartitions(*_KEY)
    return dealt.mapInArrow(run, "digest binary, root binary, links long")


def _shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """``(digest, shingles)`` of rows ``(h, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingles(t.as_py(), hashes, words).tobytes() for t in batch.column(1)]
            keys = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["digest", "shingles"])

    return texts.mapInArrow(run, "digest binary, shingles binary")


def _only(texts: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """The rows of ``texts`` (``h``, ``text``) whose ``h`` is wanted, each ``h`` once.

    A bit filter, bounded in size and broadcast, lets few other texts through;
    those few and the wanted ones are shuffled by ``h``.
    """
    slots = S.filter_slots(rows, 16, FILTER_BYTES * 8)
    slot = F.pmod(F.xxhash64("h"), F.lit(slots)).cast("long")
    bits = wanted.select(S.slot_block(slot).alias("block"), S.slot_bit(slot).alias("bit")).distinct()
    bits = S.table(bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")), "forest-filter")
    some = texts.join(F.broadcast(bits), S.slot_block(slot) == F.col("block")).filter(S.bit_is_set(F.col("bits"), S.slot_bit(slot)))
    # copies merge within their task first
    return some.select("h", "text").groupBy("h").agg(F.first("text").alias("text")).join(wanted, "h", "left_semi")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` of the connected components of edges ``(a, b)``.

    Rounds of hooking to the smallest neighbouring label and pointer jumping;
    every round is written, so a lost executor costs part of one round.
    """
    both = S.table(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).distinct(), f"{label}-edges")
    labels = S.table(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), f"{label}-0")
    k = 0
    while True:
        k += 1
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        near = S.table(labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("near")), f"{label}-near-{k}")
        hooks = near.filter("near < root").groupBy(F.col("root").alias("hooked")).agg(F.min("near").alias("to"))
        hooked = near.join(hooks, F.col("node") == F.col("hooked"), "left")
        hooked = S.table(hooked.select("node", "root", F.least(F.col("near"), F.coalesce("to", "near")).alias("new")), f"{label}-hook-{k}")
        up = hooked.select(F.col("node").alias("parent"), F.col("new").alias("grand"))
        jumped = hooked.join(up, F.col("new") == F.col("parent"), "left").select("node", F.least(F.col("new"), F.coalesce("grand", "new")).alias("root"), F.col("root").alias("old"))
        jumped = S.table(jumped, f"{label}-{k}")
        labels = jumped.select("node", "root")
        if jumped.filter("root <> old").isEmpty():
            return labels


def _linked(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    path: int = PATH,
    target: float = TARGET_RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """The join's rows, with the text's hash ``h`` and whether the row ``stays``."""
    S.ship_code(docs.sparkSession)
    text = S.text_or_empty(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("h"), text.alias("text"))
    signed = S.table(_signatures(rows, words, trees * path), "forest-signed")
    reps = S.table(
        signed.groupBy("digest").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("h"))).alias("first"),
            F.count(F.lit(1)).alias("size"),
            F.first("n").alias("n"),
            F.first("sig").alias("sig"),
            F.min("h").alias("h"),
        ),
        "forest-classes",
    )
    depth, last = path, last_depth(threshold, target, trees, path)
    while True:
        members = _members(reps, depth, trees, path, block)
        found = S.table(_promising(members, depth, trees, path, threshold), "forest-promising")
        pairs, expected = found.agg(F.sum("pairs"), F.sum("expected")).first()
        if depth <= last or not pairs or pairs / expected >= target:
            break
        depth -= 1
    wanted = S.table(found.select("digest").distinct().join(reps, "digest").select("h", "digest"), "forest-wanted")
    texts = _only(rows.select("h", "text"), wanted.select("h"), wanted.count())
    sets = S.table(_shingle_sets(texts, words), "forest-sets")
    blocks = found.select(*_KEY, "side", "digest").join(reps.select("digest", "n", "sig", "size"), "digest").join(sets, "digest")
    verified = S.table(_verified(blocks, depth, trees, path, threshold), "forest-verified")
    roots = components(verified.select(F.col("digest").alias("a"), F.col("root").alias("b")), "forest-components")
    links = verified.groupBy("digest").agg(F.sum("links").alias("links"))
    classes = (
        reps.select("digest", "first", "size")
        .join(links, "digest", "left")
        .join(roots.withColumnRenamed("node", "digest"), "digest", "left")
        .withColumn("root", F.coalesce("root", "digest"))
    )
    classes = S.table(classes, "forest-linked")
    least = classes.groupBy("root").agg(F.min("first").alias("least"))
    classes = S.table(classes.join(least, "root").drop("root"), "forest-labelled")
    return signed.select("id", "h", "digest").join(classes, "digest").select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("copy_of"),
        F.col("least.id").alias("class_id"),
        (F.coalesce(F.col("links"), F.lit(0)) + F.col("size") - 1).cast("long").alias("n_links"),
        "h",
        (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("h") == F.col("least.h"))).alias("stays"),
    )


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``(id, copy_of, class_id, n_links)``.

    ``copy_of`` is the smallest id with the same set of shingles, ``class_id`` the
    smallest id of the connected documents, ``n_links`` the number of other
    documents whose Jaccard similarity reaches the threshold, copies included.
    Options: ``words``, ``threshold``, ``trees``, ``path`` (hashes a tree),
    ``target`` (recall) and ``block`` (rows of a block).
    """
    return _linked(docs, id_col, text_col, **options).select(id_col, "copy_of", "class_id", "n_links")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of linked documents: the one with
    the smallest id, then text hash. Documents without words are a group; rows
    that agree in id and text are one document.

    A broadcast bit filter, bounded in size, tells rows that surely stay; the
    others are checked against the dropped ids by a join.
    """
    gone = _linked(docs, id_col, text_col, **options).filter("not stays").select(F.col(id_col).alias("gone"), F.col("h").alias("gone_h")).distinct()
    gone = S.table(gone, "forest-gone")
    h, block, bits = (S.free_name(docs, c) for c in ("text_hash", "filter_block", "filter_bits"))
    slots = S.filter_slots(gone.count(), 16, FILTER_BYTES * 8)

    def slot(c: str):
        return F.pmod(F.xxhash64(F.col(c)), F.lit(slots)).cast("long")

    maps = gone.select(S.slot_block(slot("gone_h")).alias(block), S.slot_bit(slot("gone_h")).alias("bit")).distinct()
    maps = S.table(maps.groupBy(block).agg(F.bitmap_construct_agg("bit").alias(bits)), "forest-gone-filter")
    rows = docs.withColumn(h, F.unhex(F.md5(S.text_or_empty(text_col).cast("binary"))))
    rows = rows.join(F.broadcast(maps), S.slot_block(slot(h)) == F.col(block), "left")
    hit = S.bit_is_set(F.col(bits), S.slot_bit(slot(h)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    surely = rows.filter(~hit).select(*columns)
    maybe = rows.filter(hit)
    checked = maybe.join(gone, maybe[id_col].eqNullSafe(gone["gone"]) & (maybe[h] == gone["gone_h"]), "left_anti")
    return surely.unionByName(checked.select(*columns))
