"""Document fingerprints: one-permutation MinHash, in DataFrame functions.

Every five-word shingle is hashed once. The top bits of a hash choose one of
``BINS`` bins, which keeps its smallest hash. An empty bin copies the bin that its
own fixed random order of bins meets first among the filled ones (optimal
densification), so two texts whose filled bins agree copy alike. Of each bin the low
``BITS`` bits are stored, one hexadecimal digit a bin; bins that agree by chance,
one in ``2**BITS``, are corrected for in :func:`likeness`.

:func:`edited_report` compares each text with a copy of it whose last quarter is
replaced by the start of the next document, and with that next document. Only ids
and digests are sorted; a text is shuffled once by its key, and the part of it that
replaces another's end once more, with its fingerprint, which goes to its own document
too: each text's fingerprint is worked out once.

Defined cases: null text is empty. Words are runs of other than ASCII white space,
case kept; one to four words are one shingle; without words the fingerprint is the
empty string, whose likeness is 1 to itself and 0 to any other. Documents are in
order of id (null last), then of the text's SHA-256; rows that agree in both are one
document, and each of them gets its result. The only document is its own next.
Texts of any length are read whole. An empty table gives an empty result. Extra
columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared as S

WORDS = 5
BIN_BITS = 9
BINS = 1 << BIN_BITS
BITS = 4
#: Places of an empty bin's order that are tried one by one; the rest of the order
#: is by hashes of the filled bins themselves.
TRIES = 32


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """64-bit hashes of the shingles of a text, in their order."""
    hashes = F.transform(F.filter(F.split(text, S.WS, -1), lambda w: w != ""), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        whole = F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (words - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, words)]),
        )
        return F.when(F.size(h) >= words, whole).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(whole)

    return _let(hashes, shingles)


def _bin(h: Column) -> Column:
    """The bin of a hash, ascending with the hash."""
    return F.shiftright(h, 64 - BIN_BITS).cast("int") + (BINS // 2)


def bin_minima(hashes: Column) -> Column:
    """The smallest hash of each filled bin, by bin."""
    return _let(F.sort_array(hashes), lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))


def _dense(minima: Column) -> Column:
    """All bins in order, null where empty."""

    def gap(m: Column, i: Column) -> Column:
        return _bin(F.get(m, i)) - F.when(i == 0, 0).otherwise(_bin(F.get(m, i - 1)) + 1)

    null = F.lit(None).cast("long")
    last = F.element_at(minima, -1)
    filled = F.flatten(F.transform(minima, lambda x, i: F.concat(F.array_repeat(null, gap(minima, i)), F.array(x))))
    return F.concat(filled, F.array_repeat(null, BINS - 1 - _bin(last)))


def _densified(minima: Column) -> Column:
    """All bins in order; an empty one copies the first filled one of its order."""

    def nth(dense: Column, b: Column, n: int) -> Column:
        return F.get(dense, F.pmod(F.xxhash64(b, F.lit(n)), F.lit(BINS)).cast("int"))

    def by_hash(b: Column) -> Column:
        ranked = F.transform(minima, lambda x: F.struct(F.xxhash64(b, _bin(x), F.lit(-1)).alias("order"), x.alias("value")))
        return F.array_min(ranked)["value"]

    return _let(_dense(minima), lambda d: F.transform(d, lambda x, b: F.coalesce(x, *[nth(d, b, n) for n in range(TRIES)], by_hash(b))))


def fingerprint(text: str | Column) -> Column:
    """The packed fingerprint of a text: ``BINS`` hexadecimal digits, or empty."""
    low = lambda x: F.substring(F.lit("0123456789abcdef"), x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int") + 1, F.lit(1))
    packed = lambda m: F.when(F.size(m) == 0, F.lit("")).otherwise(F.array_join(F.transform(_densified(m), low), ""))
    return _let(bin_minima(shingle_hashes(S.text_or_empty(text))), packed)


def likeness(a: str | Column, b: str | Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two fingerprints,
    0 to 1, corrected for bins whose low bits agree by chance."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y)
    share = F.size(F.filter(same, lambda x: x)) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    known = F.greatest(F.lit(0.0), (share - chance) / (1.0 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(known)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(id, fingerprint)``."""
    return docs.select(F.col(id_col), fingerprint(text_col).alias("fingerprint"))


def following(rows: DataFrame, keys: list[Column], what: list[str], name: str) -> DataFrame:
    """``rows`` (distinct by ``keys``) with a struct of the next row's ``what``.

    After the last row comes the first. Rows are dealt by ranges of the keys; each
    range finds its own followers, and its last row gets the first of the next
    range. The driver sees only the numbers of the ranges that have rows.
    """
    part, seq = S.free_name(rows, "part"), S.free_name(rows, "seq")
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = S.table(dealt.select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(seq)), "following-sorted")
    firsts = S.table(dealt.groupBy(part).agg(F.min_by(F.struct(*what), seq).alias(name)), "following-firsts")
    parts = sorted(r[part] for r in firsts.select(part).collect())
    after = dict(zip(parts, parts[1:] + parts[:1]))
    steps = rows.sparkSession.createDataFrame(list(after.items()) or [(0, 0)], f"{part} int, step int")
    heads = steps.join(firsts.withColumnRenamed(part, "step"), "step").select(part, F.col(name).alias("head"))
    ahead = dealt.withColumn(name, F.lead(F.struct(*what)).over(Window.partitionBy(part).orderBy(seq)))
    # one row a range: as many as there are partitions
    return ahead.join(F.broadcast(heads), part).withColumn(name, F.coalesce(name, "head")).drop(part, seq, "head")


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and the next document.

    ``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``. The edited text has the last ``floor(n_chars / 4)`` code points
    replaced by as many of the start of the next document, or by all of it.
    """
    texts = docs.select(F.col(id_col).alias("id"), S.text_or_empty(text_col).alias("text"))
    texts = texts.select("id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "text")
    keys = S.table(texts.select("id", "digest", F.length("text").cast("long").alias("n_chars")).distinct(), "fingerprint-keys")
    order = [F.col("id").asc_nulls_last(), F.col("digest").asc()]
    links = following(keys, order, ["id", "digest"], "next")
    n_new = F.floor(F.col("n_chars") / 4).cast("int").alias("n_new")
    links = S.table(
        links.select(F.struct("id", "digest").alias("of"), n_new, F.col("next.id").alias("id"), F.col("next.digest").alias("digest")),
        "fingerprint-links",
    )

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        on = (left["digest"] == right["digest"]) & left["id"].eqNullSafe(right["id"])
        return left.join(right, on).drop(right["id"]).drop(right["digest"])

    # every document is the next one of just one; repeated rows bring the same start.
    # A text's print is worked out here once, for the document before it and for its own
    given = met(texts, links).withColumn("print", F.unhex(fingerprint("text")))
    no_start, no_print = F.lit(None).cast("string"), F.lit(None).cast("binary")
    ahead = F.struct(
        *("of.id", "of.digest", "n_new"),
        F.substring("text", F.lit(1), F.col("n_new")).alias("start"),
        F.col("print").alias("next_print"),
        no_print.alias("own_print"),
    )
    own = F.struct(
        *("id", "digest"),
        F.lit(None).cast("int").alias("n_new"),
        no_start.alias("start"),
        no_print.alias("next_print"),
        F.col("print").alias("own_print"),
    )
    given = given.select(F.inline(F.array(ahead, own)))
    given = given.groupBy("id", "digest").agg(*[F.max(c).alias(c) for c in ("n_new", "start", "next_print", "own_print")])
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("n_new"))
    edited = met(texts, given).withColumn("edited", F.concat(kept, F.col("start")))
    edited = edited.select(
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.lower(F.hex("own_print")).alias("fingerprint"),
        fingerprint("edited").alias("edited_fingerprint"),
        F.lower(F.hex("next_print")).alias("next_fingerprint"),
    )
    return edited.select(
        F.col("id").alias(id_col),
        *("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
