"""Exact duplicates by two passes over a Bloom filter, in DataFrame functions.

Pass 1 sets, in a filter of bit slots, the slots that the hashes of at least two
rows hit. Pass 2 tests every row against that filter: a row with a slot that no
other row hit has no equal and passes straight through; only the rest (equal
texts and the filter's false positives) are shuffled and grouped by their SHA-256.

Bounds. The filter has 32 bits a row up to ``max_filter_bytes`` and is the only
thing broadcast. Beyond the bound the false positives grow, so more of the small
(id, digest) rows are shuffled; the result is the same at any size. Groups are
aggregated before the shuffle, and rows meet their group in a join of two written
tables, which adaptive execution splits where a group is hot.

Defined cases: a null text counts as empty; a null id comes after every other id;
of rows that agree in id and text exactly one stays; an empty table gives an
empty result; extra columns, whatever their names, are neither read nor needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared as S

MAX_FILTER_BYTES = 64 << 20
SLOTS_PER_ROW = 32
HASHES = 2


def normalised(text: str | Column) -> Column:
    """What equality compares: white space runs as one space, null as empty."""
    return S.collapse_ws(S.text_or_empty(text))


def _slot(digest: Column, k: int, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(k), digest), F.lit(slots)).cast("long")


def repeat_filter(hashed: DataFrame, slots: int, hashes: int = HASHES) -> DataFrame:
    """Pass 1: ``(block, bits)`` with the slots that two or more rows hit.

    Row k-th hashes have a filter each (``k``), so a row's own hashes never
    count as a repeat of one another.
    """
    hit = hashed.select(
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("k"), _slot(F.col("digest"), k, slots).alias("slot")) for k in range(hashes)])
        ).alias("s")
    ).select("s.k", "s.slot")
    twice = hit.groupBy("k", "slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return (
        twice.select("k", S.slot_block(F.col("slot")).alias("block"), S.slot_bit(F.col("slot")).alias("bit"))
        .groupBy("k", "block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def _maybe_repeated(df: DataFrame, digest: Column, bits: DataFrame, slots: int, name: str, hashes: int = HASHES) -> DataFrame:
    """``df`` with a boolean column: every hash of the row hits a repeated slot."""
    tests = []
    for k in range(hashes):
        block, bitmap = S.free_name(df, f"block{k}"), S.free_name(df, f"bits{k}")
        part = bits.filter(F.col("k") == k).select(F.col("block").alias(block), F.col("bits").alias(bitmap))
        slot = _slot(digest, k, slots)
        # at most max_filter_bytes in all, whatever the number of rows
        df = df.join(F.broadcast(part), S.slot_block(slot) == F.col(block), "left")
        tests.append((block, bitmap, S.bit_is_set(F.col(bitmap), S.slot_bit(slot))))
    df = df.withColumn(name, reduce(lambda a, b: a & b, [t[2] for t in tests]))
    return df.drop(*[c for t in tests for c in t[:2]])


def _passes(docs: DataFrame, id_col: str, text_col: str, max_filter_bytes: int):
    """Written digests, the number of slots and pass 1's filter."""
    hashed = S.table(
        docs.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(normalised(text_col).cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "dedup-digests",
    )
    slots = S.filter_slots(hashed.count(), SLOTS_PER_ROW // HASHES, max_filter_bytes * 8 // HASHES)
    return hashed, slots, S.table(repeat_filter(hashed, slots), "dedup-filter")


def _groups(maybe: DataFrame) -> DataFrame:
    """Size and first row (smallest id, null last) of each digest; written."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row")))
    return S.table(maybe.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first")), "dedup-groups")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """One row per document: ``(id, keep_id, group_size, kept, text_sha256)``."""
    hashed, slots, bits = _passes(docs, id_col, text_col, max_filter_bytes)
    tested = _maybe_repeated(hashed, F.col("digest"), bits, slots, "maybe")
    alone = tested.filter(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    maybe = tested.filter("maybe").select("id", "digest", "row")
    groups = _groups(maybe)
    grouped = maybe.join(groups, "digest").select(
        "id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "digest",
    )
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """``docs`` without the rows whose text equals that of a row with a smaller id.

    Rows that no other row can equal never leave their task; of the others only
    ids and digests are shuffled, but for rows that agree in both id and text.
    """
    hashed, slots, bits = _passes(docs, id_col, text_col, max_filter_bytes)
    maybe = _maybe_repeated(hashed, F.col("digest"), bits, slots, "maybe").filter("maybe").select("id", "digest", "row")
    groups = _groups(maybe)
    # (id, digest) pairs of documents to keep that have equals; how many rows share both
    stay = (
        maybe.join(groups.filter("group_size > 1"), "digest")
        .filter(F.col("id").eqNullSafe(F.col("first.id")))
        .groupBy("id", "digest")
        .agg(F.count(F.lit(1)).alias("same"))
    )
    alone_ids = groups.filter("group_size = 1").select(F.col("digest"))
    stay = S.table(stay, "dedup-stay")
    out, dig, test = docs.columns, S.free_name(docs, "digest"), S.free_name(docs, "maybe")
    rows = docs.withColumn(dig, F.unhex(F.sha2(normalised(text_col).cast("binary"), 256)))
    rows = _maybe_repeated(rows, F.col(dig), bits, slots, test)
    straight = rows.filter(~F.col(test)).select(*out)
    rest = rows.filter(F.col(test)).drop(test)
    single = rest.join(alone_ids.withColumnRenamed("digest", dig), dig, "left_semi").select(*out)
    i, same = S.free_name(rest, "keep_id"), S.free_name(rest, "same")
    named = stay.select(F.col("id").alias(i), F.col("digest").alias(dig), F.col("same").alias(same))
    winners = rest.join(named.filter(F.col(same) == 1), (rest[dig] == named[dig]) & rest[id_col].eqNullSafe(named[i]), "left_semi").select(*out)
    many = (
        rest.join(named.filter(F.col(same) > 1), (rest[dig] == named[dig]) & rest[id_col].eqNullSafe(named[i]), "left_semi")
        .dropDuplicates([id_col, dig])
        .select(*out)
    )
    return straight.unionByName(single).unionByName(winners).unionByName(many)
