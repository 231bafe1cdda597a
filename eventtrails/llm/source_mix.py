"""Mixing sources to target weights by capped water-filling.

Targets. A budget of words is shared among the sources by weight. A source whose
share is above ``max_epochs`` times its size is clamped there and the excess is
reshared among the others by weight, round by round, until none is above. A round
is one small aggregate over the table of sources.

Rows. A source's target over its size is its number of epochs: every document is
taken the whole number of times, and a seeded sample is taken once more to make
up the fraction. The sample is the documents with the smallest seeded hashes
whose sizes fit; the document at the boundary gives the last words as a
fractional repetition, so a source's words meet its target to the word.
The boundary is found by counts: a histogram of the hashes' next digit per source
picks the digit, level by level, and only the rows of the last bucket are ordered.
No source is sorted or gathered whole, whatever its share of the rows.

Defined cases: null text has no words and is never taken; a null source is a
source of its own, last in order; rows that agree in source, id and size share
their part of a fraction evenly; sources without words have the target 0; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared as S

#: A sample's hashes have this many bits and are searched digit by digit; after the
#: last level a source of 10^10 rows orders some 600 of them.
HASH_BITS, DIGIT_BITS, LEVELS = 60, 8, 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(S.WORD)).cast("long")


def seeded_hash(seed: int, id_: Column, size: Column) -> Column:
    """60 bits of MD5 over seed, id and size, the same in any engine."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("null")), size.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = 3, share: float = 1.0) -> DataFrame:
    """``(source, weight, source_size)`` with ``target``: see the module's text."""
    state = sources.withColumn("cap", (F.col("source_size") * max_epochs).cast("decimal(38,0)"))
    state = state.withColumn("capped", F.col("source_size") == 0)
    total = state.agg(F.sum("source_size")).first()[0] or 0
    budget = total if share == 1.0 else int(round(total * share))
    capped = F.col("capped")
    while True:
        # one row of sums a round; every round clamps at least one source
        free, held = state.agg(F.sum(F.when(~capped, F.col("weight"))), F.sum(F.when(capped, F.col("cap")))).first()
        left = max(0, budget - int(held or 0))
        if not free:
            break
        over = ~capped & (F.col("weight").cast("decimal(18,0)") * F.lit(left).cast("decimal(20,0)") > F.col("cap") * F.lit(int(free)))
        if state.filter(over).isEmpty():
            break
        state = S.table(state.withColumn("capped", capped | over), "mix-clamped")
    level = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(free or 1))
    return state.withColumn("target", F.when(capped, F.col("cap").cast("double")).otherwise(level)).drop("capped", "cap")


def default_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, over the sources by code point, null last.

    One small row per source is ordered, never documents.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("long"))


def _plan(docs: DataFrame, weights, max_epochs, share, seed, id_col, text_col, source_col, levels):
    """The written sizes, plan per source and boundary rows of a mix.

    The plan has a row per source: whole repetitions, and the hash bucket in
    which the extra repetition ends. The boundary rows are those of that bucket
    that still get words.
    """
    sized = S.table(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(S.text_or_empty(text_col)).alias("size"),
        ).withColumn("u", seeded_hash(seed, F.col("id"), F.col("size"))),
        "mix-sizes",
    )
    sources = S.table(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = water_fill(S.table(weights(sources), "mix-weights"), max_epochs, share)
    size = F.col("source_size")
    targets = S.table(
        targets.withColumn("whole", F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(max_epochs))).otherwise(0).cast("long"))
        .withColumn("rest", F.round(F.col("target") - F.col("whole") * size).cast("long"))
        .select("source", "source_size", "target", "whole", "rest"),
        "mix-targets",
    )
    # digit by digit down to the hash bucket in which the words run out
    plan = targets.withColumnsRenamed({"source": "p"}).withColumn("edge", F.lit(0).cast("long")).withColumn("left", F.col("rest"))
    for level in range(levels):
        plan = S.table(_descend(sized, plan, level), f"mix-plan-{level}")
    # rows that agree in all of source, id and size are one row here, with a count
    same = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("p")))
        .filter(_bucket(F.col("u"), levels) == F.col("edge"))
        .groupBy("source", "u", "id", "size", "left")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    before = W.partitionBy("source").orderBy("u", F.col("id").isNull(), "id", "size").rowsBetween(W.unboundedPreceding, -1)
    run = F.coalesce(F.sum(F.col("n") * F.col("size")).over(before), F.lit(0))
    part = same.withColumn(
        "part", F.floor(F.least(F.greatest(F.col("left") - run, F.lit(0)), F.col("n") * F.col("size")) / F.col("n")).cast("long")
    ).filter("part > 0")
    part = part.select(F.col("source").alias("ps"), F.col("u").alias("pu"), F.col("id").alias("pi"), F.col("size").alias("pz"), "part")
    return sized, plan, S.table(part, "mix-boundary")


def _bucket(u: Column, levels: int) -> Column:
    """The first ``levels`` digits of a hash."""
    return F.shiftright(u, HASH_BITS - DIGIT_BITS * levels)


def _descend(sized: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """Adds a digit to every source's ``edge``: the one at which ``left`` runs out.

    A source has at most ``2 ** DIGIT_BITS`` counts a level. A source whose words
    do not run out keeps a null edge: all of its documents are below it.
    """
    digits = (
        sized.join(plan.filter(F.col("edge").isNotNull()), F.col("source").eqNullSafe(F.col("p")))
        .filter(_bucket(F.col("u"), level) == F.col("edge"))
        .groupBy("p", "left", _bucket(F.col("u"), level + 1).alias("next"))
        .agg(F.sum("size").alias("words"))
    )
    upto = F.sum("words").over(W.partitionBy("p").orderBy("next").rowsBetween(W.unboundedPreceding, W.currentRow))
    step = (
        digits.withColumn("upto", upto)
        .filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
        .select(F.col("p").alias("s"), "next", (F.col("left") - F.col("upto") + F.col("words")).alias("new_left"))
    )
    kept = plan.drop("edge", "left").join(step, F.col("p").eqNullSafe(F.col("s")), "left").drop("s")
    return kept.withColumnsRenamed({"next": "edge", "new_left": "left"})


def _taken(sized: DataFrame, plan: DataFrame, part: DataFrame, levels: int) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``taken`` to rows with id, source, size and u.

    Both tables are small (a row per source); Spark broadcasts them by their
    measured size, and splits a hot source's rows where it does not.
    """
    key = F.col("source").eqNullSafe(F.col("ps")) & (F.col("u") == F.col("pu")) & F.col("id").eqNullSafe(F.col("pi")) & (F.col("size") == F.col("pz"))
    below = F.col("edge").isNull() | (_bucket(F.col("u"), levels) < F.col("edge"))
    extra = F.coalesce(F.col("part"), F.when(below, F.col("size")), F.lit(0))
    return (
        sized.join(plan, F.col("source").eqNullSafe(F.col("p")))
        .join(part, key, "left")
        .withColumn("taken", (F.col("whole") * F.col("size") + extra).cast("long"))
    )


def mix_sources(
    docs: DataFrame,
    weights=default_weights,
    max_epochs: int = 3,
    share: float = 1.0,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    levels: int = LEVELS,
) -> DataFrame:
    """One row per document: ``(id, source, size, source_size, target, taken)``.

    ``weights`` takes a frame ``(source, source_size)`` and adds ``weight``.
    ``taken`` counts the words the mix takes of the document, repeats included.
    """
    sized, plan, part = _plan(docs, weights, max_epochs, share, seed, id_col, text_col, source_col, levels)
    return _taken(sized, plan, part, levels).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken"
    )


def mixed_documents(
    docs: DataFrame,
    weights=default_weights,
    max_epochs: int = 3,
    share: float = 1.0,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    levels: int = LEVELS,
) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, same columns.

    A fractional repetition counts as one more whole document from half of its
    words on, so texts stay whole. Documents that are not taken go. Texts are
    not shuffled: each row is decided by its own hash and its source's plan.
    """
    _, plan, part = _plan(docs, weights, max_epochs, share, seed, id_col, text_col, source_col, levels)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(S.text_or_empty(text_col)).alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    ).withColumn("u", seeded_hash(seed, F.col("id"), F.col("size")))
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + F.lit(0.5))).otherwise(0).cast("int")
    mixed = _taken(rows, plan, part, levels).withColumn("times", times).filter("times > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
