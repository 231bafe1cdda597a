"""Secrets by a trigram inverted index over the texts, in DataFrame functions.

From each rule's regex a Boolean query over lower-case trigrams is derived: the
trigrams that every match must contain, an alternative for each way through the
regex. One pass over the texts builds the postings: for every trigram that some
rule asks for, bitmaps over text slots (hashes of the text). Intersecting the
postings of an alternative and uniting the alternatives gives a bitmap of
candidate slots per rule. A second pass runs a rule's regex on its candidates
only. Rules without mandatory trigrams (hex runs) run on every text.

Bounds. Slots grow with the rows up to ``MAX_SLOTS``; the candidate bitmaps, the
only thing broadcast, take ``MAX_SLOTS / 8`` bytes a rule. Beyond the bound texts
share slots, so more texts are verified; results are the same at any size.
Texts are never shuffled; postings are gathered per block of slots.

Defined cases: null text is empty; empty texts have no spans; equal rows give
equal rows; null ids are kept; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from functools import reduce
from re import _constants as sre
from re import _parser as sre_parse
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared as S
from .spans import joined, match_spans, tagged

MAX_SLOTS = 1 << 26
SLOTS_PER_ROW = 8
#: Ways through a regex that are followed apart; beyond it the query is cut short there.
MAX_WAYS = 64


class Rule(NamedTuple):
    """``group``'s text has at least ``least`` characters, else a match is dropped."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


# The secret kinds. The first three are the base kinds.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
]
BASE_KINDS = ("assign", "access", "hex")


def trigram_query(regex: str) -> list[frozenset[str]]:
    """The Boolean query of a regex: alternatives, each a set of trigrams that
    must all occur in the lower-cased text. An empty alternative: no condition.

    Walks the regex's ways as lists of literal runs; whatever has no few fixed
    characters (wide classes, options, repeats) ends a run.
    """

    def product(ways, more):
        out = [a[:-1] + [a[-1] + b[0]] + b[1:] for a in ways for b in more]
        return out if len(out) <= MAX_WAYS else [a + [""] for a in ways]

    def walk(items) -> list[list[str]]:
        ways = [[""]]
        for op, arg in items:
            if op is sre.LITERAL:
                more = [[chr(arg).lower()]]
            elif op is sre.SUBPATTERN:
                more = walk(arg[3])
            elif op is sre.BRANCH:
                more = [w for branch in arg[1] for w in walk(branch)]
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
                more = [[chr(c).lower()] for _, c in arg]
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == 0 and arg[1] == 1 and len(arg[2]) == 1:
                more = [[""], *walk(arg[2])]
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                more = [w + [""] for w in walk(arg[2])]
            elif op is sre.AT:
                more = [[""]]
            else:
                more = [["", ""]]
            ways = product(ways, more)
        return ways

    found = {frozenset(run[i : i + 3] for run in way for i in range(len(run) - 2)) for way in walk(sre_parse.parse(regex))}
    # an alternative that contains another one adds nothing
    return sorted((a for a in found if not any(b < a for b in found)), key=sorted)


def _inline(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small constant table (rules, not data) as a native plan."""
    cells = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names, strict=True)]) for r in rows])
    return spark.range(1).select(F.explode(cells).alias("r")).select("r.*")


def _slot(text: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(slots)).cast("long")


def postings(texts: DataFrame, trigrams: list[str], slots: int) -> DataFrame:
    """The inverted index ``(trigram, block, bits)`` over the slots of ``text``."""
    # lower-cased once a row: the conditions below would each do it again
    low = F.col("low")
    texts = texts.select("text", F.explode(F.array(F.lower("text"))).alias("low"))
    masks = []
    for k in range(0, len(trigrams), 60):
        bits = [F.when(F.contains(low, F.lit(t)), F.lit(1 << j)).otherwise(F.lit(0)).cast("long") for j, t in enumerate(trigrams[k : k + 60])]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(f"mask{k // 60}"))
    names = [f"mask{k}" for k in range(len(masks))]
    slot = _slot(F.col("text"), slots)
    by_slot = (
        texts.select(slot.alias("slot"), *masks)
        .filter(" or ".join(f"{n} <> 0" for n in names))
        # copies of a text meet here before they are shuffled
        .groupBy("slot")
        .agg(*[F.bit_or(n).alias(n) for n in names])
        .withColumn("block", S.slot_block(F.col("slot")))
        .withColumn("bit", S.slot_bit(F.col("slot")))
    )
    has = [
        F.when(F.col(f"mask{j // 60}").bitwiseAND(F.lit(1 << (j % 60)).cast("long")) != 0, F.lit(j)) for j in range(len(trigrams))
    ]
    return (
        by_slot.repartition("block")
        .select("block", "bit", F.explode(F.array_compact(F.array(*has))).alias("trigram"))
        .groupBy("block", "trigram")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]], trigrams: list[str]) -> DataFrame:
    """``(block, <kind>...)``: the bitmap of candidate slots of every rule."""
    at = {t: j for j, t in enumerate(trigrams)}
    asked = [(kind, k, at[t], len(way)) for kind, ways in queries.items() for k, way in enumerate(ways) for t in sorted(way)]
    asked = _inline(index.sparkSession, asked, ["kind", "way", "trigram", "needs"])
    ways = (
        index.join(F.broadcast(asked), "trigram")
        .groupBy("kind", "way", "needs", "block")
        .agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == F.col("needs"))
    )
    either = ways.groupBy("kind", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return either.groupBy("block").agg(*[F.max(F.when(F.col("kind") == k, F.col("bits"))).alias(k) for k in queries])


def rule_spans(text: Column, rule: Rule) -> Column:
    found = match_spans(text, rule.regex, rule.group)
    return F.filter(found, lambda x: F.length(x["group"]) >= rule.least) if rule.least else found


def scan_secrets(
    docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", max_slots: int = MAX_SLOTS
) -> DataFrame:
    """One row per document: ``(id, spans)``, ``spans`` an array of
    ``(start, ord, end, kind)`` in code points, by start, then rule order."""
    texts = docs.select(F.col(id_col).alias("id"), S.text_or_empty(text_col).alias("text"))
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    queries = {k: q for k, q in queries.items() if all(q)}
    flags = {}
    if queries:
        trigrams = sorted({t for q in queries.values() for way in q for t in way})
        slots = S.filter_slots(texts.count(), SLOTS_PER_ROW, max_slots)
        index = S.table(postings(texts, trigrams, slots), "secret-postings")
        cands = S.table(candidates(index, queries, trigrams), "secret-candidates")
        cands = cands.withColumnsRenamed({k: f"bits_{k}" for k in queries})
        slot = _slot(F.col("text"), slots)
        # max_slots / 8 bytes a rule at most, whatever the number of rows
        texts = texts.join(F.broadcast(cands), S.slot_block(slot) == F.col("block"), "left")
        flags = {k: S.bit_is_set(F.col(f"bits_{k}"), S.slot_bit(slot)) for k in queries}
    found = []
    for n, r in enumerate(rules):
        spans = tagged(rule_spans(F.col("text"), r), n, r.kind)
        none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
        found.append(F.when(flags[r.kind], spans).otherwise(none) if r.kind in flags else spans)
    return texts.select(F.col("id").alias(id_col), F.array_sort(F.concat(*found)).alias("spans"))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of the scan: counts, the base kinds' SHA-256, all spans."""
    # one evaluation of the spans: the columns below read them from rows
    spans = scan_secrets(docs, **options)
    id_col = options.get("id_col", "doc_id")
    one = spans.select(F.col(id_col), F.explode(F.array("spans")).alias("spans"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))

    return one.select(
        id_col,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
