"""Personal data: base patterns, plus identifiers found by bootstrapped contexts.

Seeds are what the base patterns find (emails, IPs, cards, phones). Every seed
and every other identifier-like token (a word with a digit or ``@``) occurs in a
lexical pattern, its two preceding words. Patterns and instances form a graph,
scored in rounds: a pattern's confidence is the share of its instances' scores,
an unseen instance's score is the chance that one of its reliable patterns is
right (noisy or). Rounds go on until one brings no new reliable pattern; scores only
rise, so patterns are never lost. Then unseen tokens are added, as spans of kind
``found``, where they stand in a reliable pattern (which gives a token at least the
pattern's confidence as its score).

All steps are DataFrame functions. Texts are read once; the written table of
occurrences is what the rounds join and aggregate, by pattern and by instance.
Occurrences of copies of a text are merged before they are shuffled or counted.

Defined cases: null text is empty; empty texts have no spans; equal rows give
equal rows; null ids are kept; an empty table gives an empty result; extra
columns are not read. Tokens of any length are identifiers; they are joined by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared as S
from .spans import joined, match_spans, tagged

# The base kinds. Each regex starts only where a run of its first
# characters starts (or the last match ended) and gives back nothing, which
# finds what the plain form finds without retrying long runs at every character.
_LOCAL = "A-Za-z0-9._%+-"
REGEX = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(REGEX)
FOUND = "found"

#: A word with a digit or an at sign.
TOKEN = r"(?:\G|(?<![^\x20\x09-\x0D]))[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.7


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when(i % 2 == 0, v).when(v > 4, v * 2 - 9).otherwise(v * 2)

    digits = F.filter(F.split(F.reverse(_digits(text)), ""), lambda c: c != "")
    return F.aggregate(F.transform(digits, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        # by its length first: a long part overflows any number type
        parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.length(_digits(text)).between(14, 19) & _luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The base matches of one kind as ``array<SPAN>``, with their left context."""
    return F.filter(match_spans(text, REGEX[kind], left=True), lambda x: _valid(kind, x["text"]))


def _pattern(left: Column) -> Column:
    """The two words before an occurrence, lower-cased; empty where there are none."""
    return F.lower(F.regexp_extract(left, r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1))


def _key(token: Column) -> Column:
    """What stands for an instance, case aside: short however long the token is."""
    return F.unhex(F.md5(F.lower(token).cast("binary")))


def _occurrences(scanned: DataFrame) -> DataFrame:
    """``(h, start, end, instance, pattern, seed)``: one row per place and text."""
    seeds = scanned.select("h", F.explode(F.concat(*[F.col(k) for k in KINDS])).alias("x")).select(
        "h", "x.start", "x.end", _key(F.col("x.text")).alias("instance"), _pattern(F.col("x.left")).alias("pattern"), F.lit(True).alias("seed")
    )

    def free(t: Column) -> Column:
        hits = [F.exists(k, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])) for k in KINDS]
        return ~(hits[0] | hits[1] | hits[2] | hits[3])

    token = F.regexp_replace("x.text", r"[.,;:!?)\]}\"']+$", "")
    others = (
        scanned.select("h", *KINDS, F.explode("token").alias("x"))
        .filter(free(F.col("x")))
        .select(
            "h",
            "x.start",
            (F.col("x.start") + F.length(token)).alias("end"),
            _key(token).alias("instance"),
            _pattern(F.col("x.left")).alias("pattern"),
            F.lit(False).alias("seed"),
        )
    )
    return seeds.unionByName(others).filter("pattern <> ''").distinct()


def bootstrap(occurrences: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Scores the pattern-instance graph; returns the reliable patterns.

    The result is ``(pattern, confidence)``. Each round is two aggregates and
    two joins over the edges, written so that a lost executor costs no rounds. A
    round has a new pattern or is the last one, so there are at most as many as
    links between the seeds and the farthest pattern.
    """
    edges = S.table(occurrences.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    score, scored, known, k = F.when(F.col("seed"), 1.0).otherwise(0.0), edges, 0, 0
    while True:
        # patterns without any seed or scored instance cannot become reliable
        patterns = (
            scored.withColumn("s", score)
            .groupBy("pattern")
            .agg(F.sum("s").alias("support"), F.count(F.lit(1)).alias("n"))
            .withColumn("confidence", F.col("support") / F.col("n"))
            .filter((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
            .select("pattern", "confidence")
        )
        patterns = S.table(patterns, f"pii-patterns-{k}")
        found = patterns.count()
        if found == known:
            return patterns
        known, k = found, k + 1
        unseen = edges.filter(~F.col("seed")).join(patterns, "pattern")
        wrong = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-3))))
        scores = S.table(unseen.groupBy("instance").agg((1 - F.exp(wrong)).alias("score")), f"pii-scores-{k}")
        scored = edges.join(scores, "instance", "left")
        score = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``(id, spans)``, ``spans`` an array of
    ``(start, ord, end, kind)`` in code points, by start, then kind."""
    text = S.text_or_empty(text_col)
    scanned = S.table(
        docs.select(
            F.col(id_col).alias("id"),
            F.md5(text.cast("binary")).alias("h"),
            *[base_spans(text, k).alias(k) for k in KINDS],
            match_spans(text, TOKEN, left=True).alias("token"),
        ),
        "pii-scanned",
    )
    occurrences = S.table(_occurrences(scanned), "pii-occurrences")
    patterns = bootstrap(occurrences, **options)
    found = (
        occurrences.filter(~F.col("seed"))
        .join(patterns, "pattern")
        .groupBy("h")
        .agg(F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("ord"), "end", F.lit(FOUND).alias("kind"))).alias("found"))
    )
    found = S.table(found, "pii-found")
    base = F.concat(*[tagged(F.col(k), n, k) for n, k in enumerate(KINDS)])
    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    rows = scanned.select("id", "h", base.alias("base")).join(found, "h", "left")
    return rows.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", F.coalesce("found", none))).alias("spans"))


def pii_report(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of the scan: counts, the base kinds' SHA-256, all spans."""
    spans = scan_pii(docs, **options)
    id_col = options.get("id_col", "doc_id")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))

    return spans.select(
        id_col,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(of(*KINDS)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
