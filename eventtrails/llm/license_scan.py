"""Licences by digests of canonical texts.

A text is brought to a canonical form (lower case, copyright lines out,
punctuation to spaces, one spelling for equivalent words) and its SHA-256 is
joined to the digests of the known licences in the same form. Entire texts are
compared, never parts; besides whole documents, whole lines are looked up too,
which finds one-line notices inside documents. All joins are hash joins against
the known digests, a fixed table of the rules; documents are not shuffled.

White space of any kind is one space in the form, so only copyright lines depend on
where lines break. A line is one if it reads as one (a copyright word or sign with a
year or sign after it, or "all rights reserved"), which no line of a licence's own
terms does, however wrapped. A licence with a copyright line of its own (the GPL's) is
looked up in a second form too, in which no line is dropped. Not found is a text whose
writer both re-wrapped such a licence's own copyright line and added another one, and a
notice whose copyright line is broken in two.

Defined cases: null counts as empty; a text whose canonical form is empty has no
licence; equal rows give equal rows; null ids are kept; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared as S
from .license_texts import EQUIVALENTS, NOTICES, TEXTS

# Fixed values of the canonical form, shared with the SQL form of the query.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = (
    r"(^|\n)[\x20\t]*(?:copyright[\x20\t:]*(?:\(c\)|©|[0-9]{4})|\(c\)[\x20\t]*(?:copyright|©|[0-9]{4})|©|all rights reserved)[^\n]*"
)
PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F“”‘’–—•©®™\x{A0}]+"


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _without_copyright(lowered: Column) -> Column:
    return F.regexp_replace(lowered, COPYRIGHT_LINE, "\n")


def _plain(lowered: Column) -> Column:
    """Words separated by one space, in one spelling."""
    # two spaces between words while words are replaced: each has its own delimiters
    t = F.concat(F.lit(" "), F.regexp_replace(lowered, PUNCTUATION, "  "), F.lit(" "))
    for found, plain in EQUIVALENTS:
        t = F.replace(t, F.lit(f" {found.replace(' ', '  ')} "), F.lit(f" {plain.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(t, " +", " "))


def canonical(text: Column) -> Column:
    """The form that digests are taken of, without copyright lines."""
    return _plain(_without_copyright(_lower(text)))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null where that is empty."""
    return _digest_of(canonical(text))


def _digest_of(form: Column) -> Column:
    return F.sha2(F.nullif(form, F.lit("")).cast("binary"), 256)


def known_digests(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """``(known, license)`` of a list of licence texts; texts of one form merge."""
    cells = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in texts])
    rows = spark.range(1).select(F.explode(cells).alias("x"))
    forms = F.array(digest(F.col("x.text")), _digest_of(_plain(_lower(F.col("x.text")))))
    rows = rows.select(F.explode(F.array_distinct(forms)).alias("known"), "x.license")
    return rows.groupBy("known").agg(F.min("license").alias("license"))


#: In every notice, so lines without it need no canonical form.
KEYWORD = "licen"


def _notice_lines(text: Column, notices: list[tuple[str, str]]) -> Column:
    """Digests of the whole lines that may be notices."""
    lines = F.split(text, "\n")
    if all(KEYWORD in body.lower() for _, body in notices):
        lines = F.filter(lines, lambda x: F.contains(F.translate(x, UPPER, LOWER), F.lit(KEYWORD)))
    return F.transform(lines, digest)


def scan_licenses(
    docs: DataFrame,
    texts: list[tuple[str, str]] = TEXTS + NOTICES,
    notices: list[tuple[str, str]] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``(id, text_digest, license, line_licenses)``.

    ``license`` is that of the whole text, null if unknown; ``line_licenses`` the
    distinct licences of lines that are notices, comma-joined in order of name.
    """
    text = S.text_or_empty(text_col)
    # each form in an operator of its own, so that it is worked out once a row
    rows = docs.select(F.col(id_col).alias("id"), F.explode(F.array(_lower(text))).alias("low"), _notice_lines(text, notices).alias("lines"))
    stripped = F.explode(F.array(_without_copyright(F.col("low")))).alias("stripped")
    rows = rows.select("id", "lines", "low", stripped)
    form = F.explode(F.array(_plain(F.col("stripped")))).alias("form")
    # the second form only where a line was dropped
    entire = F.when(F.col("low") != F.col("stripped"), _digest_of(_plain(F.col("low")))).alias("entire")
    rows = rows.select("id", "lines", form, entire)
    rows = rows.select("id", _digest_of(F.col("form")).alias("text_digest"), "entire", "lines")
    # the digests of the rules' own texts: a fixed few, whatever the documents
    whole = known_digests(docs.sparkSession, texts)
    known = known_digests(docs.sparkSession, notices).collect()
    by_digest = F.create_map(*[F.lit(v) for r in known for v in (r["known"], r["license"])])
    found = F.array_compact(F.transform("lines", lambda d: by_digest[d]))
    second = whole.select(F.col("known").alias("known_entire"), F.col("license").alias("license_entire"))
    rows = rows.join(F.broadcast(whole), F.col("text_digest") == F.col("known"), "left")
    rows = rows.join(F.broadcast(second), F.col("entire") == F.col("known_entire"), "left")
    return rows.select(
        F.col("id").alias(id_col),
        "text_digest",
        F.coalesce("license", "license_entire").alias("license"),
        F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("line_licenses"),
    )
