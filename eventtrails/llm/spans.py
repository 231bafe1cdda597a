"""Regex matches with their places, in DataFrame functions.

Spark's regex functions return matched strings without offsets. The pieces
between matches (``split``) and the matches (``regexp_extract_all``) alternate,
so running lengths give every match its place, in code points. Pieces are gone
through in chunks, so that no array grows with the matches of a text: the time is in
proportion to the text (but for one small step a chunk).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,text:string,group:string,left:string>"
NO_SPANS = f"array<{SPAN}>"
#: Pieces that one fold goes through: its array grows to this length at most.
CHUNK = 256
#: A longer word stands in left contexts as its digest, which keeps them short
#: where one word holds many matches.
LONG_WORD = 256


def _last_two_words(text: Column) -> Column:
    """The last two words of a text (the last may be unfinished), with the white
    space after them; read from the end, so in linear time."""
    tail = F.reverse(F.regexp_extract(F.reverse(text), r"^([\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){0,2}+)", 1))

    def short(w: Column) -> Column:
        word = F.regexp_extract(w, r"^[^\x20\x09-\x0D]++", 0)
        digest = F.concat(F.md5(F.lower(word).cast("binary")), F.substr(w, F.length(word) + 1))
        return F.when(F.length(word) > LONG_WORD, digest).otherwise(w)

    words = F.regexp_extract_all(tail, F.lit(r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"), F.lit(0))
    return F.array_join(F.transform(words, short), "")


def match_spans(text: Column, regex: str, group: int = 0, left: bool = False) -> Column:
    """Leftmost non-overlapping matches as ``array<SPAN>``.

    ``group`` is the capture group whose text comes along; ``left`` adds the two
    words of the text before the match, whatever they matched themselves.
    """
    rx = F.lit(regex)
    whole = F.regexp_extract_all(text, rx, F.lit(0))
    part = F.regexp_extract_all(text, rx, F.lit(group)) if group else whole
    zipped = F.arrays_zip(whole.alias("m"), part.alias("g"), F.split(text, regex, -1).alias("p"))
    zipped = zipped.cast("array<struct<m:string,g:string,p:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["p"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        before, after = F.lit(None).cast("string"), acc["left"]
        if left:
            before = _last_two_words(F.concat(acc["left"], x["p"]))
            after = F.concat(before, F.coalesce(x["m"], F.lit("")))
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text"), x["g"].alias("group"), before.alias("left"))
        out = F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span).cast(NO_SPANS)))
        return F.struct(end.alias("pos"), after.alias("left"), out.alias("out"))

    def skip(acc: Column, chunk: Column) -> Column:
        """Where the next chunk starts, and the words before it."""
        size = F.aggregate(chunk, F.lit(0), lambda n, x: n + F.length(x["p"]) + F.coalesce(F.length(x["m"]), F.lit(0)))
        words = acc["left"]
        if left:
            text = F.array_join(F.transform(chunk, lambda x: F.concat(x["p"], F.coalesce(x["m"], F.lit("")))), "")
            words = _last_two_words(F.concat(words, text))
        at = F.struct((acc["pos"] + size).alias("pos"), words.alias("left"))
        return F.struct(at["pos"].alias("pos"), at["left"].alias("left"), F.concat(acc["at"], F.array(at)).alias("at"))

    none = F.array().cast(NO_SPANS)
    first = F.struct(F.lit(0).alias("pos"), F.lit("").alias("left"))

    def in_chunks(chunks: Column) -> Column:
        begin = F.struct(F.lit(0).alias("pos"), F.lit("").alias("left"), F.array(first).alias("at"))
        starts = F.aggregate(F.slice(chunks, F.lit(1), F.size(chunks) - 1), begin, skip, lambda acc: acc["at"])

        def fold(chunk: Column, at: Column) -> Column:
            return F.aggregate(chunk, F.struct(at["pos"].alias("pos"), at["left"].alias("left"), none.alias("out")), step, lambda acc: acc["out"])

        return F.flatten(F.zip_with(chunks, starts, fold))

    def cut(pieces: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(pieces), F.lit(CHUNK)), lambda i: F.slice(pieces, i, F.lit(CHUNK)))

    found = F.get(F.transform(F.transform(F.array(zipped), cut), in_chunks), F.lit(0))
    return F.when(text.rlike(regex), found).otherwise(none)


def tagged(spans: Column, order: int, kind: str) -> Column:
    """Spans as ``array<struct<start, ord, end, kind>>``, which sorts by start, then kind."""
    return F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("ord"), x["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` of tagged spans by start, then kind, comma-joined."""
    parts = F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(parts, ",")
