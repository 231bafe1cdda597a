"""Conversation structure repair by a square-root checkpointed dynamic program.

Roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. Edits keep a
row (0), change its role to user or assistant (1), delete it (2; required for blank
rows and repeats of an earlier role and text) or insert an empty user or assistant row
(5); a row that ends without ``.``, ``!`` or ``?`` costs 5 more unless deleted. Of the
cheapest edits the ASCII-least string of initials (D, I, K, R) is taken: backward
costs of the four states (nothing yet, after s, u, a) say which edits are tight, and a
walk forward takes the least tight one. Costs are stored only at every square root
of the rows; the walk recomputes one block of them at a time.

Rows become runs (equal rows of one turn, with their number), sorted by ranges of all
rows, so a conversation of any size is spread over tasks. It is cut into segments of
at most ``SEGMENT`` runs. Where it has several, each segment gives the cost between its
ends for every pair of states, which compose to the costs at its borders and to the
state that the walk enters it in; then all segments are walked independently. Texts
take no part in that. They are sorted once, beside the edits, by conversation, and
read as a stream, which is the order that a digest of the conversation needs.

Defined cases: a null role or text is one space, null turns come first; rows of one
turn are in order of role, then of the text's SHA-256. An empty role has no initial
and is never kept. A conversation whose id is null is one conversation. Texts are read
whole. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared as S

CHANGE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
SEGMENT_BITS = 14
SEGMENT = 1 << SEGMENT_BITS

# A run's code: four times its fault, plus the class of its role's initial.
INITIALS = "sua"
FINE, TRUNCATED, DOOMED = 0, 1, 2

# States: nothing yet, after s, after u, after a. KEEP[state][class] is the state after
# a kept row; a changed or an inserted row is what the state waits for.
NEVER = 1 << 60
KEEP = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
WANTED = (2, 2, 3, 2)
ROLE_OF = {2: "u", 3: "a"}
END = (0, 2 * INSERT, INSERT, 0)

ROLES = {"u": "user", "a": "assistant"}


def _back(code: int, after: tuple) -> tuple:
    """Costs before a run from those after it."""
    fault, who = divmod(code, 4)
    cost = [DELETE + c for c in after]
    if fault != DOOMED:
        extra = CUT_OFF if fault == TRUNCATED else 0
        for s in range(4):
            cost[s] = min(cost[s], CHANGE + extra + after[WANTED[s]])
            if KEEP[s][who] is not None:
                cost[s] = min(cost[s], extra + after[KEEP[s][who]])
    u, a = cost[2], cost[3]
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return (min(cost[0], INSERT + u), min(cost[1], INSERT + u), u, a)


def _checkpoints(codes: bytes, after: tuple) -> tuple[int, list[tuple]]:
    """The block length and the costs at the end of every block."""
    block = max(1, isqrt(len(codes)))
    ends, cost = [], after
    for i in range(len(codes) - 1, -1, -1):
        if i == len(codes) - 1 or (i + 1) % block == 0:
            ends.append(cost)
        cost = _back(codes[i], cost)
    return block, ends[::-1]


def walk(codes: bytes, state: int, after: tuple, last: bool) -> tuple[list[str], str, str, int, int]:
    """The ASCII-least tight edits of a segment.

    Returns the roles inserted before each run, what happens to each run (``D``,
    ``K``, or ``u`` or ``a`` for a changed role), the roles inserted after the last
    run (only if ``last``), the cost and the state at the end.
    """
    block, ends = _checkpoints(codes, after)
    before, acts, total = [], [], 0
    for b, cost in enumerate(ends):
        part = codes[b * block : (b + 1) * block]
        costs = [cost]
        for code in reversed(part):
            costs.append(_back(code, costs[-1]))
        costs.reverse()
        for i, code in enumerate(part):
            fault, who = divmod(code, 4)
            extra = CUT_OFF if fault == TRUNCATED else 0
            put = ""
            while True:
                now, then = costs[i], costs[i + 1]
                if DELETE + then[state] == now[state]:
                    act, total = "D", total + DELETE
                    break
                to = WANTED[state]
                if INSERT + now[to] == now[state]:
                    put, total, state = put + ROLE_OF[to], total + INSERT, to
                    continue
                kept = KEEP[state][who]
                if kept is not None and extra + then[kept] == now[state]:
                    act, total, state = "K", total + extra, kept
                else:
                    act, total, state = ROLE_OF[to], total + CHANGE + extra, to
                break
            before.append(put)
            acts.append(act)
    tail = ""
    while last and END[state]:
        state, total = WANTED[state], total + INSERT
        tail += ROLE_OF[state]
    return before, "".join(acts), tail, total, state


def transfer(codes: bytes) -> list[tuple]:
    """``[end][start]``: the cost of a segment from any state to any state."""
    out = []
    for end in range(4):
        cost = tuple(0 if s == end else NEVER for s in range(4))
        for code in reversed(codes):
            cost = tuple(min(c, NEVER) for c in _back(code, cost))
        out.append(cost)
    return out


def damage(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """The seeded damage: ``(conv, turn, role, text, copies)``, ``conv`` as string."""
    conv, turn = F.col(conv_col).cast("string"), F.col(turn_col).cast("string")
    key = F.concat(F.coalesce(conv, F.lit(" ")), F.lit(":"), F.coalesce(turn, F.lit(" ")))
    what = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(role_col, F.lit(" ")), F.coalesce(text_col, F.lit(" "))
    rows = conversations.select(conv.alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), what.alias("what"))
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.filter("what <> 0").select(
        "conv",
        "turn",
        F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("what") == 3, 2).otherwise(1).alias("copies"),
    )


def as_rows(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """A conversation table as it is, in the columns that :func:`repairs` reads."""
    role, text = F.coalesce(role_col, F.lit(" ")), F.coalesce(text_col, F.lit(" "))
    return conversations.select(
        F.col(conv_col).cast("string").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.lit(1).alias("copies"),
    )


_ORDER = ("conv", "turn", "role", "digest")


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _meet(left: DataFrame, right: DataFrame, *on: str, how: str = "left") -> DataFrame:
    """Join on the conversation (null meets null) and ``on``; the keys of ``left`` stay."""
    keys = ("conv", *on)
    named = right.select(*[F.col(k).alias(f"other_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = left["conv"].eqNullSafe(named["other_conv"])
    for k in on:
        cond = cond & (left[k] == named[f"other_{k}"])
    return left.join(named, cond, how).drop(*[f"other_{k}" for k in keys])


def runs(rows: DataFrame) -> DataFrame:
    """Runs in order, with their faults; written.

    ``(conv, seq, turn, role, digest, n, blank, repeat, truncated)``: ``n`` equal
    rows, of which the first is a duplicate only if ``repeat``.
    """
    end = F.substring(F.rtrim(F.col("text"), F.lit(S.WS_CHARS)), -1, 1)
    keys = _with_digest(rows).select(*_ORDER, "copies", (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("truncated"))
    keys = keys.groupBy(*_ORDER, "blank", "truncated").agg(F.sum("copies").alias("n"))
    dealt = keys.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    dealt = S.table(dealt.withColumn("seq", F.monotonically_increasing_id()), "repair-sorted")
    first = dealt.filter("not blank").groupBy("conv", "role", "digest").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("runs"))
    first = S.table(first.filter("runs > 1").drop("runs"), "repair-first")
    joined = _meet(dealt, first, "role", "digest")
    repeat = ~F.col("blank") & F.coalesce(F.col("seq") > F.col("first"), F.lit(False))
    return S.table(joined.select(*_ORDER, "seq", "n", "blank", repeat.alias("repeat"), "truncated"), "repair-runs")


def _segments(found: DataFrame) -> DataFrame:
    """``(conv, seg, runs)``: at most ``SEGMENT`` runs a row, in order; written."""
    initial = F.substring("role", 1, 1)
    who = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(F.col("blank") | F.col("repeat"), DOOMED).when(F.col("truncated"), TRUNCATED).otherwise(FINE)
    run = F.struct("seq", (fault * 4 + who).alias("code"), "n", "turn", "role", "digest")
    grouped = found.groupBy("conv", F.shiftright("seq", SEGMENT_BITS).alias("seg")).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    return S.table(grouped, "repair-segments")


def _codes(x) -> bytes:
    return bytes(int(c) for c in x)


def _transfers(codes: pd.Series) -> pd.Series:
    return codes.map(lambda c: [x for row in transfer(_codes(c)) for x in row])


def _exits(codes: pd.Series, after: pd.Series) -> pd.Series:
    out = [[walk(_codes(c), s, tuple(int(x) for x in a), False)[4] for s in range(4)] for c, a in zip(codes, after)]
    return pd.Series(out)


def _legal(left: int, right: int) -> bool:
    return INITIALS[left : left + 1] + INITIALS[right : right + 1] in ("su", "ua", "au")


def _fix(codes, copies, entry, after, last) -> tuple:
    codes, copies = _codes(codes), [int(n) for n in copies]
    before, acts, tail, cost, _ = walk(codes, int(entry), tuple(int(x) for x in after), bool(last))
    letters = ["I" * len(b) + ("R" if a in ROLES else a) + "D" * (n - 1) for b, a, n in zip(before, acts, copies)]
    more = sum(copies) - len(copies)
    broken = more + sum(not _legal(x % 4, y % 4) for x, y in zip(codes, codes[1:]))
    tails = [""] * (len(codes) - 1) + [tail]
    return before, list(acts), tails, "".join(letters) + "I" * len(tail), cost + DELETE * more, broken


_FIX = "before array<string>, act array<string>, tail array<string>, audit string, cost long, broken long"


def _walks(codes: pd.Series, copies: pd.Series, entry: pd.Series, after: pd.Series, last: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_fix(*x) for x in zip(codes, copies, entry, after, last)], columns=[c.split()[0] for c in _FIX.split(", ")])


def _border_costs(group: pd.DataFrame) -> pd.DataFrame:
    """Costs at the end of every segment of one conversation, from last to first."""
    group = group.sort_values("seg", ascending=False)
    out, after = [], END
    for t in group["transfer"]:
        out.append(list(after))
        after = tuple(min(int(t[4 * end + s]) + after[end] for end in range(4)) for s in range(4))
    return pd.DataFrame({"conv": group["conv"], "seg": group["seg"], "after": out, "last": [True] + [False] * (len(out) - 1)})


def _entry_states(group: pd.DataFrame) -> pd.DataFrame:
    """The state that the walk enters every segment in, from first to last."""
    group = group.sort_values("seg")
    out, state = [], 0
    for exits in group["exits"]:
        out.append(state)
        state = int(exits[state])
    return pd.DataFrame({"conv": group["conv"], "seg": group["seg"], "entry": out, "after": group["after"], "last": group["last"]})


def _borders(segments: DataFrame) -> DataFrame:
    """Entry state and end costs of the segments of conversations that have several."""
    many = segments.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv")
    long = _meet(segments, many, how="left_semi")
    long = S.table(long.select("conv", "seg", F.col("runs.code").alias("codes")), "repair-long")
    costs = long.select("conv", "seg", F.pandas_udf(_transfers, "array<long>")("codes").alias("transfer"))
    costs = costs.groupBy("conv").applyInPandas(_border_costs, "conv string, seg long, after array<long>, last boolean")
    costs = S.table(costs, "repair-costs")
    met = _meet(long, costs, "seg", how="inner").select("conv", "seg", F.pandas_udf(_exits, "array<int>")("codes", "after").alias("exits"), "after", "last")
    states = met.groupBy("conv").applyInPandas(_entry_states, "conv string, seg long, entry int, after array<long>, last boolean")
    return S.table(states, "repair-borders")


def repairs(found: DataFrame) -> DataFrame:
    """``(conv, seg, runs, before, act, tail, audit, cost, broken)``, one row a segment;
    written. ``broken``: neighbours within the segment that no repaired row has."""
    S.ship_code(found.sparkSession)
    segments = _segments(found)
    at = _borders(segments)
    whole = _meet(segments, at, "seg").select(
        *("conv", "seg", "runs"),
        F.coalesce("entry", F.lit(0)).alias("entry"),
        F.coalesce("after", F.array(*[F.lit(x).cast("long") for x in END])).alias("after"),
        F.coalesce("last", F.lit(True)).alias("last"),
    )
    fixed = whole.withColumn("fix", F.pandas_udf(_walks, _FIX)(F.col("runs.code"), F.col("runs.n"), "entry", "after", "last"))
    return S.table(fixed.select("conv", "seg", "runs", "fix.*"), "repair-walks")


def edits(fixed: DataFrame) -> DataFrame:
    """``(conv, turn, role, digest, seq, n, before, act, tail)``, one row a run: the
    roles inserted before it, what its first row becomes (``D``, ``K``, or ``u`` or
    ``a`` for a changed role; further rows are deleted), the roles inserted at the end."""
    rows = fixed.select("conv", F.explode(F.arrays_zip("runs", "before", "act", "tail")).alias("x"))
    runs_of = [F.col(f"x.runs.{c}").alias(c) for c in ("turn", "role", "digest", "seq", "n")]
    return rows.select("conv", *runs_of, *[F.col(f"x.{c}").alias(c) for c in ("before", "act", "tail")])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Repaired rows ``(conv, edit, role, text)`` of a stream sorted by run, edits first."""
    pending = None  # the role of a run whose text comes next, and what follows it
    for batch in batches:
        for conv, text, role, before, act, tail in zip(*(batch.column(c).to_pylist() for c in ("conv", "text", "role", "before", "act", "tail"))):
            if act is None:
                if pending is not None:
                    edit, role, tail = pending
                    yield conv, edit, role, text
                    for x in tail:
                        yield conv, "I", ROLES[x], ""
                    pending = None
                continue
            for x in before:
                yield conv, "I", ROLES[x], ""
            if act == "D":
                for x in tail:
                    yield conv, "I", ROLES[x], ""
            else:
                pending = ("K", role, tail) if act == "K" else ("R", ROLES[act], tail)


def _rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv", pa.string()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    now, n, out, size = None, 0, [], 0
    for k, row in enumerate(_stream(batches)):
        n = n + 1 if k and row[0] == now else 1
        now = row[0]
        out.append((row[0], n, *row[1:]))
        size += len(row[3])
        if len(out) >= 4096 or size > 1 << 24:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
            out, size = [], 0
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)


def _digests_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv", pa.string()), ("sha", pa.string())])
    now, digest, out = None, None, []

    def batch():
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    for conv, _, role, text in _stream(batches):
        if digest is None or conv != now:
            if digest is not None:
                out.append((now, digest.hexdigest()))
            now, digest = conv, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
        if len(out) >= 4096:
            yield batch()
            out.clear()
    if digest is not None:
        out.append((now, digest.hexdigest()))
    yield batch()


def _merged(rows: DataFrame, fixed: DataFrame) -> DataFrame:
    """Edits and texts, sorted by conversation and run, the edit before its texts."""
    none = F.lit(None).cast("string")
    change = edits(fixed).filter("act <> 'D' or before <> '' or tail <> ''")
    change = change.select(*_ORDER, F.lit(0).alias("kind"), none.alias("text"), "before", "act", "tail")
    texts = _with_digest(rows).filter(F.rtrim(F.col("text"), F.lit(S.WS_CHARS)) != "")
    texts = texts.select(*_ORDER, F.lit(1).alias("kind"), "text", *[none.alias(c) for c in ("before", "act", "tail")])
    both = change.unionByName(texts).repartition("conv").sortWithinPartitions(*_ORDER, "kind")
    return both.select("conv", "text", "role", "before", "act", "tail")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``(conv, position, edit, role, text)``."""
    fixed = repairs(runs(rows))
    return _merged(rows, fixed).mapInArrow(_rows_out, "conv string, position long, edit string, role string, text string")


def repair_report(conversations: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """Damages the conversations, repairs them and reports both per conversation."""
    rows = damage(conversations, conv_col, turn_col, role_col, text_col)
    found = runs(rows)
    fixed = repairs(found)

    def total(c: Column, name: str) -> Column:
        return F.sum(c).alias(name)

    fresh = ~F.col("blank") & ~F.col("repeat")
    counts = found.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        total(F.when(F.col("blank"), F.col("n")).otherwise(0), "blank"),
        total(F.when(F.col("repeat"), F.col("n")).when(fresh, F.col("n") - 1).otherwise(0), "duplicate"),
        total(F.when(fresh & F.col("truncated"), 1).otherwise(0), "truncated"),
    )
    # neighbours on both sides of a border between segments
    side = lambda at: F.element_at(F.col("runs.code"), at) % 4
    sides = fixed.select("conv", "seg", side(-1).alias("end"), side(1).alias("right"))
    sides = sides.withColumn("left", F.lag("end").over(Window.partitionBy("conv").orderBy("seg")))
    legal = F.concat(*[F.substring(F.lit(INITIALS), F.col(c) + 1, F.lit(1)) for c in ("left", "right")]).isin("su", "ua", "au")
    borders = sides.groupBy("conv").agg(total(F.when(F.col("left").isNotNull() & ~legal, 1).otherwise(0), "between"))
    walks = fixed.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"),
        total(F.col("cost"), "cost"),
        total(F.col("broken"), "broken"),
    )
    digests = _merged(rows, fixed).mapInArrow(_digests_out, "conv string, sha string")
    out = conversations.select(F.col(conv_col).alias("id")).distinct().withColumn("conv", F.col("id").cast("string"))
    for part in (counts, walks, borders, digests):
        out = _meet(out, part)

    def count(c: str | Column, name: str) -> Column:
        return F.coalesce(c, F.lit(0)).cast("long").alias(name)

    return out.select(
        F.col("id").alias(conv_col),
        *[count(c, c) for c in ("gaps", "blank", "duplicate", "truncated")],
        count(F.col("broken") + F.col("between"), "illegal"),
        count("cost", "cost"),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
