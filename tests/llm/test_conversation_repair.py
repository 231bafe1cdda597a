from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from eventtrails.llm import conversation_repair as R

SHAPE = re.compile(r"(s?(ua)+)?")


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))


def _faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _cheapest(rows, faults):
    """Brute force over whole strings: the least (cost, audit) for every state."""
    best = {"": (0, "", ())}  # initials so far, cut down to what matters

    def relax(now):
        for _ in range(3):
            for at, (c, s, out) in list(now.items()):
                who = "a" if at == "u" else "u"
                cand = (c + 5, s + "I", out + ((R.ROLES[who], ""),))
                if who not in now or cand[:2] < now[who][:2]:
                    now[who] = cand
        return now

    best = relax(best)
    for (_, _, role, text), fault in zip(rows, faults):
        nxt = {}

        def put(at, cand):
            if at not in nxt or cand[:2] < nxt[at][:2]:
                nxt[at] = cand

        for at, (c, s, out) in best.items():
            put(at, (c + 2, s + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if role[:1] == "s" and at == "" or role[:1] == "u" and at != "u" or role[:1] == "a" and at == "u":
                put(role[:1], (c + extra, s + "K", out + ((role, text),)))
            who = "a" if at == "u" else "u"
            put(who, (c + extra + 1, s + "R", out + ((R.ROLES[who], text),)))
        best = relax(nxt)
    return min(v for k, v in best.items() if k in ("", "a"))


def _expected(rows):
    out = {}
    damaged = _damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = _sorted([r for r in damaged if r[0] == conv])
        faults = _faults(mine)
        cost, audit, made = _cheapest(mine, faults)
        assert SHAPE.fullmatch("".join(r[0][0] for r in made))
        turns = [r[1] for r in mine if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{a}:{b}" for a, b in made).encode()).hexdigest(),
        )
    return out


def _frame(spark, rows):
    data = [(*r, 1, "x", 2, "y") for r in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, seg int, conv string, n int, digest string")


def _got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def _random_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and then", "  ", "", "Mm. \n", "x.y", "ok\x0b.", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "s", None, ""]
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest)):
            text = rng.choice(texts) if rng.random() < 0.5 else f"row {rng.randrange(50)}{rng.choice('.!? ')}"
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(roles), text))
    return rows


def test_report_equals_brute_force(spark):
    rows = _random_rows(1, 60, 14)
    rows += [(None, 3, "user", "Nobody asked."), (None, 1, "system", "Be brief.")] + [(900, 5, "user", "same.")] * 3
    assert _got(R.repair_report(_frame(spark, rows))) == _expected(rows)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_segments_of_one_conversation_agree(spark, monkeypatch, bits):
    monkeypatch.setattr(R, "SEGMENT_BITS", bits)
    rows = _random_rows(2 + bits, 5, 90)
    assert _got(R.repair_report(_frame(spark, rows))) == _expected(rows)


def test_walk_finds_the_least_string_of_all():
    # every string of edits of short conversations, tried one by one
    def strings(codes):
        for n_ins in itertools.product(range(3), repeat=len(codes) + 1):
            for acts in itertools.product("DKR", repeat=len(codes)):
                state, cost, s = 0, 0, ""
                ok = True
                for k, code in enumerate((*codes, None)):
                    for _ in range(n_ins[k]):
                        state, cost, s = R.WANTED[state], cost + 5, s + "I"
                    if code is None:
                        break
                    fault, who = divmod(code, 4)
                    a = acts[k]
                    if a == "D":
                        cost += 2
                    elif fault == R.DOOMED or a == "K" and R.KEEP[state][who] is None:
                        ok = False
                        break
                    else:
                        cost += (a == "R") + (5 if fault == R.TRUNCATED else 0)
                        state = R.KEEP[state][who] if a == "K" else R.WANTED[state]
                    s += a
                if ok and state in (0, 3):
                    yield cost, s

    rng = random.Random(5)
    for _ in range(150):
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3, 4, 5, 6, 9]) for _ in range(rng.randrange(1, 5)))
        before, acts, tail, cost, _ = R.walk(codes, 0, R.END, True)
        got = "".join("I" * len(b) + ("R" if a in R.ROLES else a) for b, a in zip(before, acts)) + "I" * len(tail)
        assert (cost, got) == min(strings(codes)), list(codes)


def test_checkpoints_are_few():
    codes = bytes(random.Random(0).choice([1, 2, 5, 9]) for _ in range(10_000))
    block, ends = R._checkpoints(codes, R.END)
    assert block == 100 and len(ends) == 100


def test_repaired_rows_read_as_conversations(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "assistant", "Fine."), (2, 0, "assistant", "Hm"), (3, 0, "system", "Be kind.")]
    got = R.repaired(R.as_rows(_frame(spark, rows))).orderBy("conv", "position").collect()
    assert [(r.conv, r.position, r.edit, r.role, r.text) for r in got] == [
        ("1", 1, "K", "user", "Again."),
        ("1", 2, "K", "assistant", "Fine."),
    ]


def test_empty_table_and_a_hot_conversation(spark):
    assert R.repair_report(_frame(spark, [(1, 0, "user", "x.")]).limit(0)).count() == 0
    base = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 5 == 0, "Same words.").otherwise(F.concat(F.lit("Words "), F.col("id"), F.lit("."))).alias("text"),
    )
    rows = [tuple(r) for r in base.filter("conv_id = 7").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in R.repair_report(base).filter("conv_id = 7").collect()}
    assert got == _expected(rows)


def test_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", "x" * 2_000_000 + "!")]
    assert _got(R.repair_report(_frame(spark, rows))) == _expected(rows)
