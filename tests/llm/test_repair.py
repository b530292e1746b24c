"""Conversation repair: brute force over all edits, a plain dynamic programme,
blocks of any size, odd rows, digests."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from viewtally.llm import chat_repair as C

SF = "/root/testdata/sf0.01"
GOOD = re.compile(r"(s?(ua)+)?")


def brute(initials, faults, most=4):
    """Least (cost, audit) over every row edit and every way to insert."""
    best = None
    rows = [[("D", 2, "")] if f == "x" else
            [("D", 2, ""), ("K", 5 * (f == "t"), i), *(("R", 1 + 5 * (f == "t"), r) for r in "ua")]
            for i, f in zip(initials, faults)]
    gaps = [list(itertools.chain.from_iterable(itertools.product("ua", repeat=k) for k in range(most + 1)))] * (len(rows) + 1)
    for edits in itertools.product(*rows):
        cost = sum(e[1] for e in edits)
        if best and cost > best[0]:
            continue
        for ins in itertools.product(*gaps):
            n = sum(map(len, ins))
            if n > most or best and cost + 5 * n > best[0]:
                continue
            roles = "".join("".join(a) + e[2] for a, e in zip(ins, (*edits, ("", 0, ""))))
            if GOOD.fullmatch(roles):
                audit = "".join("I" * len(a) + e[0] for a, e in zip(ins, (*edits, ("", 0, ""))))
                best = min(best or (99, ""), (cost + 5 * n, audit))
    return best


def test_lightest_derivation_is_the_least_repair():
    rng = random.Random(1)
    for n in range(4):
        for _ in range(1 + 6 * n):
            i = "".join(rng.choice("sua-") for _ in range(n))
            f = "".join(rng.choice("...tx") for _ in range(n))
            assert C.solve(i, f)[C.EMPTY, C.DONE] == brute(i, f, 2), (i, f)


def plain(initials, faults):
    """The same by sweeping the rows, without an agenda."""
    inf = (1 << 60, "")
    insert = lambda now: [min([now[q]] + [(now[p][0] + 5 * k, now[p][1] + "I" * k) for p, k in ways]) for q, ways in enumerate(
        ([], [], [(0, 1), (1, 1), (3, 1)], [(0, 2), (1, 2), (2, 1)]))]
    now = [(0, ""), inf, inf, inf]
    for i, f in zip(initials, faults):
        new = [inf] * 4
        for q, (c, a) in enumerate(insert(now)):
            for cost, letter, left in C._edits(i, f):
                r = C.STEP.get((q, left), -1) if left else q
                if r >= 0:
                    new[r] = min(new[r], (c + cost, a + letter))
        now = new
    now = insert(now)
    return min(now[C.EMPTY], now[C.DONE])


@pytest.mark.parametrize("block", [1, 3, 8])
def test_blocks_join_to_the_whole(block):
    rng = random.Random(block)
    for _ in range(150):
        n = rng.randrange(1, 40)
        i, f = "".join(rng.choice("ssuuuaaa-") for _ in range(n)), "".join(rng.choice("....tx") for _ in range(n))
        parts = [C.solve(i[k:k + block], f[k:k + block], tuple(range(4)) if k else (C.EMPTY,), False) for k in range(0, n, block)]
        while len(parts) > 1:
            parts = [C.join_paths(parts[k:k + 3]) for k in range(0, len(parts), 3)]
        assert C.close(parts[0]) == C.solve(i, f)[C.EMPTY, C.DONE] == plain(i, f)


def oracle(rows):
    """The contract's columns of one damaged conversation, told row by row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else ".")
        seen.add((role, text))
    initials = "".join(r[1][:1] if r[1][:1] in tuple("sua") else "-" for r in rows)
    cost, audit = plain(initials, "".join("x" if x in "bd" else x for x in faults))
    turns = [t for t, _, _ in rows if t is not None]
    kept, at, left = [], 0, -((len(audit) - audit.count("D")) % 2)
    for letter in audit:
        role, text = (None, "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter != "D":
            kept.append(f"{role if letter == 'K' else ('user', 'assistant')[left % 2]}:{text}")
            left += 1
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(initials[k:k + 2] not in ("su", "ua", "au") for k in range(len(rows) - 1)), cost, audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest())


def damage(rows):
    out, told = {}, lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        code, role, text = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20, told(role), told(text)
        out.setdefault(conv, [])
        row = (turn, "user" if code == 4 else role,
               "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text)
        out[conv] += [] if code == 0 else [row] * (1 + (code == 3))
    return out


def columns(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.mark.parametrize("block, fan", [(512, 16)])
def test_repair_equals_the_rule(spark, block, fan):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    want = {c: oracle(rows) for c, rows in damage([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]).items()}
    assert columns(C.repair_damaged(turns, block, fan)) == want


@pytest.mark.parametrize("block, fan", [(3, 4)])
def test_odd_conversations(spark, block, fan):
    rows = [(1, None, "user", "Hm."), (1, 3, None, None), (1, 3, "assistant", "x" * 200_000), (1, 9, "user", "a\n.\n "),
            (None, 1, "user", "A."), (None, 2, "user", "A."), (None, None, "assistant", "B!"),
            (2, 1, "tool", "T."), (2, 2, "system", "S."), (2, 3, "", "E."), (-5, 0, "user", " \t\n"),
            *((7, t, ("user", "assistant")[t % 2], f"t {t}.") for t in range(60)),
            *((8, t, "user", "same.") for t in range(40))]
    rows += [(11, t, r, x) for t, (r, x) in enumerate([("user", "Q?"), ("assistant", "no end")] * 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumns({"cost": F.lit("x"), "_c": F.lit(1), "blk": F.lit(2)})
    want = {c: oracle(r) for c, r in damage(rows).items()}
    got = columns(C.repair_damaged(df, block, fan))
    assert got == want and got[8][6].count("D") > 30
    # a conversation that the damage drops whole keeps its id
    gone = next(k for k in range(10 ** 6) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    none = C.repair_damaged(spark.createDataFrame([(gone, 0, "user", "x.")], "conv_id long, turn long, role string, text string"))
    assert columns(none) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert C.repair_damaged(df.limit(0)).count() == 0


def test_edits_are_the_repaired_turns(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "user", "U."), (1, 3, "user", "U.")]
    conversations, edits = C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    [c] = conversations.collect()
    told = [(r.seq, r.edit, r.turn, r.role, r.text) for r in edits.orderBy("seq").collect()]
    assert (c.n_turns, c.duplicate, c.audit) == (4, 1, "".join(t[1] for t in told))
    assert GOOD.fullmatch("".join(t[3][0] for t in told if t[1] != "D"))
    assert c.cost == brute("sauu", "...x")[0]
