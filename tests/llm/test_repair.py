"""Conversation repair against all ways to edit a short conversation, in whole and in segments, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from chartmill.llm import repair

ROWS = "conv_id long, turn long, role string, text string, part int, key long, present string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], ROWS)


def brute(rows):
    """The best (cost, audit, lines) for (role, fault, text) rows, trying all edits with up to two inserts before each row."""
    best = None
    choices = [["D"] if fault in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for _, fault, _ in rows]
    inserts = ["", "u", "a", "uu", "ua", "au", "aa"]
    for edits in itertools.product(*choices):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            roles, audit, cost, lines = "", "", 0, []
            for n in range(len(rows) + 1):
                for x in added[n]:
                    roles, audit, cost = roles + x, audit + "I", cost + 3
                    lines.append({"u": "user:", "a": "assistant:"}[x])
                if n == len(rows):
                    break
                (role, fault, text), edit = rows[n], edits[n]
                audit += edit[0]
                if edit == "D":
                    cost += 4
                    continue
                name = role if edit == "K" else {"u": "user", "a": "assistant"}[edit[1]]
                cost += 3 * (edit != "K") + 3 * (fault == "truncated")
                roles += name[:1] or "-"
                lines.append(f"{name}:{text}")
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, lines
    return best


def plain(rows):
    """One conversation's row, from rows (turn, role, text) in any order; edits by a table over (row, state)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, told = set(), []
    for _, role, text in rows:
        stripped = text.strip(" \t\n\v\f\r")
        told.append((role, "blank" if not stripped else "duplicate" if (role, text) in seen else "" if stripped[-1] in ".!?" else "truncated", text))
        seen.add((role, text))
    inserts = {0: (2, "user:"), 1: (2, "user:"), 2: (3, "assistant:"), 3: (2, "user:")}
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def led(after):
        """Up to two inserts before what follows."""
        out = dict(after)
        for _ in range(2):
            for q, (z, line) in inserts.items():
                cost, audit, lines = out[z]
                out[q] = min(out[q], (cost + 3, "I" + audit, [line, *lines]))
        return out

    far = (10**9, "", [])
    best = led({0: (0, "", []), 1: far, 2: far, 3: (0, "", [])})
    for role, fault, text in reversed(told):
        now = {q: (best[q][0] + 4, "D" + best[q][1], best[q][2]) for q in range(4)}
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            for q in range(4):
                for initial, name, cost, edit in ((role[:1], role, 0, "K"), ("u", "user", 3, "R"), ("a", "assistant", 3, "R")):
                    if (q, initial) in steps:
                        c, audit, lines = best[steps[q, initial]]
                        now[q] = min(now[q], (c + cost + more, edit + audit, [f"{name}:{text}", *lines]))
        best = led(now)
    turns = [t for t, *_ in rows if t is not None]
    faults = [f for _, f, _ in told]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)), best[0][0], best[0][1], hashlib.sha256("\n".join(best[0][2]).encode()).hexdigest(),
    ), told, best[0][2]


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            mine += [row] * (2 if kind == 3 else 1)
    return out


def conversations(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 4, 6, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]) if rng.random() < 0.3 else ("system", "user", "assistant")[0 if not turn else 2 - turn % 2]
            text = rng.choice(["Yes.", "No!", "Well", "What?", " \t\n", "", None, "a. ", f"A longer text {turn}.", f"Another {rng.random()}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [(None, i, "user", "Hm.") for i in range(3)] + [(5, 2, "user", "Yes.")] * 3 + [(7000, 1, "user", "long " * 50_000)]
    return rows


def test_table_of_states_is_the_best_of_all():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 3, 3):
        for _ in range(12):
            rows = [(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"c{i}."])) for i in range(n)]
            (*_, cost, audit, digest), told, lines = plain(rows)
            want = brute(told)
            assert (cost, audit) == want[:2] and lines == want[2]
            found = repair.lightest([(r[:1], f) for r, f, _ in told], {q: (0, "") for q in repair.ENDS}, True)[repair.START]
            assert found == want[:2]


@pytest.mark.parametrize("segment", [256, 3, 1])
def test_repairs(spark, segment):
    rows = conversations(3)
    want = sorted(((conv, *plain(mine)[0]) for conv, mine in damage(rows).items()), key=str)
    decided, pieces = repair.repairs(repair.damaged(table(spark, rows).repartition(5)), segment)
    assert sorted((tuple(r) for r in decided.collect()), key=str) == want
    lines = {}
    for r in sorted(repair.repaired_rows(pieces).collect(), key=lambda r: r["place"]):
        assert r["edit"] in "KRI"
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(lines.get(w[0], [])).encode()).hexdigest() == w[-1] for w in want)
    for mine in lines.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(m[:1] for m in mine))


def test_long_conversation(spark):
    """One conversation of nearly all rows, with one text in a third of them, over many segments and parts."""
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["The same.", f"Other {i}.", f"Cut {i}"])) for i in range(6000)] + conversations(4, 20)[:40]
    rows = [r for r in rows if r[0] != 1 or r[2]]
    want = sorted(((conv, *plain(mine)[0]) for conv, mine in damage(rows).items()), key=str)
    # Small parts are not joined, so that the conversation lies in several.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = repair.segments(repair.damaged(table(spark, rows).repartition(5)))
        assert cut.agg(F.max("n")).first()[0] <= 256 and cut.where("conv_id = 1").select("part").distinct().count() > 1
        decided, _ = repair.repairs(repair.damaged(table(spark, rows).repartition(5)))
        assert sorted((tuple(r) for r in decided.collect()), key=str) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty(spark):
    nothing = table(spark, [(1, 1, "user", "a.")]).where("false")
    decided, pieces = repair.repairs(repair.damaged(nothing))
    assert decided.count() == 0 and pieces.count() == 0
