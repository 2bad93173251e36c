"""Repair of conversation structure as a lightest derivation, found with Knuth's agenda.

A conversation is sound if the initials of its roles match (s?(ua)+)?, no row is blank and none repeats an earlier one.  A
repair keeps, reroles or deletes each row and inserts rows of empty text.  Its audit is the initials of its edits in order, K, R,
D and I; the cheapest repair is taken, and of equally cheap ones that with the least audit.

Deductions.  An item (i, q) says: from row i on, starting in state q of the pattern, the conversation can be completed, at some cost
and with some audit.  Its rules put one edit in front of an item that is already derived: the weight of (i, q) by way of (j, r) is
(cost of the edit + cost of (j, r), initial + audit of (j, r)).  This is monotone, as both parts keep their order when
something is put in front, and an edit either costs something or leaves fewer rows to be done, so items are popped in
order of (cost, rows left to the right, audit) and are final when popped.

Segments.  The rows of a conversation, in order, are cut into segments of at most `segment` rows, wherever a task's share ends; so no task
holds a long conversation, and no other row of the engine is longer than a segment.  A segment whose conversation
neither began before nor goes on after it is solved at once.  For the others the same agenda gives the lightest way from each state
at the segment's start to each one at its end; inserts at a cut belong to the segment after it, so that of two audits of a segment neither is the beginning of the
other, and they compare alike whatever follows.  A conversation's segments are then chained from the last to the first, keeping only which
way is taken.

Order: by turn, null first, then role, then text; null roles and texts are one space here.  A blank row has no character but white space, a
duplicate has the role and text of an earlier row, a truncated one does not end in . ! or ?; the first of these counts.  Rows without conv_id are one
conversation.  Repeated rows are duplicates.  Other columns are ignored.  An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmill.llm.shared import in_arrow, row_key, written

SEGMENT = 256
BLANK, DUPLICATE, TRUNCATED, FINE = "blank", "duplicate", "truncated", ""
SPACE = " \t\n\v\f\r"
#: Characters of text in a segment before it is cut, and of rows put out together.
SEGMENT_CHARS, BATCH_CHARS = 1 << 23, 1 << 24
#: Rows are dealt into ranges by this much of their text.
PREFIX = 32

#: States of the pattern: nothing yet, after the system's row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ENDS = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
LEGAL = ("su", "ua", "au")


def edits(initial: str, fault: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) for a row in a state."""
    yield DELETE, COST[DELETE], state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    for role, after in STEPS[state].items():
        if role == initial:
            yield KEEP, COST[KEEP] + more, after
        if role in NAMES:
            yield REROLE, COST[REROLE] + more, after


def lightest(rows: list[tuple[str, str]], goals: dict[int, tuple[int, str]], closing: bool) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) from each state before the rows, (initial, fault) each, to one of the goals: weights of
    states after them.  Inserts after the last row are only made if `closing`."""
    n = len(rows)
    # What an item (i, q) helps to derive: the same edges as `edits` gives, from their far end.
    agenda = [(cost, 0, audit, n, q) for q, (cost, audit) in goals.items()]
    heapq.heapify(agenda)
    final: dict[tuple[int, int], tuple[int, str]] = {}
    into = [[(q, edit, cost) for q in STEPS for edit, cost, after in edits(*row, q) if after == r] for row in rows for r in STEPS]
    waits = [[(q, INSERT, COST[INSERT]) for q, steps in STEPS.items() for role, after in steps.items() if after == r and role in NAMES] for r in STEPS]
    while agenda:
        cost, left, audit, i, r = heapq.heappop(agenda)
        if (i, r) in final:
            continue
        final[i, r] = cost, audit
        if i:
            for q, edit, more in into[(i - 1) * 4 + r]:
                if (i - 1, q) not in final:
                    heapq.heappush(agenda, (cost + more, left + 1, edit + audit, i - 1, q))
        if i < n or closing:
            for q, edit, more in waits[r]:
                if (i, q) not in final:
                    heapq.heappush(agenda, (cost + more, left, edit + audit, i, q))
    return {q: final[0, q] for q in STEPS if (0, q) in final}


def applied(rows: list[tuple[str, str]], audit: str, state: int) -> Iterator[tuple[str, str, int | None]]:
    """(edit, role, row) for each edit of an audit that starts in `state`; role is that of a kept row, row is None for an
    inserted one."""
    at = 0
    for edit in audit:
        if edit == INSERT:
            role = next(r for r in STEPS[state] if r in NAMES)
            state = STEPS[state][role]
            yield edit, NAMES[role], None
            continue
        own = rows[at][0]
        if edit == DELETE:
            yield edit, own, at
        elif edit == KEEP:
            state = STEPS[state][own[:1]]
            yield edit, own, at
        else:
            role = next(r for r in STEPS[state] if r in NAMES)
            state = STEPS[state][role]
            yield edit, NAMES[role], at
        at += 1


def closing_ways() -> dict[int, tuple[int, str]]:
    """What each state after the last row still costs."""
    return lightest([], {q: (0, "") for q in ENDS}, True)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present) after damage by crc32(conv_id:turn) mod 20: 0 drops a row, 1 empties its text,
    2 takes its . ! and ? away, 3 repeats it, 4 makes it the user's.  Dropped rows stay as such, so that their
    conversation is known."""
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


SEGMENTS = """conv_id long, part int, seg int, whole boolean, n long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string,
first_turn long, last_turn long, turns long, ways array<struct<start:int,goal:int,cost:long,audit:string>>, messages array<struct<role:string,text:string,fault:string>>"""
WAY = pa.list_(pa.struct([("start", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
MESSAGE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("fault", pa.string())]))
SEGMENT_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3, WAY, MESSAGE]
SEGMENT_NAMES = [line.split()[0] for line in SEGMENTS.replace("\n", " ").split(", ")]


def ways_of(rows: list[tuple[str, str]], whole: bool) -> list[dict]:
    if whole:
        cost, audit = lightest(rows, {q: (0, "") for q in ENDS}, True)[START]
        return [{"start": START, "goal": ASSISTANT, "cost": cost, "audit": audit}]
    return [{"start": q, "goal": goal, "cost": cost, "audit": audit} for goal in STEPS for q, (cost, audit) in lightest(rows, {goal: (0, "")}, False).items()]


def fault_of(text: str, repeated: bool) -> str:
    told = text.strip(SPACE)
    if not told:
        return BLANK
    return DUPLICATE if repeated else FINE if told[-1] in ".!?" else TRUNCATED


def segment_row(conv_id: int | None, part: int, seg: int, whole: bool, rows: list[tuple[int | None, str, str, str]]) -> list:
    """A row of `SEGMENTS` from (turn, role, text, fault)."""
    initials, faults, turns = [r[1][:1] for r in rows], [r[3] for r in rows], [r[0] for r in rows if r[0] is not None]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return [
        conv_id, part, seg, whole, len(rows), *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, initials[0] if rows else None, initials[-1] if rows else None,
        turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), ways_of(list(zip(initials, faults, strict=True)), whole),
        [{"role": r[1], "text": r[2], "fault": r[3]} for r in rows],
    ]


def in_batches(rows: Iterator[list], types: list, names: list[str], size) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += size(row)
        if chars >= BATCH_CHARS or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Rows (conv_id, turn, role, text, present) cut into segments, in order of (part, seg) in each conversation."""
    keyed = rows.withColumns({"key": row_key("role", "text"), "prefix": F.substring("text", 1, PREFIX)})
    # Rows that repeat one of an earlier turn come as marks, sorted before the row itself: so texts are moved only once, and no
    # join is on a text that may be in a third of all rows.
    told = keyed.where("present").select("conv_id", "turn", "role", "prefix", "key").distinct()
    told = written(told, "told")
    first = told.groupBy("conv_id", "key").agg(F.min(F.struct("turn")).alias("first")).select(F.col("conv_id").alias("c"), F.col("key").alias("k"), F.col("first.turn").alias("t"))
    marks = told.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")) & F.col("turn").eqNullSafe(F.col("t")), "left_anti")
    order = ["conv_id", "turn", "role", "prefix"]
    columns = [*order, "mark", "text", "present", "key.a", "key.b"]
    both = keyed.withColumn("mark", F.lit(False)).select(*columns).unionByName(marks.withColumns({"mark": F.lit(True), "text": F.lit(""), "present": F.lit(True)}).select(*columns))
    ordered = both.repartitionByRange(*order).sortWithinPartitions(*order, F.desc("mark"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        from pyspark import TaskContext

        part, seg, runs, cuts, conv, held, chars = TaskContext.get().partitionId(), 0, 0, 0, None, [], 0
        place, marked, last = None, set(), None
        for batch in batches:
            for conv_id, turn, role, prefix, mark, text, present, a, b in zip(*(batch.column(i).to_pylist() for i in range(9)), strict=True):
                if not runs or conv_id != conv:
                    if runs:
                        # The first and the last conversation of a part may go on in another one.
                        yield segment_row(conv, part, seg, runs > 1 and not cuts, held)
                    conv, runs, cuts, seg, held, chars, last = conv_id, runs + 1, 0, seg + 1, [], 0, None
                if (conv_id, turn, role, prefix) != place:
                    place, marked = (conv_id, turn, role, prefix), set()
                if mark:
                    marked.add((a, b))
                    continue
                if not present:
                    continue
                if len(held) >= segment or chars >= SEGMENT_CHARS:
                    yield segment_row(conv, part, seg, False, held)
                    cuts, seg, held, chars = cuts + 1, seg + 1, [], 0
                held.append((turn, role, text, fault_of(text, (a, b) in marked or last == (turn, role, text))))
                chars, last = chars + len(text), (turn, role, text)
        if runs:
            yield segment_row(conv, part, seg, False, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(cut(batches), SEGMENT_TYPES, SEGMENT_NAMES, lambda r: sum(len(m["text"]) + 64 for m in r[-1]))

    return written(in_arrow(ordered, run, SEGMENTS), "segments")


CHAINED = "conv_id long, part int, seg int, start int, goal int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def chained(parted: DataFrame) -> DataFrame:
    """For conversations in several segments: the states that each segment leads from and to and the inserts after the
    last one (`tail`), and one row (part null) with what is counted over the conversation."""
    rows = parted.select("conv_id", "part", "seg", "n", "blank", "duplicate", "truncated", "illegal", "first_role", "last_role", "first_turn", "last_turn", "turns", "ways")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seg"))

    def chain(found: Iterator[tuple]) -> Iterator[list]:
        """One conversation, its segments from the last to the first; of each only the choice by state is kept."""
        tails = closing_ways()
        tail_ranks = sorted({a for _, a in tails.values()})
        after = {q: (cost, tail_ranks.index(audit)) for q, (cost, audit) in tails.items()}
        choices, sums, turns, later, low, high, distinct = [], [0] * 4, None, None, None, None, 0
        conv_id = None
        for conv_id, part, seg, n, *counts, first_role, last_role, first_turn, last_turn, own_turns, ways in found:
            if not n:
                continue
            sums = [a + b for a, b in zip(sums, counts, strict=True)]
            sums[3] += later is not None and last_role + later not in LEGAL
            later = first_role
            if first_turn is not None:
                distinct += own_turns - (turns == last_turn)
                high = last_turn if high is None else high
                low = turns = first_turn
            best = {}
            for way in ways:
                cost, rank = after.get(way["goal"], (None, None))
                if cost is not None:
                    told = (way["cost"] + cost, way["audit"], rank, way["goal"])
                    best[way["start"]] = min(best.get(way["start"], told), told)
            ranks = sorted({(b[1], b[2]) for b in best.values()})
            after = {q: (b[0], ranks.index((b[1], b[2]))) for q, b in best.items()}
            choices.append((part, seg, {q: b[3] for q, b in best.items()}))
        state = START
        for nr, (part, seg, goals) in enumerate(reversed(choices)):
            goal = goals[state]
            yield [conv_id, part, seg, state, goal, tails[goal][1] if nr == len(choices) - 1 else "", *[None] * 6]
            state = goal
        gaps = 0 if low is None else high - low + 1 - distinct
        yield [conv_id, None, None, None, None, None, gaps, *sums, after[START][0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        told = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        types = [pa.int64(), *[pa.int32()] * 4, pa.string(), *[pa.int64()] * 6]
        chains = (row for _, group in groupby(told, key=lambda r: r[0]) for row in chain(group))
        return in_batches(chains, types, [c.split()[0] for c in CHAINED.split(", ")], lambda r: 64)

    return written(in_arrow(rows, run, CHAINED), "chained")


PIECES = "conv_id long, part int, seg int, audit string, counts array<long>, repaired array<struct<edit:string,role:string,text:string>>"


def edited(pieces: DataFrame) -> DataFrame:
    """(conv_id, part, seg, audit, counts, repaired) from rows (conv_id, part, seg, audit, counts, start, messages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list]:
            for batch in batches:
                for *named, start, messages in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    told = [(m["role"], m["fault"]) for m in messages]
                    out = [{"edit": e, "role": role, "text": "" if at is None else messages[at]["text"]} for e, role, at in applied(told, named[3], start) if e != DELETE]
                    yield [*named, out]

        types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))]
        return in_batches(rows(), types, ["conv_id", "part", "seg", "audit", "counts", "repaired"], lambda r: sum(len(m["text"]) + 64 for m in r[-1]))

    return in_arrow(pieces.select("conv_id", "part", "seg", "audit", "counts", "start", "messages"), run, PIECES)


def lines_of(repaired: Column) -> Column:
    return F.array_join(F.transform(repaired, lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")


def repairs(rows: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """What is counted and decided for each conversation, one row each: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256; and the repaired conversations in pieces (conv_id, part, seg, audit, repaired), in this order."""
    cut = segments(rows, segment)
    only, parted = cut.where("whole"), cut.where("not whole")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    way = F.col("ways")[0]
    counts = F.array(gaps, "blank", "duplicate", "truncated", "illegal", way["cost"])
    single = written(edited(only.withColumns({"start": way["start"], "audit": way["audit"], "counts": counts})), "single")
    chains = chained(parted)
    taken = chains.where("part is not null").select(F.col("part").alias("p"), F.col("seg").alias("s"), "start", "goal", "tail")
    met = parted.join(taken, (F.col("part") == F.col("p")) & (F.col("seg") == F.col("s")))
    own = F.filter("ways", lambda w: (w["start"] == F.col("start")) & (w["goal"] == F.col("goal")))[0]["audit"]
    pieces = written(edited(met.withColumns({"audit": F.concat(own, "tail"), "counts": F.lit(None).cast("array<long>")})), "pieces")
    first = single.select("conv_id", *(F.col("counts")[i].alias(c) for i, c in enumerate(COUNTS)), "audit", F.sha2(lines_of(F.col("repaired")), 256).alias("repaired_sha256"))
    sums = chains.where("part is null").select("conv_id", *COUNTS)
    last = sums.join(joined(pieces), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    last = last.select("conv_id", *COUNTS, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
    return first.unionByName(last), single.unionByName(pieces).drop("counts")


def joined(pieces: DataFrame) -> DataFrame:
    """(c, audit, repaired_sha256) of conversations in several pieces.  A digest is taken over a text from its beginning to its
    end, so one task reads a conversation's pieces, one after the other; it holds one at a time."""
    rows = pieces.select("conv_id", "part", "seg", "audit", F.size("repaired").alias("n"), lines_of(F.col("repaired")).alias("lines"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        def told() -> Iterator[list]:
            flat = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for conv_id, group in groupby(flat, key=lambda r: r[0]):
                audits, digest, begun = [], hashlib.sha256(), False
                for _, _, _, audit, n, lines in group:
                    audits.append(audit)
                    if n:
                        digest.update((b"\n" if begun else b"") + lines.encode("utf-8", "surrogatepass"))
                        begun = True
                yield [conv_id, "".join(audits), digest.hexdigest()]

        return in_batches(told(), [pa.int64(), pa.string(), pa.string()], ["c", "audit", "repaired_sha256"], lambda r: len(r[1]))

    return in_arrow(rows, run, "c long, audit string, repaired_sha256 string")


def repaired_rows(pieces: DataFrame) -> DataFrame:
    """The repaired conversations, one row a message: conv_id, place (part, seg, number), edit, role, text."""
    rows = pieces.select("conv_id", "part", "seg", F.posexplode("repaired").alias("number", "m"))
    return rows.select("conv_id", F.struct("part", "seg", "number").alias("place"), "m.edit", "m.role", "m.text")
