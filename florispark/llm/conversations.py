"""Conversation structure repair by Hirschberg's divide and conquer over a four-state grammar.

A repaired conversation's roles read (s?(ua)+)?, by their initials.  Edits keep a row, give it another
role, delete it, or insert an empty one before it; the cheapest sequence of edits is wanted, and of equally cheap ones
that whose initials are the least as text.  The grammar has four states: nothing yet, after system,
after user, after assistant.  For a stretch of rows, the forward vector has for each state the least cost of
getting there, and the order of the least audits among the states; the backward vector has the least cost from each state to the end.
Where they meet, in the middle, the crossing is the state of least total cost, and of these that whose audit up to there is the least.  Audits up to the same row
end in that row's edit, so none of them begins another, and what comes after can't change their order.  Both halves
are solved alike, down to single rows, in space that grows with the rows.

Conversations may be of any length.  Rows are dealt by ranges of their order and cut in blocks of
BLOCK rows.  A block is summed up by the cheapest ways from each state to each state.  Per conversation the
blocks' summaries are crossed in the same manner, which gives each block its first and last state; then each block is
solved inside.  Text takes no part in this; it is read again, in order and as a stream, when rows are written or hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import cut, stored

# fixed values: what a word's character is, how a sentence ends, and what edits cost
CHAR = r"[^\x20\x09-\x0D]"
END = r"[.!?]"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK_BITS = 12

INF = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
_BY_INITIAL = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
# what a user or assistant row may be from each state, and what has to follow at the end
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
INITIALS = "sua"  # a row's code: its role's initial (3: another), 4 more if truncated; 8: it has to go
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

Path = tuple[int, str | int]


@cache
def steps(code: int) -> tuple[tuple[Path, ...], ...]:
    """For a row of this code, from each state (rows) to each (columns): the least cost and, of its audits, the least; they end in the row's edit."""
    out = [[(INF, "")] * 4 for _ in range(4)]
    for begin in range(4):
        state, before, cost = begin, "", 0
        for _ in range(4):  # more insertions come back to a state that was there
            ways = [(state, DELETE, "D")]
            if code < 8:
                extra = TRUNCATED * (code // 4)
                initial = (INITIALS + "-")[code % 4]
                if initial in _BY_INITIAL[state]:
                    ways.append((_BY_INITIAL[state][initial], extra, "K"))
                ways.append((NEXT[state], REROLE + extra, "R"))
            for to, price, letter in ways:
                out[begin][to] = min(out[begin][to], (cost + price, before + letter))
            state, before, cost = NEXT[state], before + "I", cost + INSERT
    return tuple(map(tuple, out))


def normal(code: int) -> int:
    """A row that has to go is the same whoever said it."""
    return 8 if code & 8 else code


def forward(start: int, stretch: Sequence[Sequence[Sequence[Path]]]) -> tuple[list[int], list[int]]:
    """From a state over steps: each state's least cost, and its rank among the states by least audit.

    A step is of a row, with audits, or of a block, with what orders its audits from one state.
    """
    cost, rank = [INF] * 4, [4] * 4
    cost[start], rank[start] = 0, 0
    for step in stretch:
        # ways from different states differ before this step and go by rank, those from one state by this step
        best = [min((min(cost[a] + step[a][b][0], INF), rank[a], step[a][b][1]) for a in range(4)) for b in range(4)]
        order = sorted((r, s, b) for b, (c, r, s) in enumerate(best) if c < INF)
        cost, rank = [c for c, _, _ in best], [4] * 4
        for i, (_, _, b) in enumerate(order):
            rank[b] = i
    return cost, rank


def backward(stretch: Sequence[Sequence[Sequence[Path]]], end: Sequence[int]) -> list[int]:
    """Least costs from each state over the steps to the costs at the end."""
    cost = list(end)
    for step in reversed(stretch):
        cost = [min(INF, *(step[a][b][0] + cost[b] for b in range(4))) for a in range(4)]
    return cost


def crossing(front: tuple[list[int], list[int]], back: Sequence[int]) -> int:
    """The state in which the audit-least of the cheapest ways crosses."""
    return min(range(4), key=lambda q: (min(front[0][q] + back[q], INF), front[1][q]))


def solve(stretch: Sequence[Sequence[Sequence[Path]]], start: int, end: Sequence[int]) -> list[tuple[int, int]]:
    """The states (before, after) of each step of the audit-least cheapest way from a state to the costs at the end."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(stretch), start, list(end))]  # halves in order, the first on top
    while todo:
        low, high, state, to = todo.pop()
        if high - low == 1:
            last = crossing(forward(state, stretch[low:high]), to)
            out.append((state, last))
        elif high > low:
            mid = (low + high) // 2
            back = backward(stretch[mid:high], to)
            meet = crossing(forward(state, stretch[low:mid]), back)
            only = [0 if q == meet else INF for q in range(4)]
            todo += [(mid, high, meet, to), (low, mid, state, only)]
    return out


def audit_of(codes: Sequence[int], start: int, end: int) -> str:
    """The audit of a block's rows between two states."""
    stretch = [steps(normal(c)) for c in codes]
    return "".join(stretch[i][a][b][1] for i, (a, b) in enumerate(solve(stretch, start, [0 if q == end else INF for q in range(4)])))


TAIL_COST = [INSERT * len(TAIL[q]) for q in range(4)]

_SUMMARY = "conv_id long, block long, costs array<bigint>, ranks array<int>, illegal long, first int, last int"
_LEGAL = {(0, 1), (1, 2), (2, 1)}  # su, ua, au
_PART = "conv_id long, block long, start int, audit string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (conv_id, block, codes): from each state to each, least cost and rank; illegal neighbours; the initials at the ends."""
    for batch in batches:
        rows = []
        for codes in batch.column(2).to_pylist():
            stretch, initial = [steps(normal(c)) for c in codes], [c & 3 for c in codes]
            cost, rank = zip(*(forward(a, stretch) for a in range(4)), strict=True)
            rows.append((sum(cost, []), sum(rank, []), sum(p not in _LEGAL for p in zip(initial[:-1], initial[1:], strict=True)), initial[0], initial[-1]))
        kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))], names=["conv_id", "block", "costs", "ranks", "illegal", "first", "last"])


_CROSSED = "conv_id long, blocks array<bigint>, starts array<int>, ends array<int>, cost long, illegal long"


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (conv_id, its blocks' summaries in order): first and last state of each block, the cost, and the illegal neighbours."""
    for batch in batches:
        rows = []
        for blocks in batch.column(1).to_pylist():
            stretch = [[[(b["costs"][4 * x + y], b["ranks"][4 * x + y]) for y in range(4)] for x in range(4)] for b in blocks]
            states = solve(stretch, START, TAIL_COST)
            cost = sum(stretch[i][x][y][0] for i, (x, y) in enumerate(states)) + TAIL_COST[states[-1][1]]
            illegal = sum(b["illegal"] for b in blocks) + sum((a["last"], b["first"]) not in _LEGAL for a, b in zip(blocks[:-1], blocks[1:], strict=True))
            rows.append(([b["block"] for b in blocks], [x for x, _ in states], [y for _, y in states], cost, illegal))
        kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))], names=["conv_id", "blocks", "starts", "ends", "cost", "illegal"])


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (conv_id, block, codes, start, end): the block's audit."""
    for batch in batches:
        made = [audit_of(codes, a, b) for codes, a, b in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(made, pa.string())], names=["conv_id", "block", "start", "audit"])


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by CRC-32 of `conv_id:turn`, modulo 20: 0 drops the row, 1 empties its text, 2 takes out
    ends of sentences, 3 repeats it, 4 makes it the user's.  Nulls in role and text, and in what is hashed, are one space."""
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))))
    kind = F.crc32(F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn"))).cast("binary")) % 20
    rows = rows.withColumn("__kind", kind).where("__kind <> 0")
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", END, "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("__time")).drop("__time")


class Repair:
    """The repair of a table of (conv_id, turn, role, text): rows in order, their faults, and each block's audit.

    Rows of a conversation are in order of turn, those without turn first; rows of one turn in
    order of role and text.  Nulls in role and text count as one space.  Rows without conv_id are one
    conversation.  An empty table has no conversation.  Other columns are ignored.
    """

    def __init__(self, conversations: DataFrame):
        rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
        order = ["conv_id", "turn", "role", "text"]
        rows, _ = stored(rows, "conversations")  # once for the ranges, once for the rows
        at = F.monotonically_increasing_id().alias("at")
        ordered = rows.repartitionByRange(common.partitions(rows), *order).sortWithinPartitions(*order).select("*", at)
        # two 64-bit hashes tell what is said, by whom and in which conversation
        said = (F.xxhash64("conv_id", "role", "text").alias("h1"), F.xxhash64(F.lit("again"), "text", "role", "conv_id").alias("h2"))
        self.rows, _ = stored(ordered.select("*", *said), "conversations-in-order")
        initial = F.substring("role", 1, 1)
        code = F.coalesce(*(F.when(initial == x, i) for i, x in enumerate(INITIALS)), F.lit(3))
        blank, ended = ~F.col("text").rlike(CHAR), F.col("text").rlike(END + r"[\x20\x09-\x0D]*\z")
        narrow = self.rows.select("conv_id", "turn", "at", "h1", "h2", code.alias("initial"), blank.alias("blank"), ended.alias("ended"))
        # those who said the same before: one row for what is said more than once, then a join that Spark may split
        twice = narrow.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        told = narrow.join(twice, ["h1", "h2"], "left").withColumn("said", ~F.col("blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
        truncated = ~F.col("blank") & ~F.col("said") & ~F.col("ended")
        gone = F.col("blank") | F.col("said")
        told = told.withColumn("code", (F.col("initial") + F.when(truncated, 4).otherwise(0) + F.when(gone, 8).otherwise(0)).cast("int")).withColumn("truncated", truncated)
        block = F.shiftright("at", BLOCK_BITS).alias("block")
        per = told.groupBy("conv_id", block).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]).alias("codes"),  # 4,096 rows at most
            *(F.count_if(c).alias(c) for c in ("blank", "said", "truncated")),
        )
        self.blocks = cut(per)
        summaries = self.blocks.select("conv_id", "block", "codes").mapInArrow(_summaries, _SUMMARY)
        lists = summaries.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "costs", "ranks", "illegal", "first", "last"))).alias("blocks"))
        self.crossed = cut(lists.mapInArrow(_cross, _CROSSED))
        states = self.crossed.select("conv_id", F.explode(F.arrays_zip("blocks", "starts", "ends")).alias("x")).select("conv_id", F.col("x.blocks").alias("block"), F.col("x.starts").alias("start"), F.col("x.ends").alias("end"))
        same = states.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "start", "end")
        solved = self.blocks.join(same, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))).select("conv_id", "block", "codes", "start", "end")
        self.audits = cut(solved.mapInArrow(_audits, _PART))
        last = F.array_max(F.arrays_zip(F.col("blocks"), F.col("ends")))["ends"]
        tail = F.element_at(F.create_map(*(F.lit(x) for q in range(4) for x in (q, TAIL[q]))), last)
        self.tails = self.crossed.select("conv_id", F.array_max("blocks").alias("block"), last.alias("start"), tail.alias("audit"))

    def per_conversation(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation that has rows."""
        whole = self.audits.withColumn("tail", F.lit(0)).unionByName(self.tails.withColumn("tail", F.lit(1)))
        audit = whole.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "tail", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        faults = self.blocks.groupBy("conv_id").agg(*(F.sum(a).alias(b) for a, b in (("blank", "blank"), ("said", "duplicate"), ("truncated", "truncated"))))
        gaps = self.rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps")).withColumn("gaps", F.coalesce("gaps", F.lit(0)))
        out = self.crossed.select("conv_id", "illegal", "cost")
        for other in (audit, faults, gaps):
            out = out.join(other.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
        return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def _replayed(self, keys: list[str], run, schema: str) -> DataFrame:
        """Audits and rows brought together by keys and run through in order, as a stream: no group is held."""
        blank = lambda **have: [(F.lit(None).cast(t) if c not in have else have[c]).alias(c) for c, t in (("role", "string"), ("text", "string"), ("start", "int"), ("audit", "string"))]
        rows = self.rows.select("conv_id", F.shiftright("at", BLOCK_BITS).alias("block"), F.lit(1).alias("kind"), "at", *blank(role=F.col("role"), text=F.col("text")))
        audits = self.audits.select("conv_id", "block", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), *blank(start=F.col("start"), audit=F.col("audit")))
        tails = self.tails.select("conv_id", "block", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("at"), *blank(start=F.col("start"), audit=F.col("audit")))
        parts = max(common.partitions(self.rows), 1)
        return rows.union(audits).union(tails).repartition(parts, *keys).sortWithinPartitions("conv_id", "block", "kind", "at").mapInArrow(run, schema)

    def digests(self) -> DataFrame:
        """(conv_id, repaired_sha256): SHA-256 of each repaired conversation's `role:text` lines, joined by newlines.

        A hash takes a conversation's rows one after another, so one task reads all of it; it holds none of it.
        """
        return self._replayed(["conv_id"], _hashed, "conv_id long, repaired_sha256 string")

    def repaired(self) -> DataFrame:
        """(conv_id, place, role, text, edit) of the rows that stay or are inserted: place orders them in their conversation; long conversations are dealt by block."""
        return self._replayed(["conv_id", "block"], _written, "conv_id long, place long, role string, text string, edit string")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, place, role, text, edit) of rows that are left or inserted, and without role and text of those that aren't; audits stand before their rows."""
    state, edits, place = START, iter(""), 0
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("conv_id", "block", "kind", "role", "text", "start", "audit")), strict=True):
            conv, block, kind, role, text, start, audit = (x.as_py() for x in row)
            if kind == 0:
                state, edits, place = start, iter(audit), block << (BLOCK_BITS + 3)  # a row has three insertions before it at most
                continue
            for letter in audit if kind == 2 else edits:
                place += 1
                if letter == "I":
                    state = NEXT[state]
                    yield conv, place, ROLE_OF[state], "", letter
                    continue
                if letter == "D":
                    yield conv, place, None, None, letter
                else:
                    state = NEXT[state] if letter == "R" else _BY_INITIAL[state][role[0]]
                    yield conv, place, ROLE_OF[state] if letter == "R" else role, text, letter
                break


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string()))
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])
    held, size = [], 0
    for row in _replay(batches):
        if row[2] is None:
            continue
        held.append(row)
        size += len(row[3]) + 64
        if size >= 1 << 20:
            yield pack(held)
            held, size = [], 0
    yield pack(held)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["conv_id", "repaired_sha256"])
    done, known, digest, some = [], False, hashlib.sha256(), False
    now = None
    for conv, _, role, text, _ in _replay(batches):
        if not known or conv != now:
            if known:
                done.append((now, digest.hexdigest()))
            if len(done) >= 10_000:
                yield pack(done)
                done = []
            known, now, digest, some = True, conv, hashlib.sha256(), False
        if role is not None:
            digest.update(f"{'\n' if some else ''}{role}:{text}".encode())
            some = True
    if known:
        done.append((now, digest.hexdigest()))
    yield pack(done)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the repaired conversations' rows; see Repair."""
    return Repair(conversations).repaired()


def damage_and_audit(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation after damaged().

    gaps counts missing turns between the first and the last, rows without turn aside; blank, duplicate
    and truncated count rows by their first fault; illegal counts neighbours whose roles' initials
    aren't su, ua or au.  A conversation that loses all rows has zeros, an empty audit and the hash of nothing.
    Conversations without id are one.  Role and text that are null are one space.  An empty table gives none.
    """
    fixed = Repair(damaged(conversations))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for other in (fixed.per_conversation(), fixed.digests()):
        out = out.join(other.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


ORACLE = r"""
WITH RECURSIVE k AS (
  -- the CRC-32 table, by its rule
  SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(n))
), r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS x FROM conversations
), h AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(('0x' || substr(x, 2 * i + 1, 2)) AS BIGINT) FOR i IN range(length(x) // 2)]), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS kind FROM r, k
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, range(2) n(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)
), o AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS total,
         lag(left(role, 1)) OVER w AS before, left(role, 1) AS initial
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS seen FROM o)
), z AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id
), n(q, p) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)  -- states: nothing yet, after s, after u, after a; what u or a may follow
), i AS (
  SELECT q, q AS p, 0 AS c, '' AS s FROM n UNION ALL SELECT i.q, n.p, c + 3, s || 'I' FROM i JOIN n ON n.q = i.p WHERE c < 9
), e(q, initial, p) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), m AS (
  -- a row's edits, with what is inserted before it
  SELECT conv_id, pos, i.q, e.p, c + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS c, s || 'K' AS s FROM f JOIN e USING (initial) JOIN i ON i.p = e.q WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, i.q, n.p, c + CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, s || 'R' FROM f, i JOIN n ON i.p = n.q WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, q, p, c + 4, s || 'D' FROM f, i
), b AS (
  -- from the last row to the first: the cheapest way to the end from each state, of such the least
  SELECT conv_id, total + 1 AS pos, n.q, CASE n.q WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END AS c, CASE n.q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS s FROM (SELECT DISTINCT conv_id, total FROM f), n
  UNION ALL
  SELECT conv_id, pos, q, x.c, x.s FROM (SELECT m.conv_id, m.pos, m.q, min({'c': m.c + b.c, 's': m.s || b.s}) AS x FROM b JOIN m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.pos = b.pos - 1 AND m.p = b.q GROUP BY m.conv_id, m.pos, m.q)
), a AS (
  SELECT conv_id, c AS cost, s AS audit FROM b WHERE pos = 1 AND q = 0
), w AS (
  -- the audit's letters, the row that each takes, and the roles that they give
  SELECT conv_id, j, substr(audit, j, 1) AS letter, j - length(replace(left(audit, j), 'I', '')) AS inserted, audit FROM a, unnest(range(1, length(audit) + 1)) u(j)
), v AS (
  SELECT w.conv_id, j, letter, CASE WHEN letter = 'K' THEN f.role END AS role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text, row_number() OVER (PARTITION BY w.conv_id ORDER BY j) AS place
  FROM w LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND letter <> 'I' AND f.pos = j - inserted WHERE letter <> 'D'
), y AS (
  SELECT conv_id, place, role, text, 1 + max(CASE WHEN left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS lead FROM v
), t AS (
  SELECT conv_id, sha256(string_agg(coalesce(role, CASE WHEN (place - lead) % 2 = 0 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY place)) AS h FROM y GROUP BY conv_id
)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM g.conv_id
"""
