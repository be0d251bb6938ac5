"""Repairs the turns of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``.

Edits are D (delete, 2, forced for blank and repeated turns), I (insert an empty user or assistant turn, 5), K (keep, 0)
and R (another role, user or assistant, 1); a truncated turn that stays adds 5. They are found by iterative deepening
A*: a depth-first search in the ASCII order of the edits, under a cost bound that grows by one, the remaining turns'
least costs being the estimate. What failed with some budget left is remembered per (turn, state) and not tried again
with less. The first accepting path is therefore the cheapest, and of the cheapest the least in ASCII order.

Turns are range-partitioned by (conversation, turn, role, text) and searched in blocks of at most ``BLOCK`` turns where
they lie, so a conversation of any length spreads over tasks. A conversation inside one block is done there. A block of
a longer one is searched from every state it may be entered in to every state it may be left in; the few results per
block are then strung together in order. An insertion belongs to the turn after it, so no block's edits are the
beginning of another's, and the order of strings is decided block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.sources.shipping import ship
from leadlift.sources.staging import stage

BLOCK = 32
DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5
LEGAL = ("su", "ua", "au")
# states: nothing yet, after system, after user, after assistant; the state that a kept initial leads to
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
# the role that an inserted or renamed turn gets, and the state after it
WANTED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ENDS = (START, ASSISTANT)

BLANKS = r"\x20\x09-\x0D"
# a turn as the search sees it: initial of its role, whether it must go, what keeping it adds
Turn = tuple[str, bool, int]

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
PATH = "struct<entry:int,exit:int,cost:bigint,audit:string>"
BLOCKS = (
    "conv_id bigint, part int, block bigint, whole boolean, turns bigint, first_turn bigint, low bigint, high bigint, "
    "distinct_turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, "
    f"last string, paths array<{PATH}>, roles array<string>, texts array<string>, repaired_sha256 string"
)


def moves(turns: list[Turn], at: int, state: int, trailing: bool) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, next turn, next state), in ASCII order."""
    left = at < len(turns)
    if left:
        yield DELETE, COST[DELETE], at + 1, state
    if left or trailing:
        yield INSERT, COST[INSERT], at, WANTED[state][1]
    if left:
        initial, forced, extra = turns[at]
        if not forced:
            if initial in AFTER[state]:
                yield KEEP, COST[KEEP] + extra, at + 1, AFTER[state][initial]
            yield REROLE, COST[REROLE] + extra, at + 1, WANTED[state][1]


def search(turns: list[Turn], entry: int, ends: tuple[int, ...], trailing: bool) -> dict[int, tuple[int, str]]:
    """(cost, edits) of the cheapest path from ``entry``, ASCII-least: to each of ``ends``, each within reach.

    With ``trailing``, turns may be inserted after the last one and the first accepting path ends the search: then the
    result has the best of all ends only.
    """
    n = len(turns)
    least = [0] * (n + 1)  # what the turns from here on cost at least
    for i in reversed(range(n)):
        initial, forced, extra = turns[i]
        least[i] = least[i + 1] + (COST[DELETE] if forced else min(COST[DELETE], extra))
    found: dict[int, tuple[int, str]] = {}
    if trailing and entry in ends and not n:
        return {entry: (0, "")}
    # deleting all turns and inserting at most a pair reaches every end
    for bound in range(least[0], COST[DELETE] * n + 2 * COST[INSERT] + 1):
        # (turn, state) -> the most budget with which nothing more was to be found there
        failed: dict[tuple[int, int], int] = {}
        edits: list[str] = []
        stack = [(0, entry, bound, moves(turns, 0, entry, trailing))]
        while stack:
            at, state, budget, following = stack[-1]
            for edit, cost, to, then in following:
                rest = budget - cost
                if rest < least[to] or failed.get((to, then), -1) >= rest:
                    continue
                if to == n and then in ends and then not in found:
                    found[then] = (bound - rest, "".join(edits) + edit)
                    if trailing or len(found) == len(ends):
                        return found
                if to == n and not trailing:
                    continue
                edits.append(edit)
                stack.append((to, then, rest, moves(turns, to, then, trailing)))
                break
            else:
                failed[at, state] = max(failed.get((at, state), -1), budget)
                stack.pop()
                if edits:
                    edits.pop()
    return found


def crossings(turns: list[Turn], entry: int) -> dict[int, tuple[int, str]]:
    """(cost, edits) from ``entry`` to every state that a block of ``turns`` can be left in.

    The start is left for good by the first turn kept, and so is a system turn; only deletions stay there.
    """
    n = len(turns)
    out = search(turns, entry, (USER, ASSISTANT), trailing=False) if n else {}
    if entry in (START, SYSTEM) or not n:
        out[entry] = (COST[DELETE] * n, DELETE * n)
    if entry == START:
        kept = [(extra, -i) for i, (initial, forced, extra) in enumerate(turns) if initial == "s" and not forced]
        if kept:
            extra, i = min(kept)
            out[SYSTEM] = (COST[DELETE] * (n - 1) + extra, DELETE * -i + KEEP + DELETE * (n - 1 + i))
    return out


def apply_edits(audit: str, entry: int, roles: list[str], texts: list[str]) -> list[str]:
    """``role:text`` of the turns that ``audit`` leaves."""
    out, at, state = [], 0, entry
    for edit in audit:
        if edit == DELETE:
            at += 1
            continue
        role, then = WANTED[state]
        if edit == INSERT:
            out.append(f"{role}:")
        else:
            if edit == KEEP:
                role, then = roles[at], AFTER[state][roles[at][:1]]
            out.append(f"{role}:{texts[at]}")
            at += 1
        state = then
    return out


def sha256(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def flagged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy, kept and the first fault of each turn: blank, duplicate, truncated.

    The first of equal turns is found with a partial aggregate over (conversation, role, text), then joined.
    """
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), F.col("copy").alias("copy"))
    keyed = rows.withColumn("said", F.md5(F.col("text"))).withColumn("order", order)
    first = keyed.where("kept").groupBy("conv_id", "role", "said").agg(F.min("order").alias("first"))
    r, f = keyed.alias("r"), first.alias("f")
    same = (
        F.col("r.conv_id").eqNullSafe(F.col("f.conv_id"))
        & (F.col("r.role") == F.col("f.role"))
        & (F.col("r.said") == F.col("f.said"))
    )
    joined = r.join(f, same, "left")
    blank = ~F.col("text").rlike(f"[^{BLANKS}]")
    fault = (
        F.when(~F.col("kept"), F.lit(None))
        .when(blank, "blank")
        .when(F.col("order") > F.col("first"), "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{BLANKS}]*\z"), "truncated")
    )
    names = ["conv_id", "turn", "role", "text", "copy", "kept"]
    return joined.select(*[F.col(f"r.{n}") for n in names], F.col("r.order"), F.col("f.first")).select(
        *names, fault.alias("fault")
    )


def block_row(key: int | None, part: int, number: int, rows: list[tuple], whole: bool) -> dict:
    """What a block of (turn, role, text, kept, fault) rows says of itself."""
    rows = [r for r in rows if r[3]]
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    seen = [
        (i, r[4] in ("blank", "duplicate"), TRUNCATED_COST if r[4] == "truncated" else 0)
        for i, r in zip(initials, rows, strict=True)
    ]
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    faults = [r[4] for r in rows]
    digest = None
    if whole:
        ((cost, audit),) = search(seen, START, ENDS, trailing=True).values()
        paths = [(START, START, cost, audit)]
        digest = sha256(apply_edits(audit, START, roles, texts))
        roles = texts = None
    else:
        paths = [(entry, leave, *way) for entry in STATES for leave, way in crossings(seen, entry).items()]
    return {
        "conv_id": key,
        "part": part,
        "block": number,
        "whole": whole,
        "turns": len(rows),
        "first_turn": turns[0] if turns else None,
        "low": min(turns, default=None),
        "high": max(turns, default=None),
        "distinct_turns": len(set(turns)),
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first": initials[0] if rows else None,
        "last": initials[-1] if rows else None,
        "paths": [dict(zip(("entry", "exit", "cost", "audit"), p, strict=True)) for p in paths],
        "roles": roles,
        "texts": texts,
        "repaired_sha256": digest,
    }


_PATH = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_BLOCK = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("whole", pa.bool_())]
    + [(c, pa.int64()) for c in ("turns", "first_turn", "low", "high", "distinct_turns")]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
    + [("first", pa.string()), ("last", pa.string()), ("paths", pa.list_(_PATH))]
    + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("repaired_sha256", pa.string())]
)
_RESULT = pa.schema(
    [("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())]
    + [("repaired_sha256", pa.string())]
)


def search_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the ordered turns of one partition.

    A conversation that may reach beyond the partition (its first and its last one) is never taken for whole.
    """
    part = TaskContext.get().partitionId()
    number, key, rows, opened, inner = 0, None, [], False, False
    last = None  # the turn before, of which an equal one is a repetition
    out: list[dict] = []
    cut = False  # whether earlier blocks of the conversation at hand were given out
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for conv, *row in zip(*columns, strict=True):
            if opened and conv != key:
                out.append(block_row(key, part, number, rows, inner and not cut))
                number, rows, cut, inner, last = number + 1, [], False, True, None
            elif opened and len(rows) == block:
                out.append(block_row(key, part, number, rows, False))
                number, rows, cut = number + 1, [], True
            key, opened = conv, True
            turn, role, text, kept, fault = row
            if kept:
                if last == (turn, role, text) and fault != "blank":
                    fault = "duplicate"
                last = (turn, role, text)
            rows.append((turn, role, text, kept, fault))
        if out:
            yield pa.RecordBatch.from_pylist(out, _BLOCK)
            out = []
    if opened:
        yield pa.RecordBatch.from_pylist([block_row(key, part, number, rows, False)], _BLOCK)


class Joined:
    """A conversation's blocks strung together; what all open paths agree on is hashed and forgotten."""

    def __init__(self, key: int | None):
        self.key = key
        self.open: dict[int, tuple[int, tuple]] = {START: (0, ())}  # state -> (cost, ((block number, entry, audit), ..))
        self.texts: dict[int, tuple[list[str], list[str]]] = {}
        self.hash, self.said, self.audit = hashlib.sha256(), False, []
        self.counts = dict.fromkeys(("distinct_turns", "blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last = None
        self.number = 0

    def add(self, block: dict) -> None:
        for name in self.counts:
            self.counts[name] += block[name]
        if block["turns"]:
            if self.last is not None:
                self.counts["illegal"] += self.last + block["first"] not in LEGAL
            self.last = block["last"]
        if block["low"] is not None:
            self.counts["distinct_turns"] -= block["first_turn"] == self.high
            self.low = block["low"] if self.low is None else self.low
            self.high = block["high"]
        self.number += 1
        self.texts[self.number] = (block["roles"], block["texts"])
        best: dict[int, tuple[int, tuple]] = {}
        for path in block["paths"]:
            if path["entry"] in self.open:
                cost, before = self.open[path["entry"]]
                way = (cost + path["cost"], (*before, (self.number, path["entry"], path["audit"])))
                if path["exit"] not in best or order_of(way) < order_of(best[path["exit"]]):
                    best[path["exit"]] = way
        self.open = best
        self.settle()

    def settle(self) -> None:
        """Take over the first blocks' edits as far as all open paths share them."""
        while True:
            heads = {path[:1] for _, path in self.open.values()}
            if len(heads) != 1 or heads == {()}:
                return
            self.commit(heads.pop()[0])
            self.open = {state: (cost, path[1:]) for state, (cost, path) in self.open.items()}

    def commit(self, step: tuple[int, int, str]) -> None:
        number, entry, audit = step
        self.write(apply_edits(audit, entry, *self.texts.pop(number)))
        self.audit.append(audit)

    def write(self, lines: list[str]) -> None:
        if lines:
            text = "\n".join(lines)
            self.hash.update((f"\n{text}" if self.said else text).encode("utf-8", "surrogatepass"))
            self.said = True

    def result(self) -> dict:
        endings = {START: (), ASSISTANT: (), USER: ("assistant:",), SYSTEM: ("user:", "assistant:")}
        ways = []
        for state, (cost, path) in self.open.items():
            tail = endings[state]
            ways.append((cost + COST[INSERT] * len(tail), "".join(a for *_, a in path) + INSERT * len(tail), path, tail))
        cost, _, path, tail = min(ways)
        for step in path:
            self.commit(step)
        self.write(list(tail))
        self.audit.append(INSERT * len(tail))
        counts = dict(self.counts)
        distinct = counts.pop("distinct_turns")
        gaps = 0 if self.low is None else self.high - self.low + 1 - distinct
        return {
            "conv_id": self.key,
            "gaps": gaps,
            **counts,
            "cost": cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.hash.hexdigest(),
        }


def order_of(way: tuple[int, tuple]) -> tuple[int, str]:
    return way[0], "".join(audit for *_, audit in way[1])


def join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One result per conversation from blocks sorted by conversation and place."""
    current: Joined | None = None
    for batch in batches:
        done = []
        for block in batch.to_pylist():
            if current is None or block["conv_id"] != current.key:
                if current is not None:
                    done.append(current.result())
                current = Joined(block["conv_id"])
            current.add(block)
        if done:
            yield pa.RecordBatch.from_pylist(done, _RESULT)
    if current is not None:
        yield pa.RecordBatch.from_pylist([current.result()], _RESULT)


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text[, copy, kept])``: faults, edits, digest.

    Turns come in the order of turn (nulls first), role, text and copy. A null role or text is one space; a turn without
    a role has no initial and is never kept as it is. ``copy`` numbers turns that are to follow one another. Rows with
    ``kept`` false only name their conversation. Rows without a conv_id are one conversation. A conversation without
    turns has zeros, no edits and the digest of the empty string; an empty table gives an empty result. Other columns
    are left out.

    The digest covers a conversation's whole text, so the text of one that spans blocks passes a single task in the end,
    block by block; search and counts are done where the blocks lie.
    """
    ship(rows.sparkSession)
    has = set(rows.columns)
    plain = rows.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("copy").cast("int") if "copy" in has else F.lit(0)).alias("copy"),
        (F.col("kept") if "kept" in has else F.lit(True)).alias("kept"),
    )
    order = ["conv_id", "turn", "role", "text", "copy"]
    placed = flagged(plain).repartitionByRange(*order).sortWithinPartitions(*order)
    seen = placed.select("conv_id", "turn", "role", "text", "kept", "fault")
    blocks = stage(seen.mapInArrow(partial(search_blocks, block=block), BLOCKS), "turn blocks")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct_turns"), F.lit(0))
    path = F.col("paths")[0]
    whole = blocks.where("whole").select(
        "conv_id",
        gaps.alias("gaps"),
        *COUNTS[1:-1],
        path["cost"].alias("cost"),
        path["audit"].alias("audit"),
        "repaired_sha256",
    )
    spread = blocks.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return whole.unionByName(spread.mapInArrow(join_blocks, RESULT))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` with the faults that a hash of conversation and turn calls for.

    Of twenty cases, one drops the row, one empties its text, one takes the marks ``.!?`` out, one repeats the row, one
    makes the role user. Nulls are one space. Dropped rows stay as rows that only name their conversation.
    """
    space = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    case = F.pmod(F.crc32(F.concat(named[0], F.lit(":"), named[1])), F.lit(20))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    told = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), case.alias("case"))
    worse = (
        F.when(F.col("case") <= 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    copies = F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return told.select(
        "conv_id",
        "turn",
        F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        worse.alias("text"),
        F.explode(copies).alias("copy"),
        (F.col("case") != 0).alias("kept"),
    )
