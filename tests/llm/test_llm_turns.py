"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from leadlift.llm import queries
from leadlift.llm.turn_repair import ENDS, START, damaged, repair, search

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(turns):
    """(cost, audit) by trying all edits from the last turn back; at most two turns are inserted in a row."""
    after = None
    for at in reversed(range(len(turns) + 1)):
        best = {}
        for inserted in (2, 1, 0):
            for state in ("", "s", "u", "a"):
                want = "a" if state == "u" else "u"
                found = [(0, "")] if after is None and state in ("", "a") else []
                if inserted < 2:
                    cost, rest = best[want, inserted + 1]
                    found.append((cost + 5, "I" + rest))
                if after is not None:
                    initial, forced, extra = turns[at]
                    ways = [("D", 2, state)]
                    if not forced:
                        ways.append(("R", 1 + extra, want))
                        if initial in STEP[state]:
                            ways.append(("K", extra, STEP[state][initial]))
                    for edit, price, then in ways:
                        cost, rest = after[then, 0]
                        found.append((cost + price, edit + rest))
                best[state, inserted] = min(found, default=(10**9, ""))
        after = best
    return after["", 0]


def plain_repair(rows):
    """Expected result for the (turn, role, text) of one conversation, in order."""
    seen, turns, faults = set(), [], []
    for _, role, text in rows:
        said = text.rstrip(SPACE)
        fault = (
            "blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
        faults.append(fault)
        turns.append((role[:1], fault in ("blank", "duplicate"), 5 if fault == "truncated" else 0))
    cost, audit = cheapest(tuple(turns)) if turns else (0, "")
    out, at, state = [], 0, ""
    for edit in audit:
        want = "a" if state == "u" else "u"
        name = {"a": "assistant", "u": "user"}[want]
        if edit == "I":
            out.append(f"{name}:")
        elif edit != "D":
            role, text = rows[at][1:]
            out.append(f"{role if edit == 'K' else name}:{text}")
            want = role[:1] if edit == "K" else want
        at += edit != "I"
        state = state if edit == "D" else want
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def plain_damage(rows):
    """{conv_id: rows after damage, in order}."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        named = [" " if v is None else str(v) for v in (conv, turn)]
        case = zlib.crc32(":".join(named).encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else "".join(c for c in text if c not in ".!?") if case == 2 else text
        kept.extend([(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1))
    return {c: sorted(k, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, k in out.items()}


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(((r["conv_id"], *(r[n] for n in names)) for r in df.collect()), key=str)


def expected(rows, damage):
    told = plain_damage(rows) if damage else {}
    if not damage:
        for conv, turn, role, text in rows:
            told.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
        told = {c: sorted(k, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, k in told.items()}
    return sorted(((c, *plain_repair(k)) for c, k in told.items()), key=str)


def random_rows(draw, conversations, turns):
    roles = ["user", "assistant", "system", "tool", "u", "", None]
    texts = ["Yes.", "no", "", " \n", "Why? ", "x\x0b", None, "Yes.", "\x85", "ends.\n\n"]
    rows = []
    for conv in range(conversations):
        for _ in range(draw.randrange(1, turns)):
            turn = draw.choice([None, *range(turns)])
            rows.append((conv, turn, draw.choice(roles[:4] * 3 + roles), draw.choice(texts) if draw.random() < 0.5 else f"t{draw.randrange(9)}."))
    return rows


def test_search_finds_the_least_path():
    draw = random.Random(5)
    for _ in range(1500):
        turns = [
            (draw.choice("suatx"), draw.random() < 0.25, draw.choice([0, 0, 5])) for _ in range(draw.randrange(0, 9))
        ]
        assert list(search(turns, START, ENDS, True).values()) == [cheapest(tuple(turns))]


@pytest.mark.parametrize("block", [1, 2, 3, 256])
def test_repair_equals_plain_search(spark, block):
    rows = random_rows(random.Random(block), 40, 9)
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (7, 3, "user", "same."), (7, 3, "user", "same.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert results(repair(df, block)) == expected(rows, False)
    assert results(repair(damaged(df), block)) == expected(rows, True)


def test_one_conversation_over_many_blocks(spark):
    draw = random.Random(9)
    rows = [(1, i, draw.choice(["user", "assistant"]), f"word {draw.randrange(500)}.") for i in range(1500)]
    rows += [(2, 0, "user", "a" * 300_000 + "."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = results(repair(df, 16))
    assert found == expected(rows, False)


def test_empty_table_extra_columns_and_lost_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair(damaged(empty)).collect() == []
    # a conversation of which every row is dropped still has its row
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "a.")], SCHEMA)
    df = df.withColumn("paths", F.lit(1)).withColumn("fault", F.lit("x")).withColumn("case", F.lit(3))
    nothing = hashlib.sha256(b"").hexdigest()
    assert results(repair(damaged(df))) == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_query_on_the_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(queries.op12_turn_repair(spark, small)) == expected(rows, True)
