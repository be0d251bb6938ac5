"""Personal data, fingerprints, successors and chat format against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from leadlift.llm import chat, fingerprints, personal_data, queries
from leadlift.llm.expressions import running
from leadlift.llm.successors import with_successor

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text):
    return re.sub("[^0-9]", "", text)


def base_spans(text):
    checks = (
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", CARD, lambda m: 13 <= len(digits_of(m)) <= 19 and luhn(digits_of(m))),
        ("phone", PHONE, lambda m: 9 <= len(digits_of(m)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, p, ok in checks for m in p.finditer(text) if ok(m[0])]


def noisy_texts():
    draw = random.Random(5)
    parts = [
        "a@b.c", "x.y+z@mail-1.example.co.uk", "a@b", "@", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "0000000000000", "+1 (555) 123-4567", "+49.30.1",
        "+1 2", "_d@e.f", "é", "日本", " ", ".", "-", "\n", "7", "12", "999999999999999999999", "😀", "a@b.c_d@e.f",
    ]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for _ in range(600)]
    long = ["9" * 20000, "a" * 30000, "a.b" * 9000, "1." * 9000, "a@b" + ".c" * 9000, "+1" + "(" * 9000, "x@y.z " * 1500]
    return [None, "", *texts, *long]


def test_spans_are_those_of_the_plain_expressions(spark):
    texts = noisy_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    rows = personal_data.find_personal_data(docs).select("doc_id", "pii_spans").collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        found = [(s["kind"], s["start"], s["end"]) for s in row["pii_spans"]]
        assert [f for f in found if f[0] in personal_data.BASE] == base_spans(text), text[:80]


def test_cards_whose_digits_stand_apart(spark):
    cards = ["4111111111111111", "4222222222222", "4111111111111112", "411111111111"]
    texts = [f"card {sign.join(card)} end" for card in cards for sign in ("", " ", "-")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {
        r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii_spans"]]
        for r in personal_data.find_personal_data(docs).collect()
    }
    assert found == {i: base_spans(text) for i, text in enumerate(texts)}
    assert [len(found[i]) for i in range(len(texts))] == [1] * 6 + [0] * 6
    masked = {r["doc_id"]: r["text"] for r in personal_data.mask_personal_data(docs).collect()}
    assert [masked[i] for i in range(6)] == ["card [CARD] end"] * 6


def test_query_digests_real_documents(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op3_personal_data(spark, small).collect()
    assert len(rows) == len(docs)
    for row in rows:
        spans = base_spans(docs[row["doc_id"]])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in personal_data.BASE] == [sum(s[0] == k for s in spans) for k in personal_data.BASE]


def test_accounts_and_context(spark):
    texts = [
        "pay to DE89370400440532013000 now",
        "pay to DE89 3704 0044 0532 0130 00 now",
        "pay to DE88370400440532013000 now",
        "my social security number is 123-45-6789.",
        "part 123-45-6789",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {
        r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["pii_spans"]]
        for r in personal_data.find_personal_data(docs).collect()
    }
    assert found == {
        0: ["DE89370400440532013000"],
        1: ["DE89 3704 0044 0532 0130 00"],
        2: [],
        3: ["123-45-6789"],
        4: [],
    }


def test_mask(spark):
    rows = [
        (1, "write a@b.co or 10.0.0.1!", 25, "x"),
        (2, "nothing é here", None, None),
        (3, None, 5, "y"),
        (4, "1.1.1.1_2.2.2.2@host.example", 28, "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int, pii_spans string")
    out = personal_data.mask_personal_data(docs)
    assert out.schema == docs.schema
    assert sorted(map(tuple, out.collect())) == [
        (1, "write [EMAIL] or [IP]!", 22, "x"),
        (2, "nothing é here", None, None),
        (3, None, 5, "y"),
        (4, "[EMAIL]", 7, "z"),
    ]
    assert personal_data.mask_personal_data(docs.limit(0)).count() == 0


def test_running_over_many_blocks(spark):
    df = spark.range(1).select(running(F.sequence(F.lit(1), F.lit(1000)), F.lit(0), lambda a, b: a + b).alias("x"))
    assert df.first()["x"] == [i * (i + 1) // 2 for i in range(1000)]
    none = spark.range(1).select(running(F.array().cast("array<int>"), F.lit(0), lambda a, b: a + b).alias("x"))
    assert none.first()["x"] == []


@pytest.mark.parametrize("ids", [[5], [0, 1, 2, 5000, 10**12, -3, -(10**9)], list(range(0, 4000, 3)), [None, 7, None]])
def test_successors(spark, ids):
    rows = spark.createDataFrame([(i, str(i)) for i in ids], "k bigint, v string").repartition(4)
    got = {r["v"]: r["n"] for r in with_successor(rows, "k", [F.col("v")], {"n": F.col("v")}).collect()}
    order = sorted((i for i in ids if i is not None), reverse=True)
    expected = {str(a): str(b) for a, b in zip(order, order[1:] + order[:1])} | ({"None": None} if None in ids else {})
    assert got == expected


def shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_fingerprints_estimate_likeness(spark, small):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect())[::-1]
    rows = {r["doc_id"]: r for r in queries.op6_document_fingerprints(spark, small).collect()}
    assert len(rows) == len(docs)
    errors = []
    for (doc_id, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        row, half = rows[doc_id], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in (("near_edited", edited), ("near_next", following)):
            a, b = shingles(text), shingles(other)
            errors.append(abs(row[near] - len(a & b) / len(a | b)))
    assert sum(errors) / len(errors) < 0.02 and max(errors) < 0.2
    by_text = {}
    for doc_id, text in docs:
        by_text.setdefault(text, set()).add(rows[doc_id]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_fingerprints_of_odd_rows(spark):
    rows = [(1, None, "c"), (2, "", "c"), (3, "one", None), (3, "one", None), (None, "a b c d e f", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, codes string")
    found = fingerprints.edited_pairs(docs)
    got = found.select("doc_id", "text", "edited", F.hex(F.col("codes").cast("string").cast("binary")).alias("c"))
    assert got.count() == 5
    texts = {(r["doc_id"], r["text"], r["edited"]) for r in got.collect()}
    assert texts == {(1, "", ""), (2, "", ""), (3, "one", "ono"), (3, "one", "on"), (None, "a b c d e f", "a b c ")}
    assert fingerprints.edited_pairs(docs.limit(0)).count() == 0


def test_native_plans_run_no_python(spark, small):
    for query in (queries.op3_personal_data, queries.op6_document_fingerprints):
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


TURNS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "### x </turn> \\b \\h \\\\ ####"),
    (1, 2, "Human", None),
    (1, 2, "gpt", "b\n### user\n"),
    (1, 2, "gpt", "b\n### user\n"),
    (2, None, "assistant", ""),
    (None, 0, "a\n</turn>", "lost \\"),
    (None, 1, "user", "also lost"),
    (3, 0, None, "日本 </turn>\n### assistant\nno"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(
        [(*t, "extra") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, turns string"
    )
    out = chat.format_turns(chat.turns_of_rows(rows))
    read = out.select(
        "conv_id",
        "formatted",
        "loss",
        chat.read_turns(F.col("formatted")).alias("t"),
        chat.loss_text(F.col("formatted"), F.col("loss")).alias("learnt"),
    )
    learnt = {"gpt", "assistant"}
    for row in read.collect():
        own = [t for t in TURNS if t[0] == row["conv_id"]]
        if row["conv_id"] is None:
            own = [t for t in own if t[3] == row["t"][0]["text"]]
        own = sorted((t[1] or 0, t[2] or "", t[3] or "") for t in own)
        assert [tuple(t) for t in row["t"]] == [t[1:] for t in own]
        assert row["learnt"] == "".join(t for _, r, t in own if r in learnt)
        assert len(row["loss"]) == sum(r in learnt for _, r, _ in own)
        assert row["formatted"].count("</turn>") == len(own)
    assert read.count() == 5


def test_chat_query_is_the_table(spark, small):
    table = {}
    for r in spark.read.parquet(f"{small}/conversations.parquet").collect():
        table.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    said = "\\### Assistant: </turn> ok"
    table[-7] = [(0, "user", said), (1, "assistant", said)]
    rows = queries.op9_chat_format(spark, small).collect()
    assert len(rows) == len(table)
    for row in rows:
        turns = sorted(table[row["conv_id"]])
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_layouts_of_records(spark):
    turns = [("user", "q"), ("assistant", "a")]
    records = [
        '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
        '{"prompt": "q", "response": "a"}',
        '{"output": "a", "input": "", "instruction": "q"}',
        '{"question": "q", "answer": "a"}',
        '{"something": "else"}',
        "{broken",
        None,
    ]
    table = spark.createDataFrame(list(enumerate(records)), "conv_id bigint, record string")
    got = {r["conv_id"]: r for r in chat.turns_of_records(table).collect()}
    for i in range(5):
        assert [(t["role"], t["text"]) for t in got[i]["turns"]] == turns
    assert [got[i]["turns"] for i in (5, 6, 7)] == [None] * 3
    assert len({got[i]["layout"] for i in range(5)}) == 5
    formatted = chat.format_turns(chat.turns_of_records(table))
    assert formatted.where("formatted = ''").count() == 3


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError):
        chat.turns_of_rows(spark.createDataFrame([(1, "x")], "conv_id bigint, text string"))
