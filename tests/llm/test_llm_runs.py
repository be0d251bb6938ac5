"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from leadlift.llm import queries
from leadlift.llm.periodic_runs import find_runs, run_digests, runs_of_texts, stretches, with_repetitions

SCHEMA = "doc_id bigint, text string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, periods=None):
    """(start, length, period) of all runs, period by period."""
    ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for start, end in edges.reshape(-1, 2):
            length = int(end - start + q)
            if length < max(6, 4 * q):
                continue
            part = ids[start : start + length]
            if not any(q % d == 0 and (part[d:] == part[:-d]).all() for d in range(1, q)):
                found.append((int(start), length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def digest_of(doc_id, words):
    runs = plain_runs(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)))


def repeated(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_runs_of_random_words():
    draw = random.Random(3)
    texts = []
    for _ in range(400):
        alphabet = [str(i) for i in range(draw.randrange(1, 5))]
        words = [draw.choice(alphabet) for _ in range(draw.randrange(0, 60))]
        for _ in range(draw.randrange(0, 3)):
            unit = [draw.choice(alphabet) for _ in range(draw.randrange(1, 9))]
            at = draw.randrange(len(words) + 1)
            words[at:at] = (unit * 7)[: draw.randrange(1, 7 * len(unit) + 1)]
        texts.append(words)
    parts = [stretches([w.encode() for w in words]) for words in texts]
    found = runs_of_texts(parts)
    assert sum(map(len, found)) > 300
    for words, runs in zip(texts, found, strict=True):
        assert runs == plain_runs(words)
    # alone or together, a text has the same runs
    assert [runs_of_texts([p])[0] for p in parts[:40]] == found[:40]


def test_texts_of_all_kinds(spark):
    texts = {
        0: None,
        1: "",
        2: " \t\n",
        3: "a a a a a",
        4: "a a a a a a",
        5: "a\x85b a\x85b a\x85b a\x85b a\x85b a\x85b",
        6: "x " + "a b c " * 4 + "a b y",
        7: "\x1c".join(["é ü"] * 9) + " é ü" * 9,
        8: " ".join(["the"] * 30_000),
        9: " ".join(f"w{i % 700}" for i in range(60_000)),
        10: "a b " * 5 + "a a " * 8 + "a b a a " * 6,
    }
    rows = [*texts.items(), (4, texts[4]), (None, texts[6])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("runs", F.lit("x")).withColumn("n_words", F.lit(0)).repartition(3)
    key = lambda r: str(r)
    for slice_words in (1, 50_000):
        found = sorted(map(tuple, run_digests(df, slice_words).collect()), key=key)
        assert found == sorted((digest_of(i, words_of(t)) for i, t in rows), key=key)
    whole = {r["doc_id"]: r for r in find_runs(df).collect()}
    assert whole[6]["collapsed"] == "x a b c y" and whole[6]["n_words"] == 16
    assert [tuple(r) for r in whole[6]["runs"]] == [(1, 14, 3)]
    assert whole[0]["runs"] == [] and whole[0]["collapsed"] == ""
    assert run_digests(df.limit(0)).collect() == []


def test_repeated_words(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(i, t) for i in range(300, 340) for t in ("", "one", "a b c d e f g")], SCHEMA)
    more = more.unionByName(spark.createDataFrame([(None, "a b"), (301, None)], SCHEMA))
    docs = docs.unionByName(more)
    before = sorted((r["doc_id"] or -1, repeated(r["doc_id"], words_of(r["text"]))) for r in docs.collect())
    after = sorted((r["doc_id"] or -1, words_of(r["text"])) for r in with_repetitions(docs).collect())
    assert before == after


def test_query_on_the_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(digest_of(i, repeated(i, words_of(t))) for i, t in docs)
    found = queries.op11_periodic_runs(spark, small)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    assert sorted(map(tuple, found.collect())) == expected
    assert sum(r[1] > 0 for r in expected) > 5
