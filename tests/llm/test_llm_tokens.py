"""Byte-level BPE, prefix counts and packing against the libraries."""

import base64
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leadlift.llm import token_counts
from leadlift.llm.byte_bpe import decode, encode
from leadlift.llm.packing import pack_documents, plan_places
from leadlift.llm.queries import RANKS, WORD_VOCABULARY
from leadlift.llm.token_counts import PrefixTables, longest_prefix, prefix_counts, tokens_within

TRICKY = [
    None,
    "",
    " ",
    "\n\n  \t",
    "a",
    "The quick brown fox's 12345 don't  \n\n jump!!  ",
    "x'really 'll !!'s ''re 're've",
    "Élan ñandú ÀÉÎ straße İstanbul Σίσυφος ς",
    "été cafés ñ",
    "日本語のテキスト 中文 한국어 한국어",
    "\x1c\x1d a\x1cb !\x1f! \x85x\xa0y　z ",
    "😀👩‍👩‍👧‍👦 emoji 🇩🇪!",
    "a<|startoftext|>b <|endoftext|><|STARTOFTEXT|><|startoftext",
    "²³ ½ ªº Ⅷ ٣٤",
    "word " * 3000,
    "z" * 5000,
    "0123456789" * 300,
    "###$$$&&& ***%%% the*** and&&&",
    "K K ǅ ﬁ",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", i) for i, t in enumerate(TRICKY)] + [(4, "a", "en", None), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, ids int").repartition(3)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_VOCABULARY)


def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def text_of(row_id):
    return "no id" if row_id is None else TRICKY[row_id] or ""


def test_byte_bpe_is_the_library_and_back(docs):
    own = reference_encoding()
    encoded = encode(docs, RANKS, public_tokenizers.PATTERN)
    rows = encoded.collect()
    assert len(rows) == docs.count()
    for row in rows:
        text = text_of(row["doc_id"])
        assert row["ids"] == own.encode_ordinary(text), text
        _, starts = own.decode_with_offsets(row["ids"])
        assert row["starts"] == starts, text
        pieces = [own.decode_single_token_bytes(i) for i in row["ids"]]
        for piece, start, end in zip(pieces, row["starts"], row["ends"]):
            assert piece in text[start:end].encode()
    for row in decode(encoded, RANKS).collect():
        assert row["text"] == text_of(row["doc_id"])
        assert row["bytes"] == row["text"].encode()


def test_decode_keeps_bytes_that_are_no_text(spark):
    own = reference_encoding()
    ids = own.encode_ordinary("é")
    half = [own._mergeable_ranks[b"\xc3"]] if len(ids) == 1 else ids[:1]
    row = decode(spark.createDataFrame([(1, half), (2, None)], "doc_id bigint, ids array<int>"), RANKS).collect()
    assert row[0]["bytes"] == b"\xc3" and row[0]["text"] == "�"
    assert row[1]["bytes"] == b"" and row[1]["text"] == ""


def test_counts_at_every_prefix(library):
    tables = PrefixTables(open(WORD_VOCABULARY, "rb").read())
    texts = [t or "" for t in TRICKY]
    for text, table in zip(texts, tables.texts(texts)):
        assert len(table) == len(text)
        step = 1 if len(text) < 200 else 97
        cuts = sorted({*range(1, len(text) + 1, step), len(text)} - {0})
        expected = library.encode_batch([text[:k] for k in cuts], add_special_tokens=False)
        assert [int(table[k - 1]) for k in cuts] == [len(e.ids) for e in expected], text[:40]


@pytest.mark.parametrize("most", [400_000, 50])
def test_steps_between_prefixes_are_remembered(library, monkeypatch, most):
    """Words that begin alike or are made of the same parts take few steps that have to be worked out."""
    monkeypatch.setattr(token_counts, "MAX_STEPS", most)
    tables, draw = PrefixTables(open(WORD_VOCABULARY, "rb").read()), random.Random(3)
    parts = ["th", "er", "ion", "ing", "bl", "e", "sch", "ung", "qz", "xx"]
    words = list({"".join(draw.choices(parts, k=draw.randrange(1, 7))) for _ in range(3000)})
    worked_out, step = [], PrefixTables._step
    monkeypatch.setattr(PrefixTables, "_step", lambda self, *a: worked_out.append(1) or step(self, *a))
    found = dict(zip(words, tables.word_tables(words), strict=True))
    assert most < 400_000 or len(worked_out) < sum(map(len, words)) / 5
    for word in words[:300]:
        cuts = library.encode_batch([word[:k] for k in range(1, len(word) + 1)], add_special_tokens=False)
        assert found[word] == tuple(len(e.ids) for e in cuts) == tables.word(word), word
    assert tables.known <= most


def test_prefix_questions(docs, library):
    counted = prefix_counts(docs, WORD_VOCABULARY).select(
        "doc_id",
        tokens_within(F.col("prefix_tokens"), F.size("prefix_tokens")).alias("n"),
        tokens_within(F.col("prefix_tokens"), 7).alias("first"),
        longest_prefix(F.col("prefix_tokens"), 5).alias("fits"),
    )
    for row in counted.collect():
        text = text_of(row["doc_id"])
        count = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(min(len(text), 60) + 1)]
        assert row["n"] == len(library.encode(text, add_special_tokens=False).ids)
        assert row["first"] == count[min(7, len(text))]
        if len(text) <= 60:
            assert row["fits"] == max(k for k, n in enumerate(count) if n <= 5)


def pieces_of(library, text, capacity):
    ids = library.encode(text, add_special_tokens=False).ids + [0]
    cut = [(i, ids[i : i + capacity]) for i in range(0, len(ids), capacity)]
    return [(n, at, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p))) for n, (at, p) in enumerate(cut)]


def assert_packed(rows, capacity, most):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_sequence) <= most


def test_packing_places_every_piece(docs, library):
    rows = pack_documents(docs, WORD_VOCABULARY, capacity=64).collect()
    expected = []
    for row in docs.collect():
        expected += [(row["doc_id"], *p) for p in pieces_of(library, row["text"] or "", 64)]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted([tuple(r[n] for n in names) for r in rows], key=str) == sorted(expected, key=str)
    assert_packed(rows, 64, -(-sum(r["length"] for r in rows) // 64) + 2)


def test_places_are_those_of_best_fit():
    """Against best fit decreasing, piece by piece; rows of the plan depend on sizes, not on pieces."""
    draw = np.random.default_rng(7)
    for capacity, most in ((16, 9), (64, 400), (200, 30)):
        counts = {int(s): int(draw.integers(1, most)) for s in draw.choice(np.arange(1, capacity + 1), capacity // 2, False)}
        gaps, filled = [], {}
        for size in sorted(counts, reverse=True):
            for _ in range(counts[size]):
                fits = [i for i, gap in enumerate(gaps) if gap >= size]
                at = min(fits, key=lambda i: gaps[i], default=len(gaps))
                gaps += [capacity] if at == len(gaps) else []
                filled.setdefault(at, []).append((size, capacity - gaps[at]))
                gaps[at] -= size
        plan, ours = plan_places(counts, capacity).tolist(), {}
        for (size, rank, first, each, offset), after in zip(plan, [*plan[1:], [None]]):
            end = after[1] if after[0] == size else counts[size]
            for k in range(end - rank):
                ours.setdefault(first + k // each, []).append((size, offset + k % each * size))
        # gaps of one size are alike: pieces may swap between them
        assert sorted(sum(ours.values(), [])) == sorted(sum(filled.values(), [])) and len(ours) == len(filled)
        for places in ours.values():
            ends = [0, *(offset + size for size, offset in sorted(places, key=lambda p: p[1]))]
            assert [offset for _, offset in sorted(places, key=lambda p: p[1])] == ends[:-1] and ends[-1] <= capacity
        many = plan_places({size: n * 1_000_003 for size, n in counts.items()}, capacity)
        assert len(many) <= 8 * capacity * len(counts)
    assert plan_places({}, 8).shape == (0, 5)


def test_few_jobs_pack_documents(spark):
    """The number of Spark jobs does not follow from how many rounds of packing there are."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a "), (F.col("id") % 150).cast("int")).alias("text"))
    context = spark.sparkContext
    context.setJobGroup("packing", "packing")
    try:
        rows = pack_documents(docs, WORD_VOCABULARY, capacity=128).collect()
        jobs = context.statusTracker().getJobIdsForGroup("packing")
    finally:
        context._jsc.clearJobGroup()
    assert len(rows) == 400 + sum(i % 150 >= 128 for i in range(400))
    assert_packed(rows, 128, -(-sum(r["length"] for r in rows) // 128) + 2)
    assert len(jobs) < 20


def test_packing_real_documents_is_tight(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = pack_documents(docs, WORD_VOCABULARY).collect()
    bound = -(-sum(r["length"] for r in rows) // 2048)
    assert_packed(rows, 2048, bound + max(2, bound // 50))
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_packing_many_tiny_documents(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("a b")).alias("text")
    )
    rows = pack_documents(docs, WORD_VOCABULARY, capacity=256).collect()
    assert len(rows) == 6000
    assert_packed(rows, 256, -(-sum(r["length"] for r in rows) // 256) + 3)


@pytest.mark.parametrize("length, others", [(33, 0), (58, 0), (38, 40)])
def test_packing_fills_room_that_bundles_leave(spark, library, length, others):
    text = " ".join(["the"] * (length - 1))
    assert len(library.encode(text, add_special_tokens=False).ids) == length - 1
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < others, F.repeat(F.lit(text + " "), 25)).otherwise(F.lit(text)).alias("text"),
    )
    rows = pack_documents(docs, WORD_VOCABULARY).collect()
    assert len(rows) == 6000
    bound = -(-6000 // (2048 // length)) if not others else -(-sum(r["length"] for r in rows) // 2048) * 102 // 100
    assert_packed(rows, 2048, bound)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert decode(encode(none, RANKS, public_tokenizers.PATTERN, offsets=False), RANKS).count() == 0
    assert prefix_counts(none, WORD_VOCABULARY).count() == 0
    assert pack_documents(none, WORD_VOCABULARY).count() == 0
