"""Language-model scores: plain counts, probabilities that add up, and what scores may depend on."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from leadlift.llm import mixing, queries
from leadlift.llm.key_totals import ASKS, grouped, pack, places, totals, unpack

SCHEMA = "doc_id bigint, text string"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def plain_base(rows):
    """{place: (held out, n_tokens, n_known, train_tokens, base score)}."""
    held = [None if i is None else zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for h, (_, t) in zip(held, rows) if h is False for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for h, (_, text) in zip(held, rows):
        words = words_of(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out.append((h, len(words), sum(counts[w] > 0 for w in words), n, base))
    return out


def scored(spark, rows, parts=3, **tuning):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    df = spark.createDataFrame(rows, SCHEMA).repartitionByRange(parts, "doc_id").withColumn("held", held).withColumn("score", F.lit("x"))
    return mixing.lm_scores(df.withColumn("n_tokens", F.lit(None)), "held", **tuning).collect()


def check_base(found, rows):
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found), key=key)
    expected = plain_base(rows)
    assert got == sorted(((i, *e[:4]) for (i, _), e in zip(rows, expected)), key=key)
    ours = sorted((str(r["doc_id"]), r["n_tokens"], r["base_score"]) for r in found)
    theirs = sorted((str(i), e[1], e[4]) for (i, _), e in zip(rows, expected))
    for a, b in zip(ours, theirs):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9)


@pytest.mark.parametrize("fan, room", [(4096, 2_000_000), (4, 10), (2, 3), (16, 50)])
def test_totals_in_one_and_in_several_steps(spark, fan, room):
    draw = np.random.default_rng(fan)
    pool = draw.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2)
    rows, plain, asked = [], Counter(), {}
    for owner in range(23):
        keys = np.unique(draw.choice(pool, draw.integers(1, 60)))
        counts = draw.integers(0, 3, len(keys)).astype(np.uint64)
        rows.append((owner, bytearray(pack(keys)), bytearray(pack(counts))))
        asked[owner] = keys.tolist()
        plain.update(dict(zip(keys.tolist(), counts.tolist())))
    asks = spark.createDataFrame(rows, ASKS).repartition(5)
    found, known = totals(asks, sum(map(len, asked.values())), fan, room)
    got = {r["owner"]: unpack(r["sums"], "<u8").tolist() for r in found.collect()}
    assert got == {owner: [plain[k] for k in keys] for owner, keys in asked.items()}
    assert known == sum(n > 0 for n in plain.values())


def test_columns_of_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate([None, "", " \t\n", "A a", "É é\x85x", "one " * 20_000, "z" * 30_000])]
    rows += [(9, "same words here."), (9, "same words here."), (None, "no id here"), (2**40, "here\x1c and there")]
    rows += [(i, f"some {i} words that vary {i * i}") for i in range(100, 140)]
    found = scored(spark, rows)
    check_base(found, rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert {r["doc_id"] for r in found if r["bits_per_byte"] is None} == {0, 1}
    # small blocks and many ranges give the same counts
    check_base(scored(spark, rows, chars=60, texts=4, fan=2, room=10), rows)


def test_nothing_to_learn_from(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(i, "a few words") for i in held]
    found = scored(spark, rows)
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in found] == [(0, 0, 0.0)] * len(rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert scored(spark, rows[:1])[0]["score"] == pytest.approx(found[0]["score"])
    empty = spark.createDataFrame([], "doc_id bigint, text string, held boolean")
    assert mixing.lm_scores(empty, "held").collect() == []


def test_spelling_adds_up_to_one():
    draw = random.Random(2)
    words = ["".join(draw.choice("abc") for _ in range(draw.randrange(1, 6))).encode() for _ in range(300)]
    counts = np.zeros((mixing.ORDERS, mixing.SPELLING, 2), np.int32)
    for _, bits, slots in mixing.Spelled(sorted(set(words))).bits():
        for context, slot in enumerate(slots):
            np.add.at(counts[context], (slot, bits), 1)
    speller = mixing.Speller(counts)
    speller.learn(sorted(set(words)))
    # the next byte after "ab": all 256 bytes, told by the difference of two spelled words
    spelled = mixing.Spelled([b"ab" + bytes([c]) + b"!" for c in range(256) if c != 0x20])
    assert len(spelled.ends) == 255
    total = np.zeros(256)
    for byte in range(256):
        word = mixing.Spelled([b"ab\x00"])
        word.bytes = np.array([97, 98, byte, 32], np.uint8)  # contexts are those before the third byte
        logs = np.zeros(4)
        speller.tables()
        for place, bits, slots in word.bits():
            gate = speller.level[slots[-1]].astype(int) + place * (len(mixing.LEVELS) + 1)
            mixed = speller.weights[gate, mixing.ORDERS] * 0.3
            mixed = mixed + sum(speller.weights[gate, c] * speller.table[c][s] for c, s in enumerate(slots))
            low, beyond = speller.step(np.clip(mixed, -8, 8).astype(np.float32))
            flat = speller.refined.reshape(-1)
            low = low + gate * mixing.REFINED
            p = (mixing.squash(np.clip(mixed, -8, 8)) + flat[low] * (1 - beyond) + flat[low + 1] * beyond) / 2
            p = np.clip(p, mixing.LEAST, 1 - mixing.LEAST)
            logs += np.log(np.where(bits == 1, p, 1 - p))
        total[byte] = np.exp(logs[2])
    assert total.sum() == pytest.approx(1.0, abs=1e-5)
    # words like those learnt are told with fewer bits than others
    alike, unlike = speller.log_probabilities([b"abcab", b"zqxzq"])
    assert alike > unlike + 10


def test_frequent_words_are_spelled_too():
    """Counters and spelled probabilities have every word, however often training texts have it."""
    text = b"the cat and the dog and the sun and the sky and the sea the end".split()
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys([mixing.END, *text]))}
    tokens = np.array([vocabulary[w] for w in [*text, mixing.END]], np.int32)
    row = mixing.block_row(0, [(1, False, True, len(tokens), 70)], vocabulary, [tokens])
    row["ids"] = mixing.pack_ids(row["ids"], row.pop("held"))
    row["words"] = mixing.pack(np.frombuffer(row["words"], np.uint8))
    batch = pa.RecordBatch.from_pylist([row], mixing._BLOCKS)
    counted = pa.Table.from_batches(mixing.count_spelling([batch])).to_pydict()
    bits = 8 * mixing.ORDERS * sum(len(w) + 1 for w in vocabulary)
    assert sum(counted["zeros"]) + sum(counted["ones"]) == bits
    counts = np.zeros((mixing.ORDERS * mixing.SPELLING, 2), np.int32)
    counts[counted["slot"], 0], counts[counted["slot"], 1] = counted["zeros"], counted["ones"]
    speller = mixing.Speller(counts.reshape(mixing.ORDERS, mixing.SPELLING, 2))
    (told,) = mixing.spell([pa.RecordBatch.from_pylist([{**row, "word_sums": b"", "pair_sums": b""}], mixing._COUNTED)], speller)
    spelled = unpack(told.column("spelled")[0].as_py(), "<f4")
    assert len(spelled) == len(vocabulary) and np.isfinite(spelled).all()
    # words of the texts are told with fewer bits than another of the same length
    words = mixing.Block(row).words
    assert spelled[words.index(b"the")] > speller.log_probabilities([b"zqx"])[0] + 3


def test_spelling_works_on_distinct_contexts():
    """Bits are worked out once for bytes that have the same bytes before them, with the same result for every word."""
    draw = random.Random(4)
    words = [bytes(draw.choices(b"abc\xc3\xa9", k=draw.randrange(1, 9))) for _ in range(4000)]
    spelled = mixing.Spelled(words)
    each, where, times = spelled.distinct()
    assert len(each.bytes) < len(spelled.bytes) / 4 and times.sum() == len(spelled.bytes)
    assert (each.bytes[where] == spelled.bytes).all() and (np.bincount(where) == times).all()
    for mine, own in zip(each.contexts, spelled.contexts):
        assert (mine[where] == own).all()
    counts = np.zeros((mixing.ORDERS, mixing.SPELLING, 2), np.int32)
    for _, bits, slots in spelled.bits():
        for context, slot in enumerate(slots):
            np.add.at(counts[context], (slot, bits), 1)
    speller = mixing.Speller(counts)
    speller.learn(sorted(set(words)))
    together = speller.log_probabilities(words[:200])
    assert together == pytest.approx([speller.log_probabilities([w])[0] for w in words[:200]], rel=1e-6)


def test_counters_are_summed_packed():
    draw = np.random.default_rng(3)
    total, packed = np.zeros((mixing.ORDERS * mixing.SPELLING, 2), np.int64), []
    for most in (5, 2**31 - 1, 2**31 - 1):
        slots = np.unique(draw.integers(0, len(total), 500))
        own = draw.integers(0, most, (len(slots), 2))
        own[0] = most
        total[slots] += own
        batch = pa.RecordBatch.from_arrays([pa.array(a) for a in (slots, own[:, 0], own[:, 1])], ["slot", "zeros", "ones"])
        packed += mixing.pack_counters([batch])
    table, found = pa.Table.from_batches(packed), []
    for number in range(mixing.RANGES):
        row = mixing.sum_counters(table.filter(pa.compute.equal(table["range"], number))).to_pylist()
        assert [r["range"] for r in row] == [number]
        found.append(unpack(row[0]["counters"], "<i4"))
    assert (np.concatenate(found).reshape(-1, 2) == np.minimum(total, 2**31 - 1)).all()
    assert sum(len(c) for c in table["counters"].to_pylist()) < total.size  # far less than a number each


@pytest.mark.parametrize("cached", [8192, 7])
def test_rates_are_those_of_plain_rounds(monkeypatch, cached):
    monkeypatch.setattr(mixing, "CACHED", cached)
    draw = np.random.default_rng(6)
    n = 500
    open_ = draw.random((mixing.PARTS, n)) < 0.8
    parts = (draw.random((mixing.PARTS, n)) ** 3 * open_).astype(np.float32)
    spelled = (-40 * draw.random(n)).astype(np.float32)
    spelled[:9], parts[:, :9] = -200, 0  # beyond what 32-bit numbers hold
    cell = draw.integers(0, 128, n)
    p = np.tile(np.array(mixing.PRIOR, np.float32)[:, None], (1, 128))
    for _ in range(mixing.ROUNDS):
        _, share = mixing.shares(parts, spelled, p[:, cell] * open_)
        left = mixing.lefts(share)
        for part in range(mixing.PARTS):
            often = np.bincount(cell, left[part] * open_[part], 128)
            p[part] = (np.bincount(cell, share[part] * open_[part], 128) + 2 * p[part]) / (often + 2)
        np.clip(p, mixing.LEAST, 1 - mixing.LEAST, out=p)
    ours = mixing.best_shares(parts, spelled, open_, cell)
    assert ours[0] == pytest.approx(share, abs=1e-4) and ours[1] == pytest.approx(left, abs=1e-4)


def test_shares_are_a_distribution():
    draw = np.random.default_rng(1)
    # three parts and spelling over the same ten words
    parts = draw.dirichlet(np.ones(10), 3)
    spelled = np.log(draw.dirichlet(np.ones(10)))
    p = np.tile(np.array([[0.4], [0.3], [0.8]]), (1, 10))
    log_p, share = mixing.shares(parts, spelled, p)
    assert np.exp(log_p).sum() == pytest.approx(1.0)
    assert (share.sum(axis=0) < 1).all()


def test_what_scores_depend_on(spark):
    """Held-out texts change nobody else's score; a copied text scores better; more training texts help."""
    draw = random.Random(8)
    common = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(400)]

    def text():
        return " ".join(common[min(int(draw.expovariate(0.02)), 399)] for _ in range(120))

    rows = [(i, text()) for i in range(280)]
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2]
    learnt = [i for i, _ in rows if i not in held]
    # a text of rare words, a copy of it, and its words in another order
    rare = ["".join(draw.choice("abcdefgh") for _ in range(9)) for _ in range(120)]
    rows[learnt[0]] = (learnt[0], " ".join(rare))
    rows[held[0]] = (held[0], " ".join(rare))
    rows[held[1]] = (held[1], " ".join(sorted(rare)))
    found = {r["doc_id"]: r["score"] for r in scored(spark, rows, 1)}
    held, copied, shuffled = held[2:], found[held[0]], found[held[1]]
    assert copied > shuffled / 2
    plain = [found[i] for i in held[1:]]
    base = {i: e[4] for (i, _), e in zip(rows, plain_base(rows))}
    # words drawn one by one leave nothing to mix: hardly worse than their frequencies
    assert sum(found[i] for i in held) > 1.02 * sum(base[i] for i in held)
    # another held-out text of the same size
    other = list(rows)
    other[held[1]] = (held[1], rows[held[1]][1].translate(str.maketrans("abcdefgh", "ijklmnop")))
    again = {r["doc_id"]: r["score"] for r in scored(spark, other, 1)}
    for i, _ in rows:
        if i != held[1]:
            assert again[i] == pytest.approx(found[i], rel=1e-6)
    assert again[held[1]] < found[held[1]]
    fewer = [r for r in rows if r[0] in held or r[0] % 4 == 0]  # a quarter of the training texts
    less = {r["doc_id"]: r["score"] for r in scored(spark, fewer)}
    assert sum(less[i] for i in held[1:]) < sum(plain)


def test_query_on_the_table(spark, medium):
    rows = [tuple(r) for r in spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op13_lm_score(spark, medium).collect()
    check_base(found, rows)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def blocks_of(texts, monkeypatch, chars=mixing.BLOCK_CHARS, most=mixing.BLOCK_TEXTS, sizes=(3, 1, 50)):
    """Blocks made of one task's ``texts``, given in batches of these sizes."""

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 5)  # noqa: N815

    monkeypatch.setattr(mixing, "TaskContext", Task)
    rows = [(i, i % 3 == 0, t) for i, t in enumerate(texts)]
    batches, start = [], 0
    for size in sizes:
        columns = list(zip(*rows[start : start + size])) or [(), (), ()]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.bool_(), pa.string()))]
        batches.append(pa.RecordBatch.from_arrays(arrays, ["doc_id", "held", "text"]))
        start += size
    return list(mixing.make_blocks(iter(batches), chars, most))


@pytest.mark.parametrize("chars, most", [(3_000_000, 40_000), (25, 40_000), (3_000_000, 4), (1, 1)])
def test_blocks_have_the_words_of_plain_splitting(monkeypatch, chars, most):
    texts = ["a  b A", " lead", "trail\n", None, "", " \t\x0b\x0c\r\n", "é\x85É \x1cx\xa0Y  z", "b" * 40, "a b", "\x0bA\x0c", "ß ẞ b"]
    blocks = [mixing.Block(row) for row in mixing.rows_of(iter(blocks_of(texts, monkeypatch, chars, most)))]
    found = []
    for k, block in enumerate(blocks):
        assert block.number == (k << 24) + 5 and block.words[0] == mixing.END and len(set(block.words)) == len(block.words)
        assert len(block.lengths) <= most and sum(block.bytes[:-1]) < chars
        words = iter(block.tokens.tolist())
        for doc_id, held, n, size in zip(*block.ids.to_pydict().values(), block.lengths.tolist(), block.bytes.tolist()):
            found.append((doc_id, held, [block.words[next(words)] for _ in range(n)], size))
    plain = [(t or "").encode() for t in texts]
    assert found == [(i, i % 3 == 0, [*t.lower().split(), b""], len(t)) for i, t in enumerate(plain)]


@pytest.mark.parametrize("bits, shift", [(3, 0), (40, 24), (50, 5), (64, 0), (0, 9)])
def test_grouped_keys(bits, shift):
    draw = np.random.default_rng(bits)
    keys = draw.integers(0, 2**bits - 1, 5000, np.uint64, endpoint=True) if bits else np.full(50, 7, np.uint64)
    keys = np.concatenate([keys, keys[::3], keys[:9]]) << np.uint64(shift)
    order, ordered, firsts = grouped(keys)
    assert order.tolist() == np.argsort(keys, kind="stable").tolist() and (keys[order] == ordered).all()
    distinct, where = np.unique(keys, return_inverse=True)
    assert (ordered[firsts] == distinct).all() and (places(order, firsts) == where).all()
    assert [len(a) for a in grouped(keys[:0])] == [0, 0, 0]


def told_by(texts, monkeypatch):
    """(block, row) of one block with its own totals as those of all texts."""
    (batch,) = blocks_of(texts, monkeypatch, sizes=(len(texts),))
    (row,) = batch.to_pylist()
    block = mixing.Block(row)
    block.flat()
    for name, (keys, where) in (("word_sums", block.word_keys()), ("pair_sums", block.pair_keys(mixing.pair_bits(1000)))):
        where = where if name == "pair_sums" else where[block.tokens]
        row[name] = pack(np.bincount(where[block.learnt_tokens()], minlength=len(keys)).astype(np.uint64))
    row["spelled"] = pack(np.array([-3.0 * len(w) - 1 for w in block.words], np.float32))
    return block, row


def odd_texts():
    draw = random.Random(12)
    words = ["".join(draw.choices("abcd", k=draw.randrange(1, 5))) for _ in range(60)]
    texts = [" ".join(draw.choices(words, k=k)) for k in (0, 1, 31, 32, 33, 150, 70, 64, 5, 200)]
    return [*texts, "z" * 90]  # spelled with less than 32-bit numbers hold


def test_tables_of_decisions_are_sent_packed(monkeypatch):
    """A task sends a row for a range of places, not one for each place; sums are those of plain counting."""
    block, row = told_by(odd_texts(), monkeypatch)
    sent = pa.Table.from_batches(mixing.learn_parts([pa.RecordBatch.from_pylist([row], mixing._COUNTED)], (1000, 900)))
    assert sent.num_rows == mixing.RANGES
    tables = np.zeros((mixing.RANGES, 2, mixing.PLACES))
    for number in range(mixing.RANGES):
        twice = pa.concat_tables([sent.filter(pa.compute.equal(sent["range"], number))] * 2)
        (summed,) = mixing.sum_tables(twice).to_pylist()
        assert summed["range"] == number
        tables[number] = unpack(summed["counters"], "<f8").reshape(2, -1)
    tables = tables.swapaxes(0, 1).reshape(2, -1)[:, : mixing.PARTS * mixing.OFFSETS[-1]].reshape(2, mixing.PARTS, -1)
    told = mixing.Told(block, row, (1000, 900), without_own=True)
    own = block.learnt_tokens()
    cell = told.gate * 32 + told.contexts[0]
    share, left = mixing.best_shares(told.parts[:, own], told.spelled[own], told.open[:, own], cell[own])
    for part in range(mixing.PARTS):
        for context, values in enumerate(told.contexts):
            place = mixing.OFFSETS[context] + values[own]
            for k, amount in enumerate((left, share)):
                plain = np.bincount(place, amount[part] * told.open[part, own], mixing.OFFSETS[-1])
                mine = slice(mixing.OFFSETS[context], mixing.OFFSETS[context + 1])
                assert tables[k, part, mine] == pytest.approx(2 * plain[mine], rel=1e-5, abs=1e-6)


@pytest.mark.parametrize("gathered", [1 << 16, 40])
def test_mixing_follows_every_text_as_one_by_one(monkeypatch, gathered):
    monkeypatch.setattr(mixing, "GATHERED", gathered)
    block, row = told_by(odd_texts(), monkeypatch)
    told = mixing.Told(block, row, (1000, 900), without_own=False)
    odds = np.random.default_rng(2).normal(0, 2, (mixing.PARTS, mixing.OFFSETS[-1])).astype(np.float32)
    found = mixing.TextMixer(len(block.lengths)).run(told, block.starts, block.lengths, odds)
    expected = []
    for start, length in zip(block.starts.tolist(), block.lengths.tolist()):
        weights = np.full((4, mixing.PARTS, mixing.CONTEXTS), 1 / mixing.CONTEXTS)
        refined = np.tile(mixing.squash(np.linspace(-8, 8, mixing.REFINED)), (mixing.PARTS, 1))
        for at in range(0, length, mixing.STEP):
            change, hit, often = np.zeros_like(weights), np.zeros_like(refined), np.zeros_like(refined)
            for i in range(start + at, start + min(at + mixing.STEP, length)):
                place = [o + c[i] for o, c in zip(mixing.OFFSETS, told.contexts)]
                rest, logs, seen = 1.0, [], []
                for part in range(mixing.PARTS):
                    inputs = odds[part, place].astype(float)
                    total = np.clip(weights[told.gate[i], part] @ inputs, -8, 8)
                    step = (total + 8) * (mixing.REFINED - 1) / 16
                    low = min(int(step), mixing.REFINED - 2)
                    fine = refined[part, low] * (1 - step + low) + refined[part, low + 1] * (step - low)
                    q = np.clip((3 * mixing.squash(total) + fine) / 4, mixing.LEAST, 1 - mixing.LEAST) * told.open[part, i]
                    logs.append(rest * q * told.parts[part, i])
                    rest *= 1 - q
                    seen.append((inputs, mixing.squash(total), low + (step - low > 0.5)))
                spelt = np.log(rest) + float(told.spelled[i])
                log_p = np.logaddexp(np.log(sum(logs)), spelt) if sum(logs) else spelt
                expected.append(log_p)
                left = 1.0
                for part, (inputs, mixed, near) in enumerate(seen):
                    share = logs[part] / np.exp(log_p)
                    weight = max(left, 0) * told.open[part, i]
                    change[told.gate[i], part] += (share - weight * mixed) * inputs
                    hit[part, near] += share
                    often[part, near] += weight
                    left -= share
            weights += mixing.RATE * change
            refined = np.clip((refined * 20 + hit) / (20 + often), mixing.LEAST, 1 - mixing.LEAST)
    assert found == pytest.approx(expected, rel=2e-3)
