"""Language-model scores by logistic context mixing.

A text is its words, A-Z lower-cased, then one end. A word is coded by binary decisions: does the pair with the word
before tell it, else what this text said before, else its frequency, else it is spelled, byte by byte and bit by bit.
Every decision is a bit whose probability comes from several hashed contexts: each context's predictor gives the log
odds it has seen, the mixer adds them up with weights that a small gating context selects, and the sum is squashed back.

* Spelling: contexts of up to ``ORDERS`` bytes before, gated by how much the longest has seen and the bit's place.
  A last table, by gate and sum, refines the probability. Weights and table are learnt online over the words of each
  block of training texts, then averaged. Every word can be spelled, however often it was seen.
* Which part tells a word: contexts are how often the word before was seen, what told the last three words, the word
  before, and how far the text has come; the gate is what told the last word. Weights start alike in every text and
  follow the gradient of its code length, ``STEP`` words at a time; a table of refined probabilities per text follows
  too. So a score depends on the training texts and on the text itself, never on other texts.

All parts of a word's probability add up: ``a * pair + (1 - a) * (b * said + (1 - b) * (g * frequency + (1 - g) *
spelling))``. Predictors of a, b and g are learnt without the text at hand, so they expect what unseen texts bring.

What is gathered: word counts and counts of hashed word pairs over all training texts, which grow with them and stay
distributed (see ``key_totals``), and bounded tables: ``SPELLING`` counters per context and ``2 ** PRIOR_BITS`` per
word-before predictor, which are summed and broadcast.

Texts are worked on in blocks of about ``BLOCK_CHARS``, written once; only hashed keys and counts move between them.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.llm.key_totals import ASKS, grouped, pack, places, totals, unpack
from leadlift.sources.shipping import ship
from leadlift.sources.staging import stage

ORDERS = 4  # bytes before, up to which spelling contexts reach
BLOCK_CHARS, BLOCK_TEXTS = 3_000_000, 40_000
SPELL_BITS = 18
SPELLING = 1 << SPELL_BITS  # counters of each spelling context
RANGES = 64  # of slots, summed apart
PRIOR_BITS = 16
STEP = 32  # words between two updates of a text's weights
RATE, SPELL_RATE = 0.02, 0.3
LEAST = 1e-4  # no decision is surer than this
PARTS = 3  # decisions per word: pair, said before, frequency
CONTEXTS = 4
REFINED = 12  # steps of the refining tables
END = b""

BLOCKS = (
    "block bigint, docs bigint, tokens bigint, learnt_tokens bigint, ids binary, learnt binary, lengths binary, "
    "bytes binary, words binary, text_tokens binary"
)
COUNTED = f"{BLOCKS}, word_sums binary, pair_sums binary, spelled binary"
COUNTERS = "range bigint, counters binary"
RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
    "score double, n_bytes bigint, bits_per_byte double"
)
_LN10 = np.log(10.0)


def squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1.0 - p))


# ---- blocks -------------------------------------------------------------------------------------------------------


def block_row(number: int, docs: list[tuple], vocabulary: Collection[bytes], tokens: list[np.ndarray]) -> dict:
    """``docs`` are (id, held out, learnt from, words, bytes), ``tokens`` places in ``vocabulary``."""
    ids, held, learnt, lengths, sizes = zip(*docs, strict=True)
    lengths, learnt = np.asarray(lengths, np.int64), np.asarray(learnt, np.uint8)
    # frequent words get small numbers, which take less room; the end stays the first
    told = np.concatenate(tokens)
    counts = np.bincount(told, minlength=len(vocabulary))
    counts[0] = len(told) + 1
    order = np.argsort(-counts, kind="stable")
    number_of = np.empty(len(order), np.int32)
    number_of[order] = np.arange(len(order))
    words = list(vocabulary)
    return {
        "block": number,
        "docs": len(docs),
        "tokens": int(lengths.sum()),
        "learnt_tokens": int(lengths[learnt > 0].sum()),
        "ids": pa.array(ids, pa.int64()),
        "held": held,
        "learnt": pack(learnt),
        "lengths": pack(lengths),
        "bytes": pack(np.asarray(sizes, np.int64)),
        "words": b" ".join([words[i] for i in order.tolist()]),
        "text_tokens": pack(number_of[told]),
    }


def make_blocks(batches: Iterator[pa.RecordBatch], chars: int, texts: int) -> Iterator[pa.RecordBatch]:
    """Blocks of (doc_id, held out, text) rows; a block's number has the task's in its last bits."""
    part = TaskContext.get().partitionId()
    sequence, pieces, size, rows = 0, [], 0, 0

    def out() -> pa.RecordBatch:
        row = block_row((sequence << 24) + part, *tokenized(pieces))
        row["ids"] = pack_ids(row["ids"], row.pop("held"))
        row["words"] = pack(np.frombuffer(row["words"], np.uint8))
        return pa.RecordBatch.from_pylist([row], _BLOCKS)

    for batch in batches:
        upto = np.cumsum(pc.binary_length(batch.column(2)).fill_null(0).to_numpy(), dtype=np.int64)
        start = 0
        while start < len(upto):
            # up to the text that fills the block
            before = int(upto[start - 1]) if start else 0
            end = int(np.searchsorted(upto, before + chars - size)) + 1
            end = min(end, start + texts - rows, len(upto))
            pieces.append(batch.slice(start, end - start))
            size, rows, start = size + int(upto[end - 1]) - before, rows + end - start, end
            if size >= chars or rows >= texts:
                yield out()
                sequence, pieces, size, rows = sequence + 1, [], 0, 0
                pa.default_memory_pool().release_unused()  # the worker goes on to other tasks
    if pieces:
        yield out()


def tokenized(pieces: list[pa.RecordBatch]) -> tuple[list[tuple], list[bytes], list[np.ndarray]]:
    """(docs, vocabulary, tokens) as ``block_row`` takes them, of (doc_id, held out, text) rows."""
    table = pa.Table.from_batches(pieces)
    content = table.column(2).cast(pa.large_string()).combine_chunks().fill_null("")
    split = pc.ascii_split_whitespace(pc.ascii_lower(content))  # A-Z only, and the six blanks
    # blanks at the edges of a text give empty words
    bounds, words = split.offsets.to_numpy(), split.values
    real = np.append(0, np.cumsum(pc.binary_length(words).to_numpy() > 0))
    lengths = np.diff(real[bounds])
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    tokens = np.zeros(len(words) + len(lengths), np.int32)  # an end after each text
    tokens[np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)] = words.indices.to_numpy() + 1
    ids, held = table.column(0).to_pylist(), table.column(1).to_pylist()
    sizes = pc.binary_length(content).to_pylist()
    docs = [(i, h, h is False, n + 1, b) for i, h, n, b in zip(ids, held, lengths.tolist(), sizes, strict=True)]
    return docs, [END, *words.dictionary.cast(pa.large_binary()).to_pylist()], [tokens]


_BLOCKS = pa.schema(
    [("block", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64()), ("learnt_tokens", pa.int64())]
    + [(c, pa.binary()) for c in ("ids", "learnt", "lengths", "bytes", "words", "text_tokens")]
)
_COUNTED = pa.schema([*_BLOCKS, *((c, pa.binary()) for c in ("word_sums", "pair_sums", "spelled"))])


def pack_ids(ids: pa.Array, held: tuple) -> bytes:
    table = pa.RecordBatch.from_arrays([ids, pa.array(held, pa.bool_())], ["doc_id", "held_out"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_batch(table)
    return sink.getvalue().to_pybytes()


class Block:
    """A block's texts as numbers; tokens are flat, ``doc`` and ``at`` say where each one lies."""

    def __init__(self, row: dict):
        self.number = row["block"]
        with pa.ipc.open_stream(row["ids"]) as reader:
            self.ids = reader.read_all()
        self.learnt = unpack(row["learnt"], "u1").astype(bool)
        self.lengths = unpack(row["lengths"], "<i8")
        self.bytes = unpack(row["bytes"], "<i8")
        self.words = unpack(row["words"], "u1").tobytes().split(b" ")
        self.tokens = unpack(row["text_tokens"], "<i4").astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))

    def flat(self) -> None:
        """The columns per token that counting and scoring need."""
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.at = np.arange(len(self.tokens)) - self.starts[self.doc]
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = 0  # the end of a text is also what comes before one
        self.before = before

    def word_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys of the words, for each word its place among them)."""
        return np.unique(self.hashes, return_inverse=True)

    def pair_keys(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys of the pairs, their first ``bits`` bits used, for each token the place of the pair it ends)."""
        first = self.hashes[self.before] * np.uint64(0x9E3779B97F4A7C15)
        key = (first ^ (first >> np.uint64(29))) + self.hashes[self.tokens]
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        rest = np.uint64(64 - bits)
        order, key, firsts = grouped((key ^ (key >> np.uint64(32))) >> rest << rest)
        return key[firsts], places(order, firsts)

    def learnt_tokens(self) -> np.ndarray:
        return np.repeat(self.learnt, self.lengths)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def pair_bits(tokens: int) -> int:
    """Bits of a pair's key: so many that at most one of 2 ** 10 keys not seen falls on one that is."""
    return min(64, 10 + max(tokens, 1).bit_length())


def ask(batches: Iterator[pa.RecordBatch], bits: int = 0) -> Iterator[pa.RecordBatch]:
    """What a block asks for: the keys of its words, or with ``bits`` of its pairs, with its counts in training texts."""
    for row in rows_of(batches):
        block = Block(row)
        block.flat()
        keys, where = block.pair_keys(bits) if bits else block.word_keys()
        where = where if bits else where[block.tokens]
        counts = np.bincount(where[block.learnt_tokens()], minlength=len(keys)).astype(np.uint64)
        yield pa.RecordBatch.from_pydict(
            {"owner": pa.array([block.number], pa.int64()), "keys": [pack(keys)], "counts": [pack(counts)]}
        )


# ---- spelling -----------------------------------------------------------------------------------------------------


class Spelled:
    """The bytes of words, each with a blank after it, and the hashed contexts before each byte."""

    def __init__(self, words: list[bytes]):
        # so many blanks between words that before a word's first byte there are only blanks
        blanks = b" " * ORDERS
        joined = np.frombuffer(b"".join([b" " * 7, blanks.join([*words, b""])]), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.ends = np.cumsum(sizes) - 1
        at = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(words)) * (ORDERS - 1), sizes)
        # the byte and those before it that contexts have
        eight = np.ndarray((len(joined) - 7,), ">u8", joined, strides=(1,))
        self.gram = eight[at].astype(np.uint64) & np.uint64((1 << 8 * (ORDERS + 1)) - 1)
        self.bytes = self.gram.astype(np.uint8)

    @cached_property
    def contexts(self) -> list[np.ndarray]:
        hashed, contexts = np.zeros(len(self.gram), np.uint32), []
        for k in range(1, ORDERS + 1):
            byte = (self.gram >> np.uint64(8 * k)).astype(np.uint8)
            hashed = hashed * np.uint32(0x2F0B4C47) + byte + np.uint32(1)
            contexts.append(hashed * np.uint32(0x2545F491) + np.uint32(k))
        return contexts

    def distinct(self) -> tuple[Spelled, np.ndarray, np.ndarray]:
        """(one of all bytes that have the same bytes before them, for each byte its place there, how often each comes).

        What a byte's bits depend on is the same wherever it comes, and few of a block's bytes differ in that. The most
        frequent ones come first, so that what is looked up most lies together.
        """
        order, gram, firsts = grouped(self.gram)
        times = np.diff(np.append(firsts, len(gram)))
        often = np.argsort(-times, kind="stable")
        number = np.empty(len(often), np.int64)
        number[often] = np.arange(len(often))
        where = np.empty(len(gram), np.int64)
        where[order] = np.repeat(number, times)
        each = Spelled.__new__(Spelled)
        each.gram = gram[firsts[often]]
        each.bytes = each.gram.astype(np.uint8)
        return each, where, times[often]

    def bits(self) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """(place of the bit, the bits, the counters' numbers by context)."""
        for k in range(8):
            node = ((1 << k) | (self.bytes >> (8 - k)).astype(np.uint32)) * np.uint32(0x9E3779B1)
            slots = [((c ^ node) * np.uint32(0x41C64E6D)) >> np.uint32(32 - SPELL_BITS) for c in self.contexts]
            yield k, (self.bytes >> (7 - k)) & 1, slots


def word_counts(block: Block, row: dict) -> np.ndarray:
    """How often all training texts have each of the block's words."""
    _, where = block.word_keys()
    return unpack(row["word_sums"], "<u8").astype(np.float64)[where]


def learnt_numbers(block: Block) -> np.ndarray:
    return np.flatnonzero(np.bincount(block.tokens[block.learnt_tokens()], minlength=len(block.words)))


def learnt_words(block: Block) -> list[bytes]:
    """The words of a block's training texts, each once, in the order of their hashes."""
    seen = learnt_numbers(block)
    return [block.words[i] for i in seen[np.argsort(block.hashes[seen])].tolist()]


def count_spelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, zeros, ones) of a task's blocks: every word of a block's training texts counts once."""
    counts = np.zeros((ORDERS, 2 * SPELLING), np.int32)
    for row in rows_of(batches):
        block = Block(row)
        words = [block.words[i] for i in learnt_numbers(block).tolist()]
        if words:
            spelled, _, times = Spelled(words).distinct()
            times = times.astype(np.int32)
            for _, bits, slots in spelled.bits():
                for context, slot in enumerate(slots):
                    np.add.at(counts[context], slot * np.uint32(2) + bits, times)
    flat = counts.reshape(-1, 2)
    used = np.flatnonzero(flat.sum(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), *(pa.array(flat[used, i], pa.int64()) for i in (0, 1))], ["slot", "zeros", "ones"]
    )


def pack_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(range, counters) of what ``count_spelling`` gives: all counters of a range of slots, packed."""
    for batch in batches:
        counts = np.zeros((ORDERS * SPELLING, 2), np.int64)
        slots, zeros, ones = (c.to_numpy() for c in batch.columns)
        counts[slots, 0], counts[slots, 1] = zeros, ones
        parts = counts.reshape(RANGES, -1)
        yield pa.RecordBatch.from_pydict({"range": pa.array(range(RANGES), pa.int64()), "counters": list(map(pack, parts))})


def sum_counters(table: pa.Table) -> pa.Table:
    """One row for a range, its counters summed; a counter stops at the largest 32-bit number."""
    total = np.zeros(2 * ORDERS * SPELLING // RANGES, np.int64)
    for packed in table.column("counters"):
        total += unpack(packed.as_py(), "<i8")
    counters = pack(np.minimum(total, 2**31 - 1).astype(np.int32))
    return pa.table({"range": table.column("range")[:1], "counters": [counters]})


LEVELS = (1, 5, 40)  # how much the longest context has seen
GATES = 8 * (len(LEVELS) + 1)


class Speller:
    """Log probabilities of spelled words from counters (ORDERS, SPELLING, 2), weights and the refining table."""

    def __init__(self, counts: np.ndarray, weights: np.ndarray | None = None, refined: np.ndarray | None = None):
        self.counts = counts
        self.weights = np.full((GATES, ORDERS + 1), 0.3, np.float32) if weights is None else weights
        self.refined = np.tile(squash(np.linspace(-8, 8, REFINED)), (GATES, 1)) if refined is None else refined

    @staticmethod
    def odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
        return np.log((ones + np.float32(0.3)) / (zeros + np.float32(0.3)))

    def learn(self, words: list[bytes], chunk: int = 4096) -> None:
        """One online pass over ``words``, which are among those counted: each bit is told without its own count."""
        flat = self.counts.reshape(ORDERS, -1)
        spelled, where, _ = Spelled(words).distinct()
        for place, bits, slots in spelled.bits():
            one = bits.astype(np.uint32)
            sign = one.astype(np.float32) * 2 - 1
            x = np.empty((len(bits), ORDERS), np.float32)
            for context, slot in enumerate(slots):
                cell = slot * np.uint32(2) + one
                same = np.maximum(flat[context].take(cell) - 1, 0).astype(np.float32)
                other = flat[context].take(cell ^ np.uint32(1)).astype(np.float32)
                x[:, context] = self.odds(other, same) * sign
            level = sum((same + other >= least).astype(np.uint8) for least in LEVELS).take(where)
            for gate in range(len(LEVELS) + 1):
                mine = where.take(np.flatnonzero(level == gate))
                self.follow(place * (len(LEVELS) + 1) + gate, x, bits, mine, chunk)

    def follow(self, gate: int, x: np.ndarray, bits: np.ndarray, mine: np.ndarray, chunk: int) -> None:
        """``mine`` are the bits to follow, one after the other, as places in ``x`` and ``bits``."""
        weights, refined = self.weights[gate], self.refined[gate]
        always, scale = np.float32(0.3), np.float32((REFINED - 1) / 16)  # the last input is the same for all bits
        for start in range(0, len(mine), chunk):
            own = mine[start : start + chunk]
            inputs, y = x.take(own, axis=0), bits.take(own).astype(np.float32)
            mixed = inputs @ weights[:ORDERS]
            mixed += always * weights[ORDERS]
            np.clip(mixed, -8, 8, out=mixed)
            near = (mixed + np.float32(8)) * scale
            near -= np.float32(0.5)
            np.ceil(near, out=near)
            # squashed in place: what is left of the bit
            np.negative(mixed, out=mixed)
            np.exp(mixed, out=mixed)
            mixed += 1
            np.reciprocal(mixed, out=mixed)
            error = y - mixed
            rate = np.float32(SPELL_RATE / max(len(y), 64))
            weights[:ORDERS] += rate * (error @ inputs)
            weights[ORDERS] += rate * always * error.sum()
            # zeros and ones of a step lie side by side
            near *= 2
            near += y
            often = np.bincount(near.astype(np.int64), minlength=2 * REFINED)
            ones = often[1::2]
            often = often[::2] + ones
            refined += (ones - often * refined) / (often + 500)

    @staticmethod
    def step(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The refining table's entry below each sum, and how far the sum lies beyond it."""
        place = (mixed + np.float32(8)) * np.float32((REFINED - 1) / 16)
        low = np.minimum(place.astype(np.int64), REFINED - 2)
        return low, place - low.astype(np.float32)

    def tables(self) -> None:
        """What telling words needs, per counter: its log odds, and its level for the longest context."""
        self.table = [self.odds(c[:, 0].astype(np.float32), c[:, 1].astype(np.float32)) for c in self.counts]
        self.level = np.digitize(self.counts[-1].sum(axis=1), LEVELS).astype(np.uint8)

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        if not hasattr(self, "table"):
            self.tables()
        spelled = Spelled(words)
        each, where, _ = spelled.distinct()
        total = np.zeros(len(each.bytes))
        flat, gates = self.refined.reshape(-1), len(LEVELS) + 1
        for place, bits, slots in each.bits():
            gate = self.level[slots[-1]].astype(np.int64) + place * gates
            mixed = np.take(self.weights[:, ORDERS], gate) * np.float32(0.3)
            for context, slot in enumerate(slots):
                mixed += np.take(self.weights[:, context], gate) * self.table[context][slot]
            np.clip(mixed, -8, 8, out=mixed)
            low, beyond = self.step(mixed)
            low += gate * REFINED
            fine = flat[low] * (1 - beyond) + flat[low + 1] * beyond
            p = np.clip((squash(mixed) + fine) / 2, LEAST, 1 - LEAST)
            total += np.log(np.where(bits == 1, p, 1 - p))
        return np.add.reduceat(total[where], np.concatenate([[0], spelled.ends[:-1] + 1]))


def learn_speller(batches: Iterator[pa.RecordBatch], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(weights, refined, words): what one online pass over each block of a task arrives at, summed by words."""
    weights, refined, words = np.zeros((GATES, ORDERS + 1)), np.zeros((GATES, REFINED)), 0
    for row in rows_of(batches):
        own = learnt_words(Block(row))
        if own:
            speller = Speller(counts)
            speller.learn(own)
            weights += speller.weights * len(own)
            refined += speller.refined * len(own)
            words += len(own)
    # one row per number, so that Spark adds them up
    values = np.concatenate([weights.reshape(-1), refined.reshape(-1), [words]])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["place", "value"])


def spell(batches: Iterator[pa.RecordBatch], speller: Speller) -> Iterator[pa.RecordBatch]:
    """Blocks with the logarithm of every word's spelled probability, which both learning and scoring read."""
    for row in rows_of(batches):
        spelled = speller.log_probabilities(Block(row).words).astype(np.float32)
        yield pa.RecordBatch.from_pylist([{**row, "spelled": pack(spelled)}], _COUNTED)


# ---- which part tells a word --------------------------------------------------------------------------------------


def ranks_within(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each value came before, and how often it comes at all."""
    n = len(key)
    order, _, firsts = grouped(key.astype(np.uint64))
    sizes = np.diff(np.append(firsts, n))
    rank, size = np.empty(n, np.float32), np.empty(n, np.float32)
    rank[order] = np.arange(n) - np.repeat(firsts, sizes)
    size[order] = np.repeat(sizes, sizes)
    return rank, size


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a), np.float32), where=b > 0, casting="same_kind")


class Told:
    """Per token: the three parts' probabilities, the spelled one's logarithm, and the contexts of the decisions.

    With ``without_own``, counts are those of all training texts but the token's own.
    """

    def __init__(self, block: Block, row: dict, sizes: tuple[int, int], without_own: bool):
        tokens, all_tokens = sizes
        block.flat()
        self.counts = word_counts(block, row)
        _, pair_at = block.pair_keys(pair_bits(tokens))
        counts = self.counts.astype(np.float32)
        seen, prior = counts[block.tokens], counts[block.before]
        pairs = unpack(row["pair_sums"], "<u8").astype(np.float32)[pair_at]
        total = np.full(len(block.tokens), all_tokens, np.float32)
        rank, size = ranks_within(block.doc * len(block.words) + block.tokens)
        if without_own:
            own = block.learnt_tokens()
            seen = seen - own * size
            pairs = pairs - own * ranks_within(block.doc * (int(pair_at.max()) + 1) + pair_at)[1]
            # a text has a word before another one as often as it has the word, and its start once
            before = np.append(np.float32(1), size[:-1])
            before[block.starts] = 1
            prior = prior - own * before
            total = total - own * block.lengths[block.doc].astype(np.float32)
        self.parts = np.stack([ratio(pairs, prior), ratio(rank, block.at.astype(np.float32)), ratio(seen, total)])
        # whether a decision is open at all, which the reader of a code would know too
        self.open = np.stack([prior > 0, block.at > 0, total > 0])
        self.spelled = unpack(row["spelled"], "<f4")[block.tokens]
        with np.errstate(divide="ignore"):
            odds = np.log(self.parts) + np.log(np.array([[0.5], [0.2], [0.2]], np.float32))
        best = np.argmax(np.vstack([odds, self.spelled + np.float32(np.log(0.1))]), axis=0).astype(np.int16)
        last = []
        for k in range(1, 4):
            told = np.zeros_like(best)
            told[k:] = best[:-k]
            told[block.at < k] = 0
            last.append(told)
        self.gate = last[0].astype(np.int64)
        hashed = (block.hashes >> np.uint64(64 - PRIOR_BITS)).astype(np.int64)[block.before]
        frequent = np.minimum(np.frexp(prior + 1)[1] - 1, 31).astype(np.int64)
        far = np.minimum(np.frexp(block.at + 1.0)[1] - 1, 15).astype(np.int64)
        self.contexts = [frequent, self.gate * 16 + last[1] * 4 + last[2], hashed, far]


WIDTHS = (32, 64, 1 << PRIOR_BITS, 16)
OFFSETS = np.concatenate([[0], np.cumsum(WIDTHS)])
PLACES = -(-PARTS * int(OFFSETS[-1]) // RANGES)  # of each range
PRIOR = (0.3, 0.1, 0.8)  # where learning the decisions' rates starts
ROUNDS = 8
CACHED = 8192  # tokens worked on at a time, so that what is computed on the way stays in the cache
GATHERED = 1 << 16  # tokens that steps of scoring fetch together
ADD_UP = np.tile(np.eye(PARTS, PARTS + 1, dtype=np.float32), CONTEXTS)  # sums of all contexts, by decision


def shares(
    parts: np.ndarray, spelled: np.ndarray, p: np.ndarray, spelt: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(log probability, share of it that each part has) given the decisions' probabilities ``p``.

    ``spelt`` is the spelled probability whose logarithm is ``spelled``.
    """
    none = np.float32(1) - p
    told = parts * p
    told[1:] *= none[0]
    told[2] *= none[1]
    rest = none[0] * none[1] * none[2]
    total = told[0] + told[1] + told[2] + rest * (np.exp(spelled) if spelt is None else spelt)
    rare = np.flatnonzero(total <= 1e-30)  # can only be a long spelled word
    total[rare] = 1
    told /= total
    log_p = np.log(total)
    log_p[rare] = np.log(rest[rare]) + spelled[rare]
    return log_p, told


def lefts(share: np.ndarray) -> np.ndarray:
    """How far each decision is reached: what the parts before it leave."""
    left = np.ones_like(share)
    for part in range(1, len(share)):
        np.subtract(left[part - 1], share[part - 1], out=left[part])
    return np.maximum(left, 0, out=left)


def best_shares(
    parts: np.ndarray, spelled: np.ndarray, open_: np.ndarray, cell: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(shares, lefts) after ``ROUNDS`` of finding the rates by ``cell`` that explain the tokens best.

    Rounds add the spelled part as it is, not its logarithm. Tokens of a cell that have the same decisions open are worked
    on together, ``CACHED`` of them at a time: their rates are the same.
    """
    n = len(cell)
    kind = (cell * 8 + open_[0] + 2 * open_[1] + 4 * open_[2]).astype(np.uint16)
    order = np.argsort(kind, kind="stable")
    parts, spelt = parts.take(order, axis=1), np.exp(spelled.take(order))
    share, left = np.empty((PARTS, n), np.float32), np.ones((PARTS, n), np.float32)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(kind, minlength=1024))]).tolist()
    runs = [
        (k >> 3, k & 7, slice(at, min(at + CACHED, bounds[k + 1])))
        for k in range(1024)
        for at in range(bounds[k], bounds[k + 1], CACHED)
    ]
    p = np.tile(np.array(PRIOR, np.float32)[:, None], (1, 128))
    for _ in range(ROUNDS):
        often, yes = np.zeros((PARTS, 128)), np.zeros((PARTS, 128))
        for mine, can, at in runs:
            told, none = share[:, at], np.float32(1)  # ``none``: no part so far tells the word
            for part in range(PARTS):
                q = p[part, mine] if can >> part & 1 else np.float32(0)
                np.multiply(parts[part, at], none * q, out=told[part])
                none = none * (np.float32(1) - q)
            total = none * spelt[at]
            for part in range(PARTS):
                total += told[part]
            total[total <= 1e-30] = 1
            told /= total
            for part in range(PARTS):
                if part:
                    np.subtract(left[part - 1, at], told[part - 1], out=left[part, at])
                    np.maximum(left[part, at], 0, out=left[part, at])
                if can >> part & 1:
                    often[part, mine] += left[part, at].sum(dtype=np.float64)
                    yes[part, mine] += told[part].sum(dtype=np.float64)
        p = np.clip((yes + 2 * p) / (often + 2), LEAST, 1 - LEAST).astype(np.float32)
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return share.take(back, axis=1), left.take(back, axis=1)


def learn_block(row: dict, sizes: tuple[int, int], tables: np.ndarray) -> None:
    """Adds a block's sums to ``tables``; what it takes is free again before the next block."""
    block = Block(row)
    if not block.learnt.any():
        return
    told = Told(block, row, sizes, without_own=True)
    own = np.flatnonzero(block.learnt_tokens())
    open_ = told.open.take(own, axis=1)
    cell = told.gate.take(own) * 32 + told.contexts[0].take(own)
    share, left = best_shares(told.parts.take(own, axis=1), told.spelled.take(own), open_, cell)
    contexts = [values.take(own) for values in told.contexts]
    for part in range(PARTS):
        for table, values in zip(tables, (left, share)):
            weight = (values[part] * open_[part]).astype(np.float64)
            for context, place in enumerate(contexts):
                mine = slice(OFFSETS[context], OFFSETS[context + 1])
                table[part, mine] += np.bincount(place, weight, WIDTHS[context])


def learn_parts(batches: Iterator[pa.RecordBatch], sizes: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """(range, counters): per predictor of each decision, how often it was to be taken, and how often it was yes.

    A task's sums go as packed 32-bit numbers, a range of places together; what adds them up has 64 bits.
    """
    tables = np.zeros((2, PARTS, OFFSETS[-1]))
    for row in rows_of(batches):
        learn_block(row, sizes, tables)
    flat = np.zeros((2, RANGES * PLACES), np.float32)
    flat[:, : tables[0].size] = tables.reshape(2, -1)
    parts = flat.reshape(2, RANGES, PLACES).swapaxes(0, 1)
    yield pa.RecordBatch.from_pydict({"range": pa.array(range(RANGES), pa.int64()), "counters": list(map(pack, parts))})


def sum_tables(table: pa.Table) -> pa.Table:
    """One row for a range, its predictors' sums added up."""
    total = np.zeros(2 * PLACES)
    for packed in table.column("counters"):
        total += unpack(packed.as_py(), "<f4")
    return pa.table({"range": table.column("range")[:1], "counters": [pack(total)]})


def predictor_odds(open_: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Log odds of each predictor (decisions, places); one that has seen little says what its decision is on average."""
    average = (told.sum(axis=1) + 0.5) / (open_.sum(axis=1) + 1.0)
    p = (told + 2.0 * average[:, None]) / (open_ + 2.0)
    return stretch(np.clip(p, LEAST, 1 - LEAST)).astype(np.float32)


class TextMixer:
    """Weights and refining tables of all texts of a block, followed side by side."""

    def __init__(self, texts: int):
        # of each text and gate; a fourth decision, always nought, makes rows that are quick to take
        self.weights = np.full((texts, 4, CONTEXTS, PARTS + 1), 1.0 / CONTEXTS, np.float32)
        steps = squash(np.linspace(-8, 8, REFINED)).astype(np.float32)
        self.refined = np.tile(steps, (texts, PARTS, 1))

    def run(self, told: Told, starts: np.ndarray, lengths: np.ndarray, odds: np.ndarray) -> np.ndarray:
        """The log probability of every token."""
        odds = np.ascontiguousarray(np.pad(odds, ((0, 1), (0, 0))).T)  # all decisions' odds of a place lie together
        order = np.argsort(-lengths, kind="stable")
        longest, spelt = lengths[order], np.exp(told.spelled)
        out, steps = np.empty(len(told.spelled)), []

        def follow() -> None:
            """Follows the steps gathered: their tokens are fetched together."""
            rows = np.concatenate([r for *_, r in steps])
            place = np.stack([OFFSETS[c] + told.contexts[c].take(rows) for c in range(CONTEXTS)], axis=1)
            parts, open_ = told.parts.take(rows, axis=1), told.open.take(rows, axis=1)
            spelled, likely, gate = told.spelled.take(rows), spelt.take(rows), told.gate.take(rows)
            log_p, at = np.empty(len(rows)), 0
            for texts, who, spot, _ in steps:
                mine = slice(at, at + len(who))
                at += len(who)
                told_so = parts[:, mine], spelled[mine], likely[mine], open_[:, mine]
                log_p[mine] = self.step(texts, who, spot, gate[mine], odds.take(place[mine], axis=0), *told_so)
            out[rows] = log_p
            steps.clear()

        gathered = 0
        for at in range(0, int(longest[0]) if len(longest) else 0, STEP):
            texts = order[: np.searchsorted(-longest, -at)]  # those longer than ``at``
            sizes = np.minimum(lengths[texts] - at, STEP)
            who = np.repeat(np.arange(len(texts)), sizes)
            begin = np.cumsum(sizes) - sizes
            rows = np.repeat(starts[texts] + at - begin, sizes) + np.arange(len(who))
            spot = np.repeat(np.arange(len(texts)) * STEP - begin, sizes) + np.arange(len(who))
            steps.append((texts, who, spot, rows))
            gathered += len(rows)
            if gathered >= GATHERED:
                follow()
                gathered = 0
        if steps:
            follow()
        return out

    def step(
        self,
        texts: np.ndarray,
        who: np.ndarray,
        spot: np.ndarray,
        gate: np.ndarray,
        inputs: np.ndarray,
        parts: np.ndarray,
        spelled: np.ndarray,
        spelt: np.ndarray,
        open_: np.ndarray,
    ) -> np.ndarray:
        """``who`` are the tokens' places in ``texts``, ``spot`` the same times ``STEP`` and the place in the step."""
        n, width = len(who), CONTEXTS * (PARTS + 1)
        cell = who * 4 + gate
        weights = self.weights[texts]
        mine = weights.reshape(-1, width).take(cell, axis=0)
        mine *= inputs.reshape(n, width)
        total = ADD_UP @ mine.T
        np.clip(total, -8, 8, out=total)
        mixed = squash(total)
        low, beyond = Speller.step(total)
        now = self.refined[texts]
        slot = (who * PARTS + np.arange(PARTS)[:, None]) * REFINED  # of each token's tables
        slot += low
        below = now.take(slot)
        q = now.take(slot + 1)
        q -= below
        q *= beyond
        q += below
        q += 3 * mixed
        q *= np.float32(0.25)
        np.clip(q, LEAST, 1 - LEAST, out=q)
        q *= open_
        log_p, share = shares(parts, spelled, q, spelt)
        weight = lefts(share)
        weight *= open_
        # the gradient of the code length by the sum, and its way into the weights
        mixed *= weight
        error = share - mixed
        change = np.zeros((len(texts) * STEP, width), np.float32)  # words that a text has not stay nought
        change[spot] = (error.T @ ADD_UP) * inputs.reshape(n, width)
        gates = np.zeros((len(texts) * STEP, 4), np.float32)
        gates[spot, gate] = RATE
        by_text = gates.reshape(-1, STEP, 4).transpose(0, 2, 1) @ change.reshape(-1, STEP, width)
        weights += by_text.reshape(weights.shape)
        self.weights[texts] = weights
        slot += beyond > 0.5
        slot = slot.reshape(-1)
        hit = np.bincount(slot, share.reshape(-1), now.size).reshape(now.shape)  # nothing where not open
        often = np.bincount(slot, weight.reshape(-1), now.size).reshape(now.shape)
        self.refined[texts] = np.clip((now * 20 + hit) / (20 + often), LEAST, 1 - LEAST)
        return log_p


def score_blocks(
    batches: Iterator[pa.RecordBatch], odds: np.ndarray, sizes: tuple[int, int], vocabulary: int
) -> Iterator[pa.RecordBatch]:
    """``sizes`` are the tokens of all texts and of the training texts."""
    for row in rows_of(batches):
        yield score_block(row, odds, sizes, vocabulary)


def score_block(row: dict, odds: np.ndarray, sizes: tuple[int, int], vocabulary: int) -> pa.RecordBatch:
    all_tokens, block = sizes[1], Block(row)
    told = Told(block, row, sizes, without_own=False)
    texts = len(block.lengths)
    log_p = TextMixer(texts).run(told, block.starts, block.lengths, odds)
    score = np.bincount(block.doc, log_p, texts) / _LN10
    seen = told.counts[block.tokens]
    base = np.bincount(block.doc, np.log10((seen + 1) / (all_tokens + vocabulary + 1)), texts)
    known = np.bincount(block.doc, seen > 0, texts).astype(np.int64)
    bits = np.divide(-score * np.log2(10), block.bytes, out=np.full(texts, np.nan), where=block.bytes > 0)
    return pa.RecordBatch.from_arrays(
        [
            block.ids.column("doc_id").combine_chunks(),
            block.ids.column("held_out").combine_chunks(),
            pa.array(block.lengths),
            pa.array(known),
            pa.array(np.full(texts, all_tokens, np.int64)),
            pa.array(base),
            pa.array(score),
            pa.array(block.bytes),
            pa.array(bits, from_pandas=True),  # none without bytes
        ],
        [field.split()[0] for field in RESULT.split(", ")],
    )


# ---- the operator -------------------------------------------------------------------------------------------------


def lm_scores(
    docs: DataFrame, held_out: str, chars: int = BLOCK_CHARS, texts: int = BLOCK_TEXTS, **tuning
) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text, ..)``, learnt from the rows for which ``held_out`` is false.

    held_out is the name of a boolean column; rows where it is null are neither learnt from nor called held out: their
    held_out stays null. n_tokens counts words and the end, n_known those that a training text has, train_tokens is the
    number of tokens in all training texts. base_score is add-one unigram log10 probability, score the model's.
    bits_per_byte is null for a text without bytes. A null text counts as empty: one end. Every row gives one row,
    repeated rows included, and training texts that repeat count as often. Without any training text the model spells
    with even odds and base_score is 0. An empty table gives an empty result. Other columns are left out. White space
    between words is not scored.

    Words are told apart by 64-bit hashes: among a billion distinct words two share one with a chance of 3 %.
    """
    spark = docs.sparkSession
    ship(spark)
    context = spark.sparkContext

    def make(batches):
        return make_blocks(batches, chars, texts)

    plain = docs.select(F.col("doc_id").cast("bigint"), F.col(held_out).cast("boolean").alias("held"), "text")
    blocks = stage(plain.mapInArrow(make, BLOCKS), "word blocks")
    sizes = blocks.agg(F.sum("tokens"), F.sum("learnt_tokens")).first()
    tokens, all_tokens = sizes[0] or 0, sizes[1] or 0

    def ask_words(batches):
        return ask(batches)

    def ask_pairs(batches):
        return ask(batches, pair_bits(tokens))

    def count_bits(batches):
        return pack_counters(count_spelling(batches))

    # the tables are bounded: so many counters, whatever the texts
    summed = blocks.mapInArrow(count_bits, COUNTERS).groupBy("range").applyInArrow(sum_counters, COUNTERS)
    counters = np.zeros((RANGES, 2 * ORDERS * SPELLING // RANGES), np.int32)
    for number, packed in summed.collect():
        counters[number] = unpack(packed, "<i4")
    counts = context.broadcast(counters.reshape(ORDERS, SPELLING, 2))

    def learn_spelling(batches):
        return learn_speller(batches, counts.value)

    values = np.zeros(GATES * (ORDERS + 1) + GATES * REFINED + 1)
    learnt = blocks.mapInArrow(learn_spelling, "place bigint, value double").groupBy("place").agg(F.sum("value"))
    for place, value in learnt.collect():
        values[place] = value
    weights = refined = None
    if values[-1]:
        weights = (values[: GATES * (ORDERS + 1)] / values[-1]).reshape(GATES, ORDERS + 1).astype(np.float32)
        refined = (values[GATES * (ORDERS + 1) : -1] / values[-1]).reshape(GATES, REFINED)
    learnt_speller = context.broadcast((weights, refined))

    words, vocabulary = totals(blocks.mapInArrow(ask_words, ASKS), tokens // 4, **tuning)
    pairs, _ = totals(blocks.mapInArrow(ask_pairs, ASKS), tokens, count_known=False, **tuning)
    words = words.select(F.col("owner").alias("block"), F.col("sums").alias("word_sums"))
    pairs = pairs.select(F.col("owner").alias("block"), F.col("sums").alias("pair_sums"))

    def spell_words(batches):
        return spell(batches, Speller(counts.value, *learnt_speller.value))

    counted = blocks.join(words, "block").join(pairs, "block")
    ready = stage(counted.mapInArrow(spell_words, COUNTED), "counted blocks")

    def learn(batches):
        return learn_parts(batches, (tokens, all_tokens))

    tables = np.zeros((RANGES, 2, PLACES))
    gathered = ready.mapInArrow(learn, COUNTERS).groupBy("range").applyInArrow(sum_tables, COUNTERS)
    for number, packed in gathered.collect():
        tables[number] = unpack(packed, "<f8").reshape(2, PLACES)
    tables = tables.swapaxes(0, 1).reshape(2, -1)[:, : PARTS * OFFSETS[-1]]
    odds = context.broadcast(predictor_odds(*tables.reshape(2, PARTS, -1)))

    def score(batches):
        return score_blocks(batches, odds.value, (tokens, all_tokens), vocabulary)

    return ready.mapInArrow(score, RESULT)
