"""Periodic runs of words, from suffix trees.

A run is a stretch of consecutive words with smallest period q, at least ``max(LEAST_WORDS, REPEATS * q)`` words long,
that no neighbouring word extends. They are found as follows:

* A run of length 4q or more holds each of its words at least four times. So words with fewer occurrences in their
  stretch of the text cut it; the rest is cut again by the counts within each stretch until nothing changes. What
  remains of ordinary texts is next to nothing, of repetitive ones nearly all.
* The remaining stretches of a slice of documents become one sequence with a separator of its own after each. Ukkonen
  trees of the sequence and of its reversal give the order of suffixes and, through the lowest common ancestor of two
  leaves, the common extension of two places. Ancestors come in constant time from the Euler tour of the tree, kept as
  the lowest depth between consecutive leaves, with a table of range minima.
* For each place and each of two opposite orders of words, the longest Lyndon word that starts there ends where the next
  smaller suffix starts. Every run has such a word as its root, so extending all of them in both directions finds every
  run, and nothing of smaller period is missed, as Lyndon words are primitive.

A task holds one slice at a time: about ``SLICE_WORDS`` remaining words, or one document.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.arrow_rows import text_slices
from leadlift.sources.shipping import ship

LEAST_WORDS, REPEATS = 6, 4
SLICE_WORDS = 50_000
BLANKS = "\x20\x09-\x0d"

FOUND = (
    "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
)
DIGEST = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


# ---- suffix trees -------------------------------------------------------------------------------------------------


def suffix_tree(symbols: list[int], width: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Ukkonen's tree of ``symbols``, numbers below ``width`` whose last one occurs nowhere else.

    Where the edge to each node begins and ends (leaves end at n), and the child of a node along an edge that begins
    with a symbol, by ``node * width + symbol``. Node 0 is the root.
    """
    n = len(symbols)
    begin, end, link = [0], [0], [0]
    child: dict[int, int] = {}
    # the active point: a node, the place whose symbol names the edge, symbols down that edge; suffixes still to insert
    node = edge = length = rest = 0
    for i, symbol in enumerate(symbols):
        rest += 1
        waiting = 0  # an inner node that has no suffix link yet
        while rest:
            if not length:
                edge = i
            key = node * width + symbols[edge]
            at = child.get(key)
            if at is None:
                child[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                span = min(end[at], i + 1) - begin[at]
                if length >= span:
                    edge += span
                    length -= span
                    node = at
                    continue
                if symbols[begin[at] + length] == symbol:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                fork = len(begin)
                begin += [begin[at], i]
                end += [begin[at] + length, n]
                link += [0, 0]
                child[key] = fork
                child[fork * width + symbol] = fork + 1
                begin[at] += length
                child[fork * width + symbols[begin[at]]] = at
                if waiting:
                    link[waiting] = fork
                waiting = fork
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    return begin, end, child


class Extensions:
    """Suffix ranks and common extensions of ``symbols`` (int array whose negative values occur once each)."""

    def __init__(self, symbols: np.ndarray, both: bool):
        n = len(symbols)
        values, dense = np.unique(symbols, return_inverse=True)
        begin, end, child = suffix_tree(dense.tolist(), len(values))
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        del child
        parents, firsts = keys // len(values), values[keys % len(values)]
        suffixes, depths = self.tour(n, begin, end, parents, nodes, firsts)
        self.rank = self.ranks(suffixes)
        # range minima of the tour's depths between consecutive leaves
        self.minima = [depths]
        width = 1
        while 2 * width <= len(depths):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        # ranks in the opposite order of words; separators stay the smallest
        self.opposite = None
        if both:
            turned = np.where(firsts < 0, firsts, np.iinfo(np.int64).max - firsts)
            self.opposite = self.ranks(self.tour(n, begin, end, parents, nodes, turned)[0])

    @staticmethod
    def ranks(suffixes: np.ndarray) -> np.ndarray:
        rank = np.empty(len(suffixes), np.int64)
        rank[suffixes] = np.arange(len(suffixes))
        return rank

    @staticmethod
    def tour(n, begin, end, parents, nodes, keys) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour with children in the order of ``keys``: suffixes as met, and the least depth between them."""
        by = np.lexsort((-keys, parents))  # largest first, as a stack gives the last one first
        sorted_nodes = nodes[by].tolist()
        starts = np.searchsorted(parents[by], np.arange(len(begin) + 1)).tolist()
        suffixes, lows, low = [], [], 0
        stack, depths = [0], [0]
        while stack:
            node = stack.pop()
            depth = depths.pop()
            if node < 0:  # back at an inner node between two of its children
                if depth < low:
                    low = depth
                continue
            first, last = starts[node], starts[node + 1]
            if node:
                depth += end[node] - begin[node]
            if first == last:
                if suffixes:
                    lows.append(low)
                suffixes.append(n - depth)
                low = depth
                continue
            for at in range(first, last):
                if at > first:
                    stack.append(-1)
                    depths.append(depth)
                stack.append(sorted_nodes[at])
                depths.append(depth)
        return np.asarray(suffixes, np.int64), np.asarray(lows, np.int32)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``a`` and at ``b`` (different places) have in common."""
        if not len(a):
            return np.zeros(0, np.int64)
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            rows = level == k
            table = self.minima[k]
            out[rows] = np.minimum(table[low[rows]], table[high[rows] - (1 << k)])
        return out


def next_smaller(rank: list[int], last: int) -> list[int]:
    """For each place the next one with a smaller rank; ``last`` if there is none."""
    out, stack = [last] * len(rank), []
    for i in range(len(rank) - 1, -1, -1):
        mine = rank[i]
        while stack and rank[stack[-1]] > mine:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return out


def all_runs(symbols: np.ndarray, least: int = LEAST_WORDS, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) of all runs of ``symbols``, sorted; negative symbols are separators, each used once.

    The first and the last symbol are separators.
    """
    n = len(symbols)
    if n < 3:
        return np.zeros((0, 3), np.int64)
    ahead, behind = Extensions(symbols, both=True), Extensions(symbols[::-1], both=False)
    found = []
    for rank in (ahead.rank, ahead.opposite):
        after = np.asarray(next_smaller(rank.tolist(), n), np.int64)
        at = np.flatnonzero((symbols >= 0) & (after < n))
        root = after[at]
        right = ahead.common(at, root)
        left = behind.common(n - at, n - root)  # places at - 1 and root - 1, seen from the end
        period = root - at
        start, length = at - left, left + period + right
        rows = (length >= 2 * period) & (length >= least) & (length >= repeats * period)
        found.append(np.stack([start[rows], length[rows], period[rows]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


# ---- texts --------------------------------------------------------------------------------------------------------


def stretches(words: list[bytes], repeats: int = REPEATS, least: int = LEAST_WORDS) -> list[tuple[int, np.ndarray]]:
    """(start, word numbers) of the parts of a text that can hold a run: all their words occur ``repeats`` times."""
    if len(words) < least:
        return []
    counts = Counter(words)
    known = {word: i for i, word in enumerate(w for w, n in counts.items() if n >= repeats)}
    if not known:
        return []
    ids = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
    where = np.flatnonzero(ids >= 0)
    while True:
        # consecutive places are a stretch; short ones go, then words too rare in their stretch
        cuts = np.flatnonzero(np.diff(where) > 1) + 1
        bounds = np.concatenate([[0], cuts, [len(where)]])
        sizes = np.diff(bounds)
        part = np.repeat(np.arange(len(sizes)), sizes)
        kept = np.repeat(sizes >= least, sizes)
        where, part = where[kept], part[kept]
        if not len(where):
            return []
        _, inverse, times = np.unique(part * len(known) + ids[where], return_inverse=True, return_counts=True)
        frequent = times[inverse] >= repeats
        if frequent.all():
            break
        where = where[frequent]
    cuts = np.flatnonzero(np.diff(where) > 1) + 1
    return [(int(rows[0]), ids[rows]) for rows in np.split(where, cuts)]


def runs_of_texts(parts: list[list[tuple[int, np.ndarray]]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given its stretches; all of them share one pair of trees."""
    pieces, owners, shifts, at, offset = [np.array([-1], np.int64)], [], [], 1, 0
    for owner, own in enumerate(parts):
        top = 0
        for start, ids in own:
            separator = -2 - len(owners)
            owners.append((at, owner))
            shifts.append(start - at)
            # words of different texts are different symbols, so the trees only branch where a text repeats itself
            pieces += [ids + offset, np.array([separator], np.int64)]
            at += len(ids) + 1
            top = max(top, int(ids.max()) + 1)
        offset += top
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    if not owners:
        return out
    found = all_runs(np.concatenate(pieces))
    which = np.searchsorted([place for place, _ in owners], found[:, 0], side="right") - 1
    for (start, length, period), k in zip(found.tolist(), which.tolist(), strict=True):
        out[owners[k][1]].append((start + shifts[k], length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds beyond its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def worked(texts: list[str], slice_words: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """(words, runs) of each text; texts are worked on together up to ``slice_words`` words in stretches."""
    held, words_held, size = [], [], 0
    for text in texts:
        words = text.encode().split()  # cuts at U+0020 and U+0009..U+000D, nothing else
        parts = stretches(words)
        held.append(parts)
        words_held.append(words)
        size += sum(len(ids) for _, ids in parts)
        if size >= slice_words:
            yield from zip(words_held, runs_of_texts(held), strict=True)
            held, words_held, size = [], [], 0
    yield from zip(words_held, runs_of_texts(held), strict=True)


def find_batches(batches: Iterator[pa.RecordBatch], slice_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, texts in text_slices(batch):
            numbers, found, collapsed = [], [], []
            for words, runs in worked(texts, slice_words):
                numbers.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                collapsed.append(b" ".join(kept_words(words, runs)).decode())
            run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, end - start),
                    pa.array(numbers, pa.int64()),
                    pa.array(found, pa.list_(run)),
                    pa.array(collapsed, pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def digest_batches(batches: Iterator[pa.RecordBatch], slice_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, texts in text_slices(batch):
            rows = []
            for words, runs in worked(texts, slice_words):
                best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                rows.append(
                    (
                        len(runs),
                        *best,
                        1000 * best[1] // best[2] if runs else None,
                        hashlib.sha256(listed.encode()).hexdigest(),
                        hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest(),
                    )
                )
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = [field.split()[0] for field in DIGEST.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), *columns], names)


def find_runs(docs: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the text without repetitions, for ``docs(doc_id, text, ..)``.

    The collapsed text keeps each run's first period; words are joined by one space. A null text counts as empty: no
    words, no runs, an empty collapsed text. Every row gives one row, repeated ones too; a null doc_id stays null; other
    columns are left out. A text of any length is worked on whole, by one task.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("bigint"), "text")
    return plain.mapInArrow(partial(find_batches, slice_words=slice_words), FOUND)


def run_digests(docs: DataFrame, slice_words: int = SLICE_WORDS) -> DataFrame:
    """As ``find_runs``, with digests in place of texts: the longest run (ties: smallest start, then period), the
    SHA-256 of ``start,length,period`` lines, and that of the collapsed text."""
    ship(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("bigint"), "text")
    return plain.mapInArrow(partial(digest_batches, slice_words=slice_words), DIGEST)


def with_repetitions(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` where one document in ten repeats a stretch of its words to its end.

    With n words, h the CRC-32 of the id and g = h // 10: for h % 10 = 0 every word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", f"[{BLANKS}]+"), "")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"), F.floor(h / 10).alias("_g"))
    n = F.when(F.size("_words") > 0, F.size("_words").cast("bigint"))  # null: nothing to repeat
    a = F.col("_g") % n
    period = 1 + F.floor((n - a) / (3 + F.col("_g") % 8))
    sized = chosen.withColumn("_n", n).withColumn("_a", a).withColumn("_p", period)
    return sized.select("doc_id", F.when(F.col("_n").isNotNull(), _repeated()).otherwise(F.col("text")).alias("text"))


def _repeated() -> Column:
    words, n, a, p = F.col("_words"), F.col("_n"), F.col("_a"), F.col("_p")
    unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), (n - a).cast("int"))
    return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
