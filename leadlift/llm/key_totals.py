"""Totals over the whole table for blocks of hashed keys, handed back to the blocks.

A block names its distinct 64-bit keys, sorted, with its own count of each, as packed arrays. Keys are cut by their
leading bits into ranges; a range's task adds up what all blocks say and answers each of them. Hashing makes the ranges
even whatever the data, as a key that every row has comes once per block. A range holds about ``ROOM`` keys, so the
number of ranges follows the table. Beyond ``FAN`` ranges the way there has several steps: blocks are merged by groups
of ``FAN`` first, so every block sends and gets at most ``FAN`` arrays a step, and nothing grows with the square of the
table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.sources.staging import stage

FAN = 4096
ROOM = 4_000_000
ASKS = "owner bigint, keys binary, counts binary"
_SPLIT = "over bigint, range bigint, owner bigint, keys binary, counts binary"
_ANSWERS = "owner bigint, range bigint, sums binary, known bigint"


def pack(values: np.ndarray) -> bytes:
    """Compressed, all first bytes of the numbers before all second ones, so that what sorted or small numbers have in
    common costs nothing."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(content: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(content), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stable order, unsigned 64-bit ``keys`` in that order, where each distinct one begins)."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64), keys, np.zeros(0, np.int64)
    vary = int(np.bitwise_or.reduce(keys ^ keys[0]))  # bits in which keys differ
    high, low, room = vary.bit_length(), max((vary & -vary).bit_length() - 1, 0), n.bit_length()
    if high - low + room <= 64:  # a key's place fits beside what it differs in, which is sorted faster than places are
        own = keys & np.uint64((1 << high) - 1)
        own >>= np.uint64(low)
        own <<= np.uint64(room)
        own |= np.arange(n, dtype=np.uint64)
        own.sort()
        own &= np.uint64((1 << room) - 1)
        order = own.view(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
    ordered = keys.take(order)
    return order, ordered, np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def places(order: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each key its place among the distinct ones, given what ``grouped`` found."""
    where = np.empty(len(order), np.int64)
    where[order] = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(order))))
    return where


def ranges(keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(range numbers, bounds) of sorted keys cut by their first ``depth`` bits."""
    if not depth:
        return np.zeros(1, np.int64), np.array([0, len(keys)])
    number = (keys >> np.uint64(64 - depth)).astype(np.int64)
    firsts = np.flatnonzero(np.diff(number, prepend=-1))
    return number[firsts], np.append(firsts, len(keys))


def totals(
    asks: DataFrame,
    keys: int,
    fan: int = FAN,
    room: int = ROOM,
    depth: int = 0,
    low: int = 0,
    count_known: bool = True,
) -> tuple[DataFrame, int | None]:
    """((owner, sums), known) for ``asks(owner, keys, counts)``: each owner's totals in the order of its keys.

    ``keys`` is about how many keys all owners name together; ``known`` is how many distinct keys have a total above
    zero, counted on demand from answers that are staged for it. Arrays are those of ``pack``: unsigned 64-bit numbers,
    keys sorted and distinct. Owners are small numbers, so that ``fan`` neighbours are a group; their first ``low`` bits
    from the right are no part of that. An owner without keys has no row.
    """
    step = fan.bit_length() - 1
    wanted = max(0, (max(keys, 1) - 1) // room).bit_length() - depth  # bits that are still to be cut by
    last = wanted <= step
    bits = depth + max(0, min(wanted, step))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, counts = unpack(row["keys"], "<u8"), unpack(row["counts"], "<u8")
                numbers, bounds = ranges(own, bits)
                over = 0 if last else row["owner"] >> (low + step)
                yield pa.RecordBatch.from_pydict(
                    {
                        "over": pa.array([over] * len(numbers), pa.int64()),
                        "range": pa.array(numbers, pa.int64()),
                        "owner": pa.array([row["owner"]] * len(numbers), pa.int64()),
                        "keys": [pack(own[a:b]) for a, b in zip(bounds, bounds[1:])],
                        "counts": [pack(counts[a:b]) for a, b in zip(bounds, bounds[1:])],
                    }
                )

    def merge(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct keys of a group, their sums, and where each row's keys are among them."""
        rows = [unpack(k.as_py(), "<u8") for k in table.column("keys")]
        bounds = np.cumsum([len(r) for r in rows])[:-1]
        keys = np.concatenate(rows)
        rows.clear()  # a range has millions of keys
        order, keys, firsts = grouped(keys)
        distinct = keys[firsts]
        del keys
        counts = np.concatenate([unpack(c.as_py(), "<u8") for c in table.column("counts")])
        sums = np.add.reduceat(counts.take(order), firsts)
        del counts
        return distinct, sums, np.split(places(order, firsts), bounds)

    def answer(table: pa.Table, sums: np.ndarray, places: list[np.ndarray], known: int) -> pa.Table:
        size = table.num_rows
        return pa.table(
            {
                "owner": table.column("owner"),
                "range": table.column("range"),
                "sums": pa.array([pack(sums[p]) for p in places], pa.binary()),
                "known": pa.array([known, *[0] * (size - 1)], pa.int64()),
            }
        )

    def add_up(table: pa.Table) -> pa.Table:
        _, sums, places = merge(table)
        return answer(table, sums, places, int((sums > 0).sum()))

    pieces = asks.mapInArrow(split, _SPLIT)
    if last:
        answers, known = pieces.groupBy("over", "range").applyInArrow(add_up, _ANSWERS), None
        if count_known:
            answers = stage(answers, "answers")
            known = int(answers.agg(F.sum("known")).first()[0] or 0)
    else:

        def merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            distinct, sums, _ = merge(table)
            owner = (key[0].as_py() << bits) + key[1].as_py()
            return pa.table(
                {"owner": pa.array([owner], pa.int64()), "keys": [pack(distinct)], "counts": [pack(sums)]}
            )

        def hand_back(key: tuple[pa.Scalar, ...], table: pa.Table, above: pa.Table) -> pa.Table:
            _, _, places = merge(table)
            return answer(table, unpack(above.column("sums")[0].as_py(), "<u8"), places, 0)

        pieces = stage(pieces, "pieces")
        groups = stage(pieces.groupBy("over", "range").applyInArrow(merged, ASKS), "merged")
        above, known = totals(groups, keys, fan, room, bits, bits, count_known)
        above = above.select(
            F.shiftright("owner", bits).alias("over"),
            F.col("owner").bitwiseAND((1 << bits) - 1).alias("range"),
            "sums",
        )
        answers = pieces.groupBy("over", "range").cogroup(above.groupBy("over", "range")).applyInArrow(
            hand_back, _ANSWERS
        )

    def in_order(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = table.sort_by("range").column("sums").to_pylist()
        return pa.table({"owner": [key[0]], "sums": [pack(np.concatenate([unpack(p, "<u8") for p in parts]))]})

    ordered = answers.select("owner", "range", "sums").groupBy("owner").applyInArrow(in_order, "owner bigint, sums binary")
    return ordered, known
