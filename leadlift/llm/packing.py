"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document is its ids followed by a separator id. Only documents longer than a sequence are cut. Pieces are then packed
by best-fit decreasing, all pieces of one size at once:

* Pieces of one size are alike, so what best fit does follows from the number of pieces per size, of which there are at
  most as many as a sequence has tokens. Sizes are worked through, largest first: a size takes the smallest gaps that
  hold it and fills each with as many pieces as fit, as best fit does piece by piece, and opens sequences for the rest.
  Gaps that are alike are a range of sequence numbers, and a size makes at most a few new ranges. So the places are a
  table of (size, first rank, pieces, first sequence, ..), whose length depends on sizes, not on pieces.
* A piece finds its place by its rank among the pieces of its size.

Ranks are counted within (size, part), where a part is the input split that made the piece, and shifted by the counts of
the parts before, so one size that a third of all rows share spreads over all parts. Texts never move: only ids and
sizes are shuffled, and only once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlift.llm.arrow_rows import text_slices
from leadlift.llm.vocabulary import built, read_vocabulary
from leadlift.llm.word_bpe import word_end_ids
from leadlift.sources.shipping import ship
from leadlift.sources.staging import stage

CAPACITY = 2048
SEPARATOR = 0
PIECES = "uid bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACES = "uid bigint, sequence_id bigint, offset bigint"


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR
) -> DataFrame:
    """Pieces of at most ``capacity`` ids for every row of ``docs(doc_id, text, ..)``.

    A null or empty text is one piece with only the separator. Repeated rows give repeated pieces, told apart by
    ``uid``. A null doc_id stays null. Other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    content = read_vocabulary(spark, vocabulary)

    def cut(batches):
        ids_of = built("run ids", content.value, word_end_ids)
        uid = TaskContext.get().partitionId() << 33
        tail = np.asarray([separator], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for start, end, texts in text_slices(batch):
                rows = []
                for key, ids in zip(keys[start:end], ids_of.texts(texts), strict=True):
                    ids += tail
                    for piece, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        rows.append((uid, key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                        uid += 1
                columns = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = [field.split()[0] for field in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)], names
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECES)


def ranked(rows: DataFrame, by: list[str], column: str = "rank") -> DataFrame:
    """0-based rank among the rows with equal ``by``; needs columns uid and part. No task holds more than a part."""
    counts = rows.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "part").orderBy("uid")) - 1
    numbered = rows.withColumn("_inside", inside)
    return numbered.join(offsets, [*by, "part"]).withColumn(column, F.col("_inside") + F.col("_before")).drop(
        "_inside", "_before"
    )


def plan_places(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where best fit puts ``counts`` pieces per size, rows (size, first rank, first sequence, pieces in each, offset).

    A row holds the ranks up to the next row's; sequences are numbered from 0, each gets ``pieces in each`` neighbouring
    ranks from ``offset`` on. Rows are sorted by size and rank.
    """
    least = min(counts, default=0)
    room: dict[int, list[tuple[int, int]]] = {}  # by size of gap: (first sequence, sequences)
    opened, out = 0, []
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]

        def fill(gap: int, first: int, sequences: int) -> None:
            """Put pieces into as many of these sequences as are needed; their gaps that are left are known again."""
            nonlocal rank, left
            full = min(sequences, left // (gap // size))
            for used, each in ((full, gap // size), (min(1, sequences - full), left - full * (gap // size))):
                if not used or each < 1:
                    continue
                out.append((size, rank, first, each, capacity - gap))
                if gap - each * size >= least:
                    room.setdefault(gap - each * size, []).append((first, used))
                rank, left = rank + used * each, left - used * each
                first, sequences = first + used, sequences - used
            if sequences:
                room.setdefault(gap, []).append((first, sequences))

        for gap in sorted(g for g in room if g >= size):
            if left:
                for first, sequences in room.pop(gap):
                    fill(gap, first, sequences)
        fresh = -(-left // (capacity // size))
        if fresh:
            fill(capacity, opened, fresh)
            opened += fresh
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, sequence_id, offset) for the rows of ``items(uid, part, size)``; uid is unique, 0 < size <= capacity."""
    counts = {row["size"]: row["count"] for row in items.groupBy("size").count().collect()}  # at most ``capacity`` sizes
    plan = items.sparkSession.sparkContext.broadcast(plan_places(counts, capacity))

    def place(batches):
        sizes, ranks, firsts, each, offsets = plan.value.T
        bounds = np.searchsorted(sizes, np.arange(capacity + 2))
        for batch in batches:
            uid, size, rank = (batch.column(i).to_numpy() for i in range(3))
            at = np.empty(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else ():
                low, high = bounds[size[own[0]]], bounds[size[own[0]] + 1]
                at[own] = low + np.searchsorted(ranks[low:high], rank[own], side="right") - 1
            beyond = rank - ranks[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(uid),
                    pa.array(firsts[at] + beyond // each[at]),
                    pa.array(offsets[at] + beyond % each[at] * size),
                ],
                ["uid", "sequence_id", "offset"],
            )

    return ranked(items, ["size"]).select("uid", "size", F.col("rank").cast("bigint")).mapInArrow(place, PLACES)


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR
) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of ``docs`` is packed, repeated rows included; a null text counts as empty, a null doc_id stays null.
    Sequences are filled without holes from offset 0. An empty table gives an empty result.
    """
    pieces = stage(token_pieces(docs, vocabulary, capacity, separator), "pieces")
    part = F.shiftright("uid", 33)
    places = pack(pieces.select("uid", F.col("length").alias("size"), part.alias("part")), capacity)
    return pieces.join(places, "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
