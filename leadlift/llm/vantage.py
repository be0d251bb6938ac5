"""Nearest neighbours by inner product, with a vantage-point tree per shard.

Vectors get one more coordinate, so that all have the same length M; a query gets zero there. The Euclidean distance to
a query then falls as the inner product rises, and the triangle inequality holds. Rows are dealt to shards by a hash of
their id. Each shard builds a vantage-point tree over its rows: a node halves its rows by their distance to one of them.
A block of queries walks the tree together, near side first; the far side is visited by those queries whose distance to
the border is at most ``factor`` times the distance of their k-th best so far. With factor one the far side can hold
nothing better when it is left out, so the search is exact; smaller factors leave out more.

Queries are a stated share of the rows and meet every shard in blocks; a task holds one shard and one block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlift.llm.expressions import let
from leadlift.sources.shipping import ship
from leadlift.sources.staging import stage

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF_ROWS = 256
FACTOR = 0.5
MARGIN = 1e-6  # of the longest vector: more than distances are rounded by
PAIRS_AT_ONCE = 500_000
FOUND = "query_id bigint, vec_id bigint, score double"


class Tree:
    """Vantage-point tree over the rows of ``points``; nodes and leaves hold row numbers."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_ROWS, seed: int = 0):
        self.points, self.leaf = points, leaf
        self.draw = np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        centre = self.points[rows[self.draw.integers(len(rows))]]
        away = np.sqrt(np.maximum(((self.points[rows] - centre) ** 2).sum(1), 0))
        border = float(np.median(away))
        near = away <= border
        if near.all():  # equal vectors: nothing to halve by
            return rows
        return centre, border, self._grow(rows[near]), self._grow(rows[~near])

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(distances, row numbers) of the k nearest found, nearest first; -1 where there are fewer rows."""
        best = np.full((len(queries), k), np.inf)
        rows = np.full((len(queries), k), -1, dtype=np.int64)

        def visit(node, who: np.ndarray) -> None:
            if not len(who):
                return
            if isinstance(node, np.ndarray):
                merge(node, who)
                return
            centre, border, near, far = node
            away = np.sqrt(((queries[who] - centre) ** 2).sum(1))
            inside = away <= border
            visit(near, who[inside])
            visit(far, who[~inside])
            reach = factor * best[who, -1]
            visit(far, who[inside & (border - away <= reach)])
            visit(near, who[~inside & (away - border <= reach)])

        def merge(node: np.ndarray, who: np.ndarray) -> None:
            points = self.points[node]
            square = (points**2).sum(1)[None, :] - 2 * queries[who] @ points.T + (queries[who] ** 2).sum(1)[:, None]
            found = np.concatenate([best[who], np.sqrt(np.maximum(square, 0))], axis=1)
            names = np.concatenate([rows[who], np.broadcast_to(node, (len(who), len(node)))], axis=1)
            order = np.argsort(found, axis=1, kind="stable")[:, :k]
            best[who] = np.take_along_axis(found, order, 1)
            rows[who] = np.take_along_axis(names, order, 1)

        visit(self.root, np.arange(len(queries)))
        return best, rows

    def within(self, queries: np.ndarray, reach: np.ndarray, factor: float):
        """(query numbers, row numbers) of all rows found no farther than ``reach`` from each query, leaf by leaf."""
        waiting = [(self.root, np.arange(len(queries)))]
        while waiting:
            node, who = waiting.pop()
            if not len(who):
                continue
            if isinstance(node, np.ndarray):
                points = self.points[node]
                square = (points**2).sum(1)[None, :] - 2 * queries[who] @ points.T + (queries[who] ** 2).sum(1)[:, None]
                at, row = np.nonzero(square <= (reach[who] ** 2)[:, None])
                yield who[at], node[row]
                continue
            centre, border, near, far = node
            away = np.sqrt(((queries[who] - centre) ** 2).sum(1))
            waiting.append((near, who[(away <= border) | (away - border <= factor * reach[who])]))
            waiting.append((far, who[(away > border) | (border - away <= factor * reach[who])]))


def lengthened(points: np.ndarray, length: float) -> np.ndarray:
    """Points with one more coordinate that brings each to ``length``."""
    rest = np.sqrt(np.maximum(length**2 - (points**2).sum(1), 0))
    return np.concatenate([points, rest[:, None]], axis=1)


def search_shard(queries, points, query_ids, point_ids, k: int, factor: float):
    """(query id, point id, score) of each query's k best points; a query never finds its own id.

    Scores are inner products of the original vectors in double precision; ties go to the smaller id.
    """
    length = float(np.sqrt((points**2).sum(1).max()))
    order = np.argsort(point_ids, kind="stable")
    points, point_ids = points[order], point_ids[order]
    tree = Tree(lengthened(points, length))
    flat = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
    # one more for the query's own row; rounded distances say how far to look, exact scores who is nearer
    away, _ = tree.search(flat, min(k + 1, len(points)), factor)
    reach = away[:, -1] + MARGIN * length
    held, size = [], 0

    def best_of(parts):
        at, rows, scores = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((rows, -scores, at))  # rows are in the order of their ids
        at = at[order]
        firsts = np.flatnonzero(np.diff(at, prepend=-1))
        place = np.arange(len(at)) - np.repeat(firsts, np.diff(np.append(firsts, len(at))))
        order = order[place < k]
        return np.concatenate([p[0] for p in parts])[order], rows[order], scores[order]

    for at, rows in tree.within(flat, reach, factor):
        other = point_ids[rows] != query_ids[at]
        at, rows = at[other], rows[other]
        for start in range(0, len(at), PAIRS_AT_ONCE):
            some = slice(start, start + PAIRS_AT_ONCE)
            held.append((at[some], rows[some], (queries[at[some]] * points[rows[some]]).sum(axis=1)))
            size += len(at[some])
            if size > 4 * PAIRS_AT_ONCE:  # ties may be any number; only the first of them are kept
                held = [best_of(held)]
                size = len(held[0][0])
    at, rows, scores = best_of(held) if held else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    return query_ids[at], point_ids[rows], scores


def usable(vector):
    """Whether a vector takes part: not null, not empty, no null or non-finite component, not all zeros."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, k: int = 20, every: int = 20, factor: float = FACTOR, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows found for each row whose vec_id is divisible by ``every``.

    ``vectors(vec_id, embedding, ..)``; other columns are left out. Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do rows without vec_id; of repeated ids the smallest vector stays. All
    vectors must have one length; others are an error. Ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    ship(spark)
    embedding = F.col("embedding").cast("array<double>")
    usable_rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), embedding.alias("embedding")).where(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    )
    kept = stage(usable_rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    length = F.size("embedding")
    rows, asking, least, most = kept.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1)), F.min(length), F.max(length)
    ).first()
    if least != most:
        raise ValueError(f"vectors have between {least} and {most} components; all must have one length")
    shards, blocks = max(1, -(-rows // shard_rows)), max(1, -(-asking // BLOCK_ROWS))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    cells = kept.select(
        "vec_id", "embedding", F.lit(False).alias("asks"), shard.cast("int").alias("shard"), every_block.alias("block")
    ).unionByName(
        kept.where(F.col("vec_id") % every == 0).select(
            "vec_id", "embedding", F.lit(True).alias("asks"), every_shard.alias("shard"), block.cast("int").alias("block")
        )
    )

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        asks = table.column("asks").to_numpy().astype(bool)
        lists = table.column("embedding").combine_chunks()
        flat = np.asarray(lists.values).reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        q, p = order[asks[order]], order[~asks[order]]
        if len(q) and len(p):
            found = search_shard(flat[q], flat[p], ids[q], ids[p], k, factor)
        else:
            found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(["query_id", "vec_id", "score"], map(pa.array, found), strict=True)))

    found = cells.groupBy("shard", "block").applyInArrow(search, FOUND)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
