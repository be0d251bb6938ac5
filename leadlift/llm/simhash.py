"""Near duplicates by SimHash: fingerprints, exact links within a Hamming distance, and their components.

**Fingerprint.** Words are what lies between ASCII white space, A-Z lowered; shingles of four words, repeats included;
a bit is set if more than half of the shingles' XXH64 hashes have it.

**Links.** Equal fingerprints are one point. The 64 bits are cut into three bands; two points with at most four
different bits differ in at most one bit of some band. Each band has a vantage-point tree over Hamming distance in the
band: a node halves its points by their distance to a vantage point. A point lies in one shard (leaf) of each tree, and
the triangle inequality says which other shards can hold points within one bit of it: those whose borders it comes
within that distance of. It visits these too, so shards are searched independently. Inside a shard the tree goes on,
with vantage points drawn there, and what remains is compared on all 64 bits, exactly.

The trees down to shards are fitted on the driver from a bounded sample (``SAMPLE`` distinct fingerprints); every
fingerprint is placed. A shard with many points or visitors is cut into a grid of blocks, one task each. A task
returns a spanning forest of the links it found, never all pairs, so a dense group gives no more rows than points.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.llm.arrow_rows import text_slices
from leadlift.llm.components import connected
from leadlift.sources.shipping import ship
from leadlift.sources.staging import stage

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SAMPLE = 20_000
SHARD_POINTS = 4096
HOME_BLOCK, VISITOR_BLOCK = 16_384, 65_536
BRUTE = 4_096  # pairs below which a shard's part is compared as it is
PAIRS = 1_000_000  # pairs held before they are merged into the forest


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words; of all words, if there are fewer."""
    words = text.encode().lower().split()  # bytes: lowers A-Z and splits at ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    spans = zip(starts, ends[size - 1 :])  # the shorter one ends it
    return np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=np.uint64)


def simhash(text: str, size: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint; zero for a text without words."""
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 100_000):
        part = hashes[at : at + 100_000].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for every row of ``docs(doc_id, text, ..)``; fp is the fingerprint as a signed integer."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for start, end, texts in text_slices(batch):
                found = np.array([simhash(t, size) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(found)], ["doc_id", "fp"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


def band_masks(bits: int = MAX_BITS) -> list[tuple[np.uint64, int]]:
    """(mask, reach) of each band: of any two points within ``bits``, one band has at most ``reach`` different bits."""
    bands = max(1, (bits + 2) // 2)  # reach one, as far as there are bits
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    reach = bits // bands
    return [(np.uint64(sum(1 << b for b in range(lo, hi))), reach) for lo, hi in zip(edges, edges[1:])]


def away(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    """Hamming distance to the vantage point, in the band."""
    return np.bitwise_count((points ^ vantage) & mask)


def halving(points: np.ndarray, mask: np.uint64, draw: np.random.Generator):
    """(vantage, border) that leaves points on both sides, as even as a few draws get; None if there is none."""
    best = None
    for vantage in points[draw.integers(len(points), size=4)]:
        distance = away(points, vantage, mask)
        border = int(np.median(distance))
        for at in (border, border - 1):
            inside = int((distance <= at).sum())
            worse = max(inside, len(points) - inside)
            if 0 < inside < len(points) and (best is None or worse < best[0]):
                best = (worse, vantage, at)
    return best[1:] if best else None


def grow(points: np.ndarray, mask: np.uint64, depth: int, draw: np.random.Generator):
    """Tree of (vantage, border, near, far); a leaf is None."""
    found = halving(points, mask, draw) if depth and len(points) > 1 else None
    if found is None:
        return None
    near = away(points, found[0], mask) <= found[1]
    return (*found, grow(points[near], mask, depth - 1, draw), grow(points[~near], mask, depth - 1, draw))


def place(tree, points: np.ndarray, mask: np.uint64, reach: int):
    """(shard, point numbers that lie in it, point numbers that visit it) for every shard with visitors."""
    out = []

    def walk(node, name: int, home: np.ndarray, visit: np.ndarray) -> None:
        if not len(visit):
            return
        if node is None:
            out.append((name, home, visit))
            return
        vantage, border, near, far = node
        at, seen = away(points[home], vantage, mask), away(points[visit], vantage, mask).astype(np.int64)
        walk(near, 2 * name, home[at <= border], visit[seen <= border + reach])
        walk(far, 2 * name + 1, home[at > border], visit[seen > border - reach])

    every = np.arange(len(points))
    walk(tree, 1, every, every)
    return out


class Forest:
    """Spanning forest over the local points, from pairs added in bulk."""

    def __init__(self, size: int):
        self.root = np.arange(size)
        self.held, self.size = [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.size += len(a)
        if self.size > PAIRS:
            self.merge()

    def merge(self) -> None:
        if not self.held:
            return
        a, b = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        root = self.root
        while True:
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            open_ = low != high
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(root, high[open_], low[open_])
            while True:
                jumped = root[root]
                if (jumped == root).all():
                    break
                root = jumped
        self.root = root


def link_shard(home: np.ndarray, visit: np.ndarray, mask: np.uint64, reach: int, bits: int):
    """Edges (a, b) of a spanning forest of all pairs of a home point and a visitor within ``bits``."""
    points, where = np.unique(np.concatenate([home, visit]), return_inverse=True)
    forest = Forest(len(points))
    draw = np.random.default_rng(0)

    def compare(h: np.ndarray, v: np.ndarray) -> None:
        step = max(1, PAIRS // max(1, len(v)))
        for at in range(0, len(h), step):
            part = h[at : at + step]
            close = np.bitwise_count(points[part][:, None] ^ points[v][None, :]) <= bits
            i, j = np.nonzero(close)
            a, b = part[i], v[j]
            other = a != b
            forest.add(a[other], b[other])

    def walk(h: np.ndarray, v: np.ndarray) -> None:
        if not len(h) or not len(v):
            return
        found = halving(points[h], mask, draw) if len(h) * len(v) > BRUTE else None
        if found is None:
            compare(h, v)
            return
        vantage, border = found
        at, seen = away(points[h], vantage, mask), away(points[v], vantage, mask).astype(np.int64)
        walk(h[at <= border], v[seen <= border + reach])
        walk(h[at > border], v[seen > border - reach])

    walk(np.unique(where[: len(home)]), np.unique(where[len(home) :]))
    forest.merge()
    linked = np.flatnonzero(forest.root != np.arange(len(points)))
    return points[linked], points[forest.root[linked]]


def links(points: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges that connect all points of ``points(fp)`` within ``bits`` of each other; fp is distinct."""
    spark = points.sparkSession
    ship(spark)
    total = points.count()
    share = -(-total // SAMPLE) if total else 1
    # a bounded sample by hash fits the trees; the limit only guards against a freak of hashing
    sample = points.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).limit(2 * SAMPLE).collect()
    known = np.array(sorted(row["fp"] for row in sample), dtype=np.int64).view(np.uint64)
    depth = max(0, min((max(total, 1) // SHARD_POINTS).bit_length(), (len(known) // 16).bit_length() - 1))
    draw = np.random.default_rng(0)
    bands = [(mask, reach, grow(known, mask, depth, draw)) for mask, reach in band_masks(bits)]
    trees = spark.sparkContext.broadcast(bands)  # at most bands * 2 ** depth nodes, bounded by the sample

    def assign(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for band, (mask, reach, tree) in enumerate(trees.value):
                for shard, home, visit in place(tree, fps, mask, reach):
                    for rows, lies in ((home, True), (visit, False)):
                        if len(rows):
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.full(len(rows), band, np.int32)),
                                    pa.array(np.full(len(rows), shard, np.int64)),
                                    pa.array(np.full(len(rows), lies)),
                                    pa.array(fps[rows].view(np.int64)),
                                ],
                                ["band", "shard", "lies", "fp"],
                            )

    placed = stage(points.select("fp").mapInArrow(assign, "band int, shard bigint, lies boolean, fp bigint"), "placed")
    # at most two counts per shard, of which there are at most as many as sampled points
    counts: dict[tuple[int, int], list[int]] = {}
    for row in placed.groupBy("band", "shard", "lies").count().collect():
        counts.setdefault((row["band"], row["shard"]), [0, 0])[0 if row["lies"] else 1] = row["count"]
    table = [(b, s, -(-h // HOME_BLOCK), -(-v // VISITOR_BLOCK)) for (b, s), (h, v) in counts.items() if h and v]
    grid = F.broadcast(spark.createDataFrame(table, "band int, shard bigint, rows int, columns int"))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("lies"), F.col("rows")).otherwise(F.col("columns"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("lies"), F.col("columns")).otherwise(F.col("rows")) - 1))
    dealt = placed.join(grid, ["band", "shard"]).withColumn("own", own).withColumn("other", others)
    cell = [F.when(F.col("lies"), F.col(x)).otherwise(F.col(y)) for x, y in (("own", "other"), ("other", "own"))]
    dealt = dealt.select("band", "shard", cell[0].alias("row"), cell[1].alias("column"), "lies", "fp")

    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        mask, reach, _ = trees.value[key[0].as_py()]
        lies = table.column("lies").to_numpy().astype(bool)
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = link_shard(fps[lies], fps[~lies], mask, reach, bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("band", "shard", "row", "column").applyInArrow(link, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs(doc_id, text, ..)``.

    component_id is the smallest doc_id that links reach, the row's own included. A null text counts as empty; texts
    without words share the fingerprint zero and are linked like any others. Rows without doc_id take part but name no
    component: component_id is null only where no row of the component has a doc_id. Other columns are left out.
    """
    printed = stage(fingerprints(docs, size), "fingerprints")
    points = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = connected(links(points.select("fp"), bits))
    grouped = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    grouped = stage(grouped, "grouped")
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(grouped.join(names, "root").select("fp", "component_id"), "components")
    return printed.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest doc_id; same columns.

    Of repeated rows with that doc_id one stays (the smallest by all its columns). Rows without doc_id are never
    dropped, as nothing says which document they are.
    """
    found = near_duplicates(docs, size, bits)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    kept = docs.join(first, docs["doc_id"] == first["_kept"], "left").where("_kept is not null or doc_id is null")
    kept = kept.select(*docs.columns)
    # repeated ids are rare: only they are compared as whole rows
    repeated = stage(kept.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"), "repeated")
    single = kept.join(repeated, "doc_id", "left_anti")
    several = kept.join(repeated, "doc_id", "left_semi")
    one = several.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return single.select(*docs.columns).unionByName(one)
