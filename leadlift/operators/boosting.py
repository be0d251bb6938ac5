"""Regularised gradient boosting over histograms, any number of parameter sets grown side by side.

The features are binned once and written as blocks; all parameter sets read that one copy. A round grows one tree per
set, level by level; a level is one job: every block adds its rows' gradients and hessians into histograms keyed by
(set, node, feature, bin), which are summed by set where Spark shuffles them to. Splits are picked there too; the driver
gets the splits alone, so what reaches it depends on nodes, never on rows, partitions or histograms.

* Leaf values are Newton steps ``-G / (H + l2)``, times the step size. A split's gain is that of the same sums.
* Missing numbers and unseen categories are a bin of their own, which is tried on either side of every split.
  Categories are ordered by ``G / (H + l2)`` in the node before they are cut.
* Rows are sampled by a draw from their key and the round. Gradients are counted as whole numbers of ``1 / UNIT``, so
  sums do not depend on their order: the same table gives the same trees, however it is partitioned.
* A table of (set, margin cell) counts of the validation rows rides along with each round's first level. Its AUC stops a
  set after ``patience`` rounds without a better one. Afterwards the prefixes that could be best, going by the pairs
  that share a cell, get their exact AUC in one pass, and the best of them is kept.

Margins travel with the blocks, a new cached set of blocks per round, cut off by reliable checkpoints. A lost executor's
blocks are made again from the written bins.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlift.functions import draws
from leadlift.functions.trees import CATEGORY, NUMBER, BoostedTrees, Feature, Tree, bin_rows
from leadlift.operators.columns import normalise_categories, present
from leadlift.operators.labels import DRAW_KEY, with_draw_key
from leadlift.operators.models import Tuning, best_trial, draw_params, sort_trials, trial_table
from leadlift.operators.splits import SPLIT, part
from leadlift.settings import BOOST_DEFAULTS, BOOST_SPACE, CATEGORICAL, KEY, LABEL, SEED
from leadlift.sources.shipping import ship
from leadlift.sources.staging import enable_checkpoints, stage

UNIT = 1 << 24
SAMPLE = 50_000  # rows, at most about, that bounds of numeric bins are taken from
MAX_CATEGORIES = 10_000  # categories of one feature that get a bin each, the most frequent first
BLOCK_ROWS, PARTITION_ROWS = 16_384, 4_096
CELLS = 4_096  # of validation margins
TREE_MERGE = 16  # partitions beyond which sums are merged in steps
CHECKPOINT_ROUNDS = 25

BLOCKS = "rows int, bins binary, labels binary, valid binary, keys binary"


# ---- bins ---------------------------------------------------------------------------------------------------------


def fit_features(
    train: DataFrame, features: list[str], max_bins: int, categorical: list[str] = CATEGORICAL, key: str = KEY
) -> list[Feature]:
    """Bounds of numeric features from a keyed sample of about ``SAMPLE`` rows, categories from exact counts.

    The sample follows from the keys alone, so it is the same however the table is partitioned.
    """
    cats = [c for c in present(train, categorical) if c in features]
    numeric = [f for f in features if f not in cats]
    rows = train.count()
    drawn = with_draw_key(train, key).withColumn("_u", draws.uniform(DRAW_KEY, "bins"))
    sample = drawn.where(F.col("_u") < min(1.0, SAMPLE / max(rows, 1))).select(
        *[F.col(f"`{f}`").cast("double").alias(f) for f in numeric]
    ).toPandas() if numeric else {}
    made = {f: Feature(f, NUMBER, bounds=number_bounds(sample[f].to_numpy(float), max_bins)) for f in numeric}
    normal = normalise_categories(train)
    for c in cats:
        counted = normal.groupBy(F.col(c).alias("value")).count().orderBy(F.desc("count"), "value").limit(MAX_CATEGORIES)
        made[c] = Feature(c, CATEGORY, categories=tuple(r["value"] for r in counted.collect() if r["value"] is not None))
    return [made[f] for f in features]


def number_bounds(values: np.ndarray, max_bins: int) -> tuple[float, ...]:
    """Upper bounds of at most ``max_bins`` bins with about equally many of ``values`` each; the last bin is open."""
    known = np.sort(values[~np.isnan(values)])
    distinct = np.unique(known)
    if len(distinct) <= max_bins:
        return tuple((distinct[:-1] + (distinct[1:] - distinct[:-1]) / 2).tolist())
    cuts = known[(np.arange(1, max_bins) * len(known)) // max_bins]
    return tuple(c for c in np.unique(cuts).tolist() if c < distinct[-1])


def binned_blocks(df: DataFrame, features: list[Feature], label: str, key: str) -> DataFrame:
    """The train and valid rows in blocks of bins, written once."""
    rows = normalise_categories(df.where(F.col(SPLIT).isin("train", "valid") & F.col(label).isin(0, 1)))
    told = with_draw_key(rows, key).select(
        F.xxhash64(DRAW_KEY).alias("_key"),
        F.col(label).cast("int").alias("_label"),
        (F.col(SPLIT) == "valid").alias("_valid"),
        *[F.col(f"`{f.name}`").cast("double" if f.kind == NUMBER else "string").alias(f.name) for f in features],
    )

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                frame = batch.slice(at, BLOCK_ROWS).to_pandas()
                bins = bin_rows(features, frame)
                content = {
                    "bins": bins.tobytes(),
                    "labels": frame["_label"].to_numpy(np.uint8).tobytes(),
                    "valid": frame["_valid"].to_numpy(np.uint8).tobytes(),
                    "keys": frame["_key"].to_numpy(np.int64).tobytes(),
                }
                yield pa.RecordBatch.from_pydict({"rows": pa.array([len(frame)], pa.int32()), **{k: [v] for k, v in content.items()}})

    total = rows.count()
    parts = max(1, min(df.sparkSession.sparkContext.defaultParallelism, -(-total // PARTITION_ROWS)))
    parts = max(parts, -(-total // (64 * BLOCK_ROWS)))
    return stage(told.repartition(parts, "_key").mapInArrow(pack, BLOCKS), "bins")


@dataclass
class Block:
    """Rows of one task: bins, labels, which are validation rows, keys, and every set's margin per row."""

    bins: np.ndarray
    labels: np.ndarray
    valid: np.ndarray
    keys: np.ndarray
    margins: np.ndarray

    @staticmethod
    def read(row, features: int, start: list[float]) -> Block:
        n = row["rows"]
        return Block(
            np.frombuffer(bytes(row["bins"]), np.uint16).reshape(n, features),
            np.frombuffer(bytes(row["labels"]), np.uint8),
            np.frombuffer(bytes(row["valid"]), np.uint8).astype(bool),
            np.frombuffer(bytes(row["keys"]), np.int64),
            np.repeat(np.array(start)[:, None], n, axis=1),
        )

    def grown(self, trees: dict[int, Tree]) -> Block:
        margins = self.margins.copy()
        for s, tree in trees.items():
            margins[s] += tree.margins(self.bins)
        return Block(self.bins, self.labels, self.valid, self.keys, margins)


# ---- histograms ---------------------------------------------------------------------------------------------------


@dataclass
class Layout:
    """Where each feature's bins lie in a node's histogram."""

    offsets: np.ndarray
    cells: int

    @staticmethod
    def of(features: list[Feature]) -> Layout:
        sizes = np.array([f.bins for f in features])
        return Layout(np.cumsum(sizes) - sizes, int(sizes.sum()))


def drawn(keys: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """A uniform draw per row from its key, the seed and the round."""
    x = keys.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


@dataclass
class Level:
    """What a level's job is told: per set its unfinished tree, the nodes to count, and the share of rows sampled; and
    the sets whose validation margins are counted too."""

    turn: int
    seed: int
    layout: Layout
    trees: dict[int, Tree]
    wanted: dict[int, list[int]]
    shares: dict[int, float]
    cells: list[int]


Counts = tuple[np.ndarray, np.ndarray]


def count_block(block: Block, level: Level) -> dict[int, Counts]:
    """By set: histograms (nodes, cells, 3) of sums of gradients, hessians and rows; and cell counts (CELLS, 2)."""
    train = ~block.valid
    u = drawn(block.keys, level.seed, level.turn)
    width = level.layout.cells
    told = {s: (np.zeros((0, width, 3), np.int64), np.zeros((0, 2), np.int64)) for s in {*level.wanted, *level.cells}}
    for s, nodes in level.wanted.items():
        rows = np.flatnonzero(train & (u < level.shares[s]))
        p = 1.0 / (1.0 + np.exp(-block.margins[s, rows]))
        gradient = np.rint((p - block.labels[rows]) * UNIT)
        hessian = np.rint(p * (1.0 - p) * UNIT)
        place = np.full(len(level.trees[s].feature), -1)
        place[nodes] = np.arange(len(nodes))
        at = place[level.trees[s].nodes_of(block.bins[rows])]
        inside = np.flatnonzero(at >= 0)
        bins = block.bins[rows[inside]]
        cell = (at[inside, None] * width + level.layout.offsets + bins).ravel()
        size = len(nodes) * width
        sums = np.empty((size, 3), np.int64)
        for i, weight in enumerate((gradient, hessian)):
            sums[:, i] = np.bincount(cell, np.repeat(weight[inside], bins.shape[1]), size)
        sums[:, 2] = np.bincount(cell, minlength=size)
        told[s] = sums.reshape(len(nodes), width, 3), told[s][1]
    for s in level.cells:
        cell = margin_cell(block.margins[s, block.valid]) * 2 + block.labels[block.valid]
        told[s] = told[s][0], np.bincount(cell, minlength=2 * CELLS).reshape(CELLS, 2)
    return told


def margin_cell(margins: np.ndarray) -> np.ndarray:
    """The cell of a margin; a larger cell always means larger margins."""
    return np.clip(np.floor((margins + 8.0) * (CELLS / 16.0)), 0, CELLS - 1).astype(np.int64)


def add(a: Counts, b: Counts) -> Counts:
    return a[0] + b[0], a[1] + b[1]


def total_of(blocks: RDD, level: Level, parts: int) -> RDD:
    """(set, its sums over all blocks), spread over ``parts`` partitions."""

    def count(rows):
        found: dict[int, Counts] = {}
        for block in rows:
            for s, told in count_block(block, level).items():
                found[s] = add(found[s], told) if s in found else told
        return iter(found.items())

    counted = blocks.mapPartitions(count)
    if blocks.getNumPartitions() > TREE_MERGE:
        # no task gets more than about TREE_MERGE sums of a set at once
        steps = -(-blocks.getNumPartitions() // TREE_MERGE)
        named = counted.mapPartitionsWithIndex(lambda i, rows: (((s, i % steps), told) for s, told in rows))
        counted = named.reduceByKey(add, steps * parts).map(lambda found: (found[0][0], found[1]))
    return counted.reduceByKey(add, parts)


# ---- splits -------------------------------------------------------------------------------------------------------


def gain_term(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g * g / np.maximum(h + l2, 1e-12)


def best_splits(
    sums: np.ndarray, features: list[Feature], layout: Layout, params: Mapping, noise: np.random.Generator | None
) -> list[tuple[int, list[int]] | None]:
    """For each node of ``sums`` (nodes, cells, 3): (feature, bins that go left) of the split with the largest gain.

    Ties go to the first feature and the first cut. None where no split gains anything or leaves too few rows.
    """
    l2, least = float(params["l2"]), max(1, int(params["minInstancesPerNode"]))
    unit = sums / np.array([UNIT, UNIT, 1.0])
    total = unit[:, layout.offsets[0] : layout.offsets[0] + features[0].bins].sum(axis=1)
    whole = gain_term(total[:, 0], total[:, 1], l2)
    nodes = np.arange(len(sums))
    scale = None
    if noise is not None:
        scale = float(params["randomStrength"]) * np.sqrt(whole / np.maximum(total[:, 2], 1.0))
    best = np.full(len(sums), max(float(params["minInfoGain"]), 1e-9))
    found: list[tuple[int, list[int]] | None] = [None] * len(sums)
    for f, feature in enumerate(features):
        own = unit[:, layout.offsets[f] : layout.offsets[f] + feature.bins]
        missing, known = own[:, 0], own[:, 1:]
        width = known.shape[1]
        if not width:
            continue
        order = np.broadcast_to(np.arange(width), known.shape[:2])
        if feature.kind == CATEGORY:
            order = np.argsort(known[:, :, 0] / (known[:, :, 1] + max(l2, 1e-9)), axis=1, kind="stable")
            known = np.take_along_axis(known, order[:, :, None], axis=1)
        before = np.cumsum(known, axis=1)
        # coarser sets of bins cut at every few bounds only; the last cut sets the missing apart from all others
        step = max(1, -(-width // int(params["maxBins"]))) if feature.kind == NUMBER else 1
        cuts = np.append(np.arange(step - 1, width - 1, step), width - 1)
        for with_missing in (False, True) if missing[:, 2].any() else (False,):
            left = before[:, cuts] + (missing[:, None] if with_missing else 0)
            right = total[:, None] - left
            gain = gain_term(left[..., 0], left[..., 1], l2) + gain_term(right[..., 0], right[..., 1], l2) - whole[:, None]
            if scale is not None:
                gain = gain + noise.normal(size=gain.shape) * scale[:, None]
            gain = np.where((left[..., 2] >= least) & (right[..., 2] >= least), gain, -np.inf)
            at = np.argmax(gain, axis=1)
            top = gain[nodes, at]
            for node in np.flatnonzero(top > best).tolist():
                best[node] = top[node]
                lefts = sorted((order[node, : cuts[at[node]] + 1] + 1).tolist())
                found[node] = (f, [0, *lefts] if with_missing else lefts)
    return found


# ---- AUC ----------------------------------------------------------------------------------------------------------


def auc_of_cells(cells: np.ndarray) -> tuple[float, float] | None:
    """(AUC with pairs of one cell counted half, half the share of such pairs); None with a single class."""
    negative, positive = cells[:, 0].astype(float), cells[:, 1].astype(float)
    pairs = negative.sum() * positive.sum()
    if not pairs:
        return None
    below = np.cumsum(negative) - negative
    shared = float((positive * negative).sum()) / (2 * pairs)
    return float((positive * below).sum()) / pairs + shared, shared


def exact_aucs(bins: DataFrame, models: dict[int, BoostedTrees], prefixes: dict[int, list[int]]) -> dict:
    """{(set, trees): AUC} on the validation rows, all in one pass.

    Margins are counted by value first, so copies of one never meet; running sums are taken inside a cell of margins,
    on top of the exact totals of the cells below.
    """
    wanted = {s: sorted(ks) for s, ks in prefixes.items() if ks}
    if not wanted:
        return {}
    width = len(next(iter(models.values())).features)

    def margins(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row, width, [0.0])
                rows = block.bins[block.valid]
                for s, ks in wanted.items():
                    sums, done = np.full(len(rows), models[s].bias), 0
                    for k in ks:
                        for tree in models[s].trees[done:k]:
                            sums = sums + tree.margins(rows)
                        done = k
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, s, np.int32)),
                                pa.array(np.full(n, k, np.int32)),
                                pa.array(margin_cell(sums).astype(np.int32)),
                                pa.array(sums),
                                pa.array(block.labels[block.valid].astype(np.int32)),
                            ],
                            ["part", "trees", "cell", "margin", "y"],
                        )

    told = bins.mapInArrow(margins, "part int, trees int, cell int, margin double, y int")
    by_value = told.groupBy("part", "trees", "cell", "margin").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    )
    inside = Window.partitionBy("part", "trees", "cell").orderBy("margin").rowsBetween(Window.unboundedPreceding, -1)
    less = by_value.withColumn("less", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    by_cell = less.groupBy("part", "trees", "cell").agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (F.col("less") + F.col("neg") / 2)).alias("won"),
    )
    found: dict = {}
    below = Window.partitionBy("part", "trees").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    summed = by_cell.withColumn("under", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    won = F.sum(F.col("won") + F.col("pos") * F.col("under"))
    for row in summed.groupBy("part", "trees").agg(won.alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect():
        found[row["part"], row["trees"]] = row["won"] / (row["p"] * row["n"]) if row["p"] and row["n"] else None
    return found


# ---- growing ------------------------------------------------------------------------------------------------------


@dataclass
class Growth:
    """One parameter set's trees while they grow."""

    params: dict
    trees: list[Tree] = field(default_factory=list)
    aucs: list[tuple[float, float]] = field(default_factory=list)
    stopped: bool = False

    def told(self, auc: tuple[float, float] | None) -> None:
        """The AUC of the trees so far; stops after ``patience`` trees without a better one."""
        if auc is None:
            return
        self.aucs.append(auc)
        best = max(range(len(self.aucs)), key=lambda i: (self.aucs[i][0], -i))
        if len(self.aucs) - 1 - best >= int(self.params["patience"]):
            self.stopped = True

    def candidates(self) -> list[int]:
        """Numbers of trees whose exact AUC may be the best, given how many pairs share a cell."""
        if not self.aucs:
            return []
        least = max(auc - shared for auc, shared in self.aucs)
        return [i + 1 for i, (auc, shared) in enumerate(self.aucs) if auc + shared >= least]


def boost_params(params: Mapping | None) -> dict:
    """The defaults with the given values; names that no tree has are refused."""
    unknown = sorted(set(params or {}) - set(BOOST_DEFAULTS))
    if unknown:
        raise ValueError(f"unknown tree parameters {unknown}; known are {sorted(BOOST_DEFAULTS)}")
    return {**BOOST_DEFAULTS, **(params or {})}


@dataclass
class Split:
    """A split that pays: the node, the feature, the bins that go left, and the sums of either side."""

    node: int
    feature: int
    left: np.ndarray
    sums: tuple[np.ndarray, np.ndarray]


def split_nodes(
    sums: dict[int, np.ndarray], features: list[Feature], layout: Layout, params: Mapping, noise
) -> list[Split]:
    """The splits of the nodes of ``sums``, where one pays."""
    open_, out = sorted(sums), []
    found = best_splits(np.stack([sums[n] for n in open_]), features, layout, params, noise)
    for node, split in zip(open_, found, strict=True):
        if split is None:
            continue
        feature, left = split
        own = sums[node][layout.offsets[feature] : layout.offsets[feature] + features[feature].bins]
        lefts = own[left].sum(axis=0)
        out.append(Split(node, feature, np.array(left, np.uint16), (lefts, own.sum(axis=0) - lefts)))
    return out


def grow_level(tree: Tree, splits: list[Split], params: Mapping) -> list[tuple[int, int, int]]:
    """Split nodes; (parent, left, right) of the new ones."""
    made = []
    for split in splits:
        pair = tree.split(split.node, split.feature, split.left.tolist())
        for child, told in zip(pair, split.sums):
            set_leaf(tree, child, told, params)
        made.append((split.node, *pair))
    return made


def set_leaf(tree: Tree, node: int, sums: np.ndarray, params: Mapping) -> None:
    g, h = sums[0] / UNIT, sums[1] / UNIT
    bottom = h + float(params["l2"])
    tree.value[node] = -float(params["stepSize"]) * g / bottom if bottom > 0 else 0.0
    tree.rows[node] = int(sums[2])


def level_splits(blocks: RDD, level: Level, known: Broadcast, params: dict[int, dict], noise: dict) -> dict:
    """{set: (splits, its noise as it goes on, sums of the first node, AUC over cells)}, from one job.

    Splits are picked where a set's histograms are summed, for sets of ``params`` only.
    """
    layout, wanted = level.layout, level.wanted

    def pick(found):
        s, (sums, cells) = found
        features, splits, first = known.value, [], None
        if len(sums):
            first = sums[0, layout.offsets[0] : layout.offsets[0] + features[0].bins].sum(axis=0)
        if len(sums) and s in params:
            splits = split_nodes(dict(zip(wanted[s], sums)), features, layout, params[s], noise[s])
        return s, (splits, noise.get(s), first, auc_of_cells(cells) if len(cells) else None)

    parts = min(len({*wanted, *level.cells}), blocks.getNumPartitions())
    return dict(total_of(blocks, level, parts).map(pick).collect())  # splits of at most a level's nodes a set


def grow_trees(
    blocks: RDD, sets: dict[int, Growth], fresh: list[int], known: Broadcast, layout: Layout, turn: int, seed: int
) -> dict[int, Tree]:
    """One more tree for each set of ``fresh`` that goes on; the first level's job also tells their AUC so far."""
    more = [s for s in fresh if len(sets[s].trees) < int(sets[s].params["maxIter"])]
    trees = {s: Tree() for s in more}
    shares = {s: float(sets[s].params["subsamplingRate"]) for s in more}
    # the noise of a set is its own, whatever other sets grow beside it
    noise = {s: np.random.default_rng([seed, turn, s]) if float(sets[s].params["randomStrength"]) > 0 else None for s in more}
    level, depth = Level(turn, seed, layout, trees, {s: [0] for s in more}, shares, fresh if turn else []), 1
    deep = {s: sets[s].params for s in more if int(sets[s].params["maxDepth"]) >= depth}
    if not more and not level.cells:
        return {}
    found = level_splits(blocks, level, known, deep, noise)
    for s in level.cells:
        sets[s].told(found[s][3])
    trees = {s: tree for s, tree in trees.items() if not sets[s].stopped}
    for s, tree in trees.items():
        set_leaf(tree, 0, found[s][2], sets[s].params)
    growing = dict(trees)
    while growing:
        pairs = {s: grow_level(tree, found[s][0], sets[s].params) for s, tree in growing.items()}
        # nodes of the last level are leaves and need no histogram
        pairs = {s: made for s, made in pairs.items() if made and depth < int(sets[s].params["maxDepth"])}
        growing, depth = {s: trees[s] for s in pairs}, depth + 1
        if growing:
            wanted = {s: sorted(c for _, a, b in made for c in (a, b)) for s, made in pairs.items()}
            noise, params = {s: found[s][1] for s in growing}, {s: sets[s].params for s in growing}
            found = level_splits(blocks, Level(turn, seed, layout, growing, wanted, shares, []), known, params, noise)
    return trees


@dataclass
class Boosted:
    """What one parameter set came to: the kept model, all trees grown, and the exact validation AUC, if there is one."""

    model: BoostedTrees
    params: dict
    grown: list[Tree]
    valid_auc: float | None


def fit_many(
    df: DataFrame,
    features: list[str],
    params: list[Mapping],
    label: str = LABEL,
    seed: int = SEED,
    key: str = KEY,
    categorical: list[str] = CATEGORICAL,
) -> list[Boosted]:
    """Boosted trees for every one of ``params``, fitted on ``train``; ``valid`` decides how many trees are kept.

    Of the prefixes grown, the one with the largest exact AUC on ``valid`` is kept, the shortest on ties; all trees are
    kept where ``valid`` has no pair to compare. Rows without a label of 0 or 1 take no part.
    """
    spark = df.sparkSession
    ship(spark)
    enable_checkpoints(spark)
    sets = {s: Growth(boost_params(p)) for s, p in enumerate(params)}
    if not sets:
        return []
    train = part(df, "train").where(F.col(label).isin(0, 1))
    finest = max(int(g.params["maxBins"]) for g in sets.values())
    binned = fit_features(train, features, finest, categorical, key)
    layout, width = Layout.of(binned), len(features)
    bins = binned_blocks(df, binned, label, key)
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    bias = math.log((positive + 0.5) / (negative + 0.5))
    start = [bias] * len(sets)

    def first(row) -> Block:
        return Block.read(row, width, start)

    def after(blocks: RDD, trees: dict[int, Tree]) -> RDD:
        return blocks.map(lambda block: block.grown(trees))

    known = spark.sparkContext.broadcast(binned)
    blocks = bins.rdd.map(first).persist(StorageLevel.MEMORY_AND_DISK)
    fresh, turn = list(sets) if positive and negative else [], 0
    while fresh:
        trees = grow_trees(blocks, sets, fresh, known, layout, turn, seed)
        if turn:
            before.unpersist()
        for s, tree in trees.items():
            sets[s].trees.append(tree)
        fresh, turn = list(trees), turn + 1
        if fresh:
            before, blocks = blocks, after(blocks, trees).persist(StorageLevel.MEMORY_AND_DISK)
            if turn % CHECKPOINT_ROUNDS == 0:
                blocks.checkpoint()
    blocks.unpersist()

    models = {s: BoostedTrees(binned, bias, g.trees) for s, g in sets.items()}
    exact = exact_aucs(bins, models, {s: g.candidates() for s, g in sets.items()})
    out = []
    for s, growth in sets.items():
        known = {k: auc for (own, k), auc in exact.items() if own == s and auc is not None}
        kept = max(known, key=lambda k: (known[k], -k)) if known else len(growth.trees)
        model = BoostedTrees(binned, bias, growth.trees[:kept])
        out.append(Boosted(model, growth.params, growth.trees, known.get(kept)))
    return out


def fit_boosted(df: DataFrame, features: list[str], params: Mapping | None = None, **args) -> BoostedTrees:
    """Boosted trees for one parameter set; see ``fit_many``."""
    return fit_many(df, features, [params or {}], **args)[0].model


def tune_boosted(
    df: DataFrame, features: list[str], trials: int, seed: int = SEED, space: Mapping[str, tuple] = BOOST_SPACE, **args
) -> Tuning:
    """Random search: every draw is grown side by side; the first trial with the best exact validation AUC wins."""
    params = draw_params(trials, seed, space)
    fitted = fit_many(df, features, params, seed=seed, **args)
    rows = [
        {"trial": i + 1, "valid_auc": b.valid_auc, **{f"param_{k}": v for k, v in p.items()}}
        for i, (p, b) in enumerate(zip(params, fitted, strict=True))
    ]
    table = trial_table(df.sparkSession, rows, space)
    best = best_trial(table).first()["trial"] - 1
    return Tuning(fitted[best].model, params[best], fitted[best].valid_auc, sort_trials(table), fitted)
