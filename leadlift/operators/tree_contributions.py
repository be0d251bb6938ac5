"""Shapley contributions of boosted trees, computed where the rows are.

A leaf contributes to a row only through the features on its path. For path features D, let ``meets[j]`` say whether
the row satisfies the path's conditions on j, and ``share[j]`` be the share of training rows that follow the path at
j's splits. The leaf's contribution to feature i is then

    value * (meets[i] - share[i]) * sum over subsets S of D without i of
        |S|! (|D| - |S| - 1)! / |D|! * prod(meets[j], j in S) * prod(share[j], j not in S)

The leaves are a small table, at most trees * 2^depth entries whatever the data, sent to the executors once and turned
into look-up tables once per task; rows never leave their partition. The numpy part is ``functions/shapley.py``; it is shipped with the job by value, so executors
need no installed copy of this package.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlift.functions import shapley
from leadlift.functions.shapley import ANYTHING, LeafTables, expected_value
from leadlift.functions.trees import BoostedTrees, bin_rows
from leadlift.operators.columns import normalise_categories
from leadlift.operators.explain import EXPECTED, contribution_columns
from leadlift.operators.models import by_kind
from leadlift.operators.tree_scoring import feature_struct
from leadlift.sources.shipping import ship
from leadlift.sources.staging import staging_path

cloudpickle.register_pickle_by_value(shapley)

# Spark's tree margin m gives the probability 1 / (1 + exp(-2m)): the log-odds are twice the margin.
LOG_ODDS_PER_MARGIN = 2.0
# 1000 trees of depth 8; each leaf is a few hundred bytes
MAX_LEAVES = 256_000


def narrowed(condition: tuple, split, left: bool, share: float) -> tuple:
    """The condition after also passing ``split`` to the left or right, followed by ``share`` of the rows."""
    low, high, allowed, before = condition
    if split.numCategories > 0:
        lefts = set(split.leftCategoriesOrThreshold)
        side = lefts if left else {float(c) for c in range(split.numCategories)} - lefts
        allowed = tuple(sorted(side if allowed is None else side & set(allowed)))
    elif left:
        high = min(high, split.leftCategoriesOrThreshold[0])
    else:
        low = max(low, split.leftCategoriesOrThreshold[0])
    return low, high, allowed, before * share


def read_leaves(spark: SparkSession, model: PipelineModel) -> list[tuple]:
    """All leaves with their values in log-odds, from the node table of the saved trees."""
    trees = model.stages[-1]
    path = staging_path(spark, "trees")
    trees.write().overwrite().save(path)
    nodes: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").collect():
        nodes.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
    leaves = []
    for tree, weight in enumerate(trees.treeWeights):
        pending = [(nodes[tree][0], {})]
        while pending:
            node, path_so_far = pending.pop()
            if node.leftChild < 0:
                leaves.append((LOG_ODDS_PER_MARGIN * weight * node.prediction, path_so_far))
                continue
            feature = node.split.featureIndex
            for child_id, left in ((node.leftChild, True), (node.rightChild, False)):
                child = nodes[tree][child_id]
                known = path_so_far.get(feature, ANYTHING)
                step = narrowed(known, node.split, left, child.rawCount / node.rawCount)
                pending.append((child, {**path_so_far, feature: step}))
    return leaves


def add_tree_contributions(df: DataFrame, model: PipelineModel | BoostedTrees, features: list[str]) -> DataFrame:
    """Add ``exp_expected_value`` and one contribution column per feature, in log-odds.

    Expected value plus contributions equals the row's log-odds. Only the features cross to Python, as one array or as
    the columns that trees over bins were fitted on.
    """
    spark = df.sparkSession
    binned = isinstance(model, BoostedTrees)
    leaves = model.leaves() if binned else read_leaves(spark, model)
    if len(leaves) > MAX_LEAVES:
        raise ValueError(f"{len(leaves)} leaves are more than the {MAX_LEAVES} that are sent to executors")
    shared = spark.sparkContext.broadcast(leaves)  # Spark drops it once nothing refers to it
    known = spark.sparkContext.broadcast(model.features if binned else None)

    def explain(x: np.ndarray, tables: LeafTables) -> pd.Series:
        return pd.Series(list(tables.contributions(x)))

    @F.pandas_udf("array<double>")
    def of_vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = LeafTables(shared.value)
        for vectors in batches:
            yield pd.Series([], dtype=object) if vectors.empty else explain(np.stack(vectors.to_list()), tables)

    @F.pandas_udf("array<double>")
    def of_columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        tables = LeafTables(shared.value)
        for rows in batches:
            yield pd.Series([], dtype=object) if rows.empty else explain(bin_rows(known.value, rows).astype(float), tables)

    if binned:
        ship(spark)
        names = [f.name for f in model.features]
        explained = df.withColumn("_contributions", of_columns(feature_struct(model)))
    else:
        numeric, cats = by_kind(df, features)
        names = [*numeric, *cats]
        prepared = normalise_categories(df)
        for stage_model in model.stages[:-1]:
            prepared = stage_model.transform(prepared)
        vector = vector_to_array(F.col(model.stages[-1].getFeaturesCol()))
        explained = prepared.withColumn("_contributions", of_vectors(vector))
    values = {f: F.get("_contributions", F.lit(names.index(f))) for f in features}
    columns = contribution_columns(values, df.columns)
    expected = float(sum(map(expected_value, leaves)))
    kept = [F.col(f"`{c}`") for c in df.columns if c != EXPECTED]
    return explained.select(*kept, F.lit(expected).alias(EXPECTED), *columns.values())
