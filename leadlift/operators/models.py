"""Fitted models: the scaled logistic baseline, boosted trees, importance, tuning and scoring.

All fits are Spark ML jobs over a staged table that carries its ``split`` column.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from leadlift.functions.trees import BoostedTrees
from leadlift.operators.columns import normalise_categories, present, restrict_features
from leadlift.operators.encoding import (
    filled,
    filling_stages,
    index_name,
    index_stages,
    one_hot_stages,
    scaling_stages,
    slots_name,
)
from leadlift.operators.metrics import roc_auc
from leadlift.operators.splits import part
from leadlift.operators.tree_scoring import margin_column
from leadlift.settings import CATEGORICAL, GBT_DEFAULTS, ID_COLUMNS, LABEL, SCORE, SEED, TUNE_SPACE
from leadlift.sources.staging import enable_checkpoints, scope, stage
from leadlift.sources.tables import rows_to_table

VECTOR = "features"

IMPORTANCE_SCHEMA = StructType([StructField("feature", StringType()), StructField("importance", DoubleType())])


def by_kind(df: DataFrame, features: list[str], categorical: list[str] = CATEGORICAL) -> tuple[list[str], list[str]]:
    """(numeric, categorical) features, each in the given order; the order in which vectors are assembled."""
    cats = [c for c in present(df, categorical) if c in features]
    return [f for f in features if f not in cats], cats


# ---- fits ---------------------------------------------------------------------------------------------------------


def fit_baseline(df: DataFrame, features: list[str], label: str = LABEL, strength: float = 1.0) -> PipelineModel:
    """Scaled, one-hot encoded, L2-regularised logistic regression on the ``train`` part.

    ``strength`` is the weight C of the summed loss against the penalty; Spark averages the loss, hence 1 / (C * n).
    """
    train = normalise_categories(part(df, "train"))
    rows = train.count()
    numeric, cats = by_kind(train, features)
    stages = filling_stages(numeric) + scaling_stages(filled(numeric), rows) + one_hot_stages(cats)
    stages.append(VectorAssembler(inputCols=["scaled", *map(slots_name, cats)], outputCol=VECTOR))
    stages.append(
        LogisticRegression(
            featuresCol=VECTOR,
            labelCol=label,
            regParam=1.0 / (strength * rows),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=2000,
        )
    )
    return Pipeline(stages=stages).fit(train)


def fit_encoder(df: DataFrame, features: list[str]) -> PipelineModel:
    """Numerics (missing ones as the median), then nominal category numbers, learnt from ``train``, in one vector."""
    train = normalise_categories(part(df, "train"))
    numeric, cats = by_kind(train, features)
    assembler = VectorAssembler(inputCols=[*filled(numeric), *map(index_name, cats)], outputCol=VECTOR)
    return Pipeline(stages=[*filling_stages(numeric), *index_stages(cats), assembler]).fit(train)


def category_slots(encoder: PipelineModel) -> int:
    """The largest number of categories of one feature, unseen values included."""
    found = [len(labels) for s in encoder.stages if isinstance(s, StringIndexerModel) for labels in s.labelsArray]
    return max(found, default=0) + 1


def tree_params(params: Mapping | None) -> dict:
    """The defaults with the given values; names that no tree has are refused."""
    unknown = sorted(set(params or {}) - set(GBT_DEFAULTS))
    if unknown:
        raise ValueError(f"unknown tree parameters {unknown}; known are {sorted(GBT_DEFAULTS)}")
    return {**GBT_DEFAULTS, **(params or {})}


def fit_trees(
    df: DataFrame,
    features: list[str],
    params: Mapping | None = None,
    label: str = LABEL,
    seed: int = SEED,
    early_stop: bool = True,
    encoder: PipelineModel | None = None,
) -> PipelineModel:
    """Gradient-boosted trees on the ``train`` part; categoricals enter as nominal indexes.

    With ``early_stop`` the ``valid`` part decides how many trees are kept: of the rounds up to the first ``patience``
    rounds in a row that bring no lower validation loss, the prefix with the lowest one. The returned model holds only
    that prefix. A fitted ``encoder`` can be shared by several fits. Features with more categories than ``maxBins`` get
    as many bins as they need.
    """
    chosen = tree_params(params)
    enable_checkpoints(df.sparkSession)
    encoder = fit_encoder(df, features) if encoder is None else encoder
    trees = GBTClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        seed=seed,
        maxIter=int(chosen["maxIter"]),
        maxDepth=int(chosen["maxDepth"]),
        stepSize=float(chosen["stepSize"]),
        subsamplingRate=float(chosen["subsamplingRate"]),
        maxBins=max(int(chosen["maxBins"]), category_slots(encoder)),
        minInstancesPerNode=int(chosen["minInstancesPerNode"]),
        minInfoGain=float(chosen["minInfoGain"]),
    )

    def encoded(name: str) -> DataFrame:
        return encoder.transform(normalise_categories(part(df, name))).select(VECTOR, label)

    model = trees.fit(encoded("train"))
    if early_stop:
        losses = model.evaluateEachIteration(encoded("valid"))
        model = tree_prefix(model, rounds_to_keep(losses, int(chosen["patience"])))
    return PipelineModel(stages=[*encoder.stages, model])


def rounds_to_keep(losses: list[float], patience: int) -> int:
    """Rounds up to the lowest loss before ``patience`` rounds in a row brought no lower one; all without losses."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def tree_prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """A model of the first ``rounds`` trees."""
    if rounds >= model.getNumTrees:
        return model
    context = SparkContext._active_spark_context
    jvm, own = context._jvm, model._java_obj
    trees = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = own.trees()[i], own.treeWeights()[i]
    shorter = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        own.uid(), trees, weights, own.numFeatures(), own.numClasses()
    )
    return model._copyValues(GBTClassificationModel(shorter))


def add_probability(model: PipelineModel | BoostedTrees, df: DataFrame, column: str = SCORE) -> DataFrame:
    """``df`` with the probability of class 1; its other columns, key included, are unchanged."""
    if isinstance(model, BoostedTrees):
        score = 1.0 / (1.0 + F.exp(-margin_column(model, df)))
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c != column], score.alias(column))
    scored = model.transform(normalise_categories(df))
    return scored.withColumn(column, F.get(vector_to_array("probability"), F.lit(1))).select(*df.columns, column)


def score_part(
    model: PipelineModel,
    df: DataFrame,
    selected: list[str],
    name: str = "test",
    ids: list[str] = ID_COLUMNS,
    label: str = LABEL,
) -> DataFrame:
    """Scored rows of one split part: ids, label, the selected features, probability. Staged once, because the
    reports, deciles and leads all read it."""
    scored = add_probability(model, part(df, name))
    return stage(restrict_features(scored, [*selected, SCORE], ids, keep=(label,)), "scored")


def with_auc(
    scored: DataFrame,
    auc: float | None = None,
    label: str = LABEL,
    score: str = SCORE,
    column: str = "auc_on_test",
) -> DataFrame:
    """Repeat the scored table's ROC AUC on every row: a known value, else a scalar subquery."""
    value = roc_auc(scored, label, score).scalar() if auc is None else F.lit(float(auc))
    return scored.withColumn(column, value)


def feature_importance(
    model: PipelineModel | BoostedTrees, df: DataFrame, features: list[str], scale: float = 1.0
) -> DataFrame:
    """(feature, importance), largest first, adding up to ``scale``: the change of predictions by the splits of trees
    over bins, Spark's gain for Spark's trees."""
    if isinstance(model, BoostedTrees):
        change = dict(zip([f.name for f in model.features], model.prediction_change().tolist(), strict=True))
        rows = [{"feature": f, "importance": change[f] * scale / 100.0} for f in features]
        return sort_importance(rows_to_table(df.sparkSession, rows, IMPORTANCE_SCHEMA))
    numeric, cats = by_kind(df, features)
    names = [*numeric, *cats]
    values = model.stages[-1].featureImportances.toArray()
    rows = [{"feature": f, "importance": float(values[i]) * scale} for i, f in enumerate(names)]
    return sort_importance(rows_to_table(df.sparkSession, rows, IMPORTANCE_SCHEMA))


def sort_importance(table: DataFrame, column: str = "importance") -> DataFrame:
    return table.orderBy(F.desc(column), "feature")


def top_features(importance: DataFrame, k: int, column: str = "importance") -> list[str]:
    """Names of the k most important features."""
    return [row["feature"] for row in sort_importance(importance, column).limit(int(k)).collect()]


# ---- tuning -------------------------------------------------------------------------------------------------------


def draw_params(trials: int, seed: int = SEED, space: Mapping[str, tuple] = TUNE_SPACE) -> list[dict]:
    """Seeded random-search draws: integers for integer ranges, uniform reals otherwise."""
    rng = np.random.default_rng(int(seed))

    def one(low, high):
        whole = isinstance(low, int) and isinstance(high, int)
        return int(rng.integers(low, high)) if whole else float(rng.uniform(low, high))

    return [{name: one(*bounds) for name, bounds in space.items()} for _ in range(int(trials))]


@dataclass
class Tuning:
    model: PipelineModel
    params: dict
    valid_auc: float
    trials: DataFrame
    fitted: list = field(default_factory=list)


def tune_trees(
    df: DataFrame,
    features: list[str],
    trials: int,
    seed: int = SEED,
    space: Mapping[str, tuple] = TUNE_SPACE,
    label: str = LABEL,
    parallelism: int = 2,
) -> Tuning:
    """Random search: fit every draw on ``train``, compare exact ROC AUC on ``valid``; the first best trial wins.

    Trials run as concurrent Spark jobs, so the cluster stays busy while one trial waits for its driver steps.
    """
    spark = df.sparkSession
    draws = draw_params(trials, seed, space)
    encoder = fit_encoder(df, features)

    def run(params: dict) -> tuple[PipelineModel, float | None]:
        model = fit_trees(df, features, params, label, seed, encoder=encoder)
        with scope(spark):
            scored = stage(add_probability(model, part(df, "valid")).select(label, SCORE), "trial")
            return model, roc_auc(scored, label).first()["auc_roc"]

    with ThreadPoolExecutor(max_workers=max(1, int(parallelism))) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(run), draws))

    rows = [
        {"trial": i + 1, "valid_auc": auc, **{f"param_{k}": v for k, v in params.items()}}
        for i, (params, (_, auc)) in enumerate(zip(draws, results))
    ]
    table = trial_table(spark, rows, space)
    best = best_trial(table).first()["trial"] - 1
    return Tuning(results[best][0], draws[best], results[best][1], sort_trials(table))


def trial_table(spark, rows: list[dict], space: Mapping[str, tuple]) -> DataFrame:
    fields = [StructField("trial", IntegerType()), StructField("valid_auc", DoubleType())]
    for name, (low, _) in space.items():
        fields.append(StructField(f"param_{name}", IntegerType() if isinstance(low, int) else DoubleType()))
    return rows_to_table(spark, rows, StructType(fields))


def sort_trials(trials: DataFrame) -> DataFrame:
    return trials.orderBy(F.desc_nulls_last("valid_auc"), "trial")


def best_trial(trials: DataFrame) -> DataFrame:
    """The single row with the highest validation AUC; the earliest trial wins ties."""
    return sort_trials(trials).limit(1)
