"""Contributions: linear ones by hand, tree ones against brute-force Shapley values."""

import itertools
import math
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leadlift.functions.numeric import contribution_column
from leadlift.operators import explain
from leadlift.operators.exports import lead_columns
from leadlift.operators.models import add_probability
from leadlift.functions.shapley import batch_contributions, expected_value, met
from leadlift.operators.tree_contributions import add_tree_contributions, read_leaves


def brute_shapley(leaf, x, size):
    """Path-dependent Shapley values of one leaf from their definition."""
    def value(known):
        v, path = leaf
        for j, condition in path.items():
            v *= float(met(condition, np.array([x[j]]))[0]) if j in known else condition[3]
        return v

    phi = np.zeros(size)
    players = range(size)
    for i in players:
        others = [j for j in players if j != i]
        for k in range(size):
            for subset in itertools.combinations(others, k):
                weight = math.factorial(k) * math.factorial(size - 1 - k) / math.factorial(size)
                phi[i] += weight * (value({*subset, i}) - value(set(subset)))
    return phi


def test_batch_matches_definition():
    rng = np.random.default_rng(5)
    leaves = []
    for _ in range(6):
        path = {}
        for j in rng.choice(4, size=rng.integers(1, 5), replace=False):
            low, high = sorted(rng.normal(size=2))
            path[int(j)] = (low, high, None, float(rng.uniform(0.1, 0.9)))
        leaves.append((float(rng.normal()), path))
    leaves.append((0.7, {2: (-math.inf, math.inf, (0.0, 2.0), 0.4)}))
    leaves.append((0.3, {}))
    x = rng.normal(size=(25, 4))
    x[:5, 2] = [0, 1, 2, 0, 3]
    expected = [sum(brute_shapley(leaf, row, 4) for leaf in leaves) for row in x]
    assert batch_contributions(leaves, x) == pytest.approx(np.array(expected), abs=1e-12)


def test_long_paths():
    """More path features than the evaluation tabulates at once."""
    rng = np.random.default_rng(8)
    leaf = (1.5, {j: (-0.5, 1.0, None, 0.3 + 0.05 * j) for j in range(9)})
    x = rng.normal(size=(6, 9))
    assert batch_contributions([leaf], x) == pytest.approx(np.array([brute_shapley(leaf, row, 9) for row in x]), abs=1e-12)


def test_runs_where_the_package_is_not_installed():
    from pyspark import cloudpickle

    code = "import pickle, sys, numpy; print(pickle.load(sys.stdin.buffer)([(2.0, {0: (0.0, 9.0, None, 0.5)})], numpy.array([[1.0]])))"
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(batch_contributions), capture_output=True, cwd="/"
    )
    assert done.stdout.decode().strip() == "[[1.]]", done.stderr.decode()


def test_missing_values_go_right():
    nan = np.array([np.nan])
    assert met((1.0, math.inf, None, 1.0), nan)[0]
    assert not met((-math.inf, 1.0, None, 1.0), nan)[0]


@pytest.fixture(scope="module")
def tiny_model(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        a, b, c = rng.normal(), rng.normal(), "pqrs"[rng.integers(4)]
        y = int(a + 0.5 * b * (c == "p") + (c in "qr") + rng.normal() > 0.5)
        rows.append((100000 + i, float(a), float(b), c, y))
    df = spark.createDataFrame(rows, "customer_id bigint, a double, b double, region string, applied_cc int")
    indexer = StringIndexer(inputCol="region", outputCol="region__idx", handleInvalid="keep").fit(df)
    assembler = VectorAssembler(inputCols=["a", "b", "region__idx"], outputCol="features")
    table = assembler.transform(indexer.transform(df))
    trees = GBTClassifier(labelCol="applied_cc", maxIter=3, maxDepth=2, seed=1).fit(table)
    return df, PipelineModel(stages=[indexer, assembler, trees])


def test_tree_contributions_match_definition(spark, tiny_model):
    df, model = tiny_model
    leaves = read_leaves(spark, model)
    sample = df.orderBy("customer_id").limit(20)
    explained = add_tree_contributions(sample, model, ["a", "b", "region"]).orderBy("customer_id").collect()
    vectors = [
        r[0]
        for r in model.transform(sample).orderBy("customer_id").select(vector_to_array("features")).collect()
    ]
    for row, vector in zip(explained, vectors):
        expected = sum(brute_shapley(leaf, np.array(vector), 3) for leaf in leaves)
        assert [row.shap__a, row.shap__b, row.shap__region] == pytest.approx(list(expected), abs=1e-12)


def test_tree_contributions_add_up(tiny_model):
    df, model = tiny_model
    explained = add_tree_contributions(add_probability(model, df), model, ["a", "b", "region"])
    odds = F.col("exp_expected_value") + F.col("shap__a") + F.col("shap__b") + F.col("shap__region")
    worst = explained.select(F.max(F.abs(1 / (1 + F.exp(-odds)) - F.col("p_apply")))).first()[0]
    assert worst < 1e-12


def test_expected_value_is_the_training_mean(spark, tiny_model):
    df, model = tiny_model
    mean = model.transform(df).select(F.avg(2 * vector_to_array("rawPrediction")[1])).first()[0]
    assert sum(map(expected_value, read_leaves(spark, model))) == pytest.approx(mean, abs=1e-9)


def test_single_leaf_trees(spark):
    """One class only: every tree is a single leaf, nothing contributes."""
    rows = [(i, float(i), 1) for i in range(10)]
    df = spark.createDataFrame(rows, "customer_id bigint, a double, applied_cc int")
    assembler = VectorAssembler(inputCols=["a"], outputCol="features")
    trees = GBTClassifier(labelCol="applied_cc", maxIter=1, maxDepth=2).fit(assembler.transform(df))
    explained = add_tree_contributions(df, PipelineModel(stages=[assembler, trees]), ["a"])
    assert {r["shap__a"] for r in explained.collect()} == {0.0}


def linear(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 10.0), (2, 3.0, 10.0), (3, 5.0, 40.0)], "customer_id bigint, a double, b double"
    )
    weights = {"a": (2.0, 1.0), "b": (-0.1, 0.0)}
    return df, weights, explain.linear_contributions(df, df, weights)


def test_linear_contributions(spark):
    _, _, explained = linear(spark)
    rows = {r.customer_id: r for r in explained.collect()}
    assert [rows[i].shap__a for i in (1, 2, 3)] == pytest.approx([-4.0, 0.0, 4.0])
    assert [rows[i].shap__b for i in (1, 2, 3)] == pytest.approx([1.0, 1.0, -2.0])
    assert rows[1].exp_expected_value == pytest.approx(2.0 * (3.0 - 1.0) - 0.1 * 20.0)


def test_top_contributions_order_ties_and_missing_ranks(spark):
    _, _, explained = linear(spark)
    rows = {r.customer_id: r for r in explain.top_contributions(explained, ["a", "b"], 3).collect()}
    assert (rows[1].exp_1_feature, rows[1].exp_2_feature, rows[1].exp_3_feature) == ("a", "b", None)
    assert (rows[2].exp_1_feature, rows[2].exp_1_value) == ("b", "10.0")
    tied = spark.createDataFrame([(1, 5.0, 5.0, 0.3, -0.3)], "customer_id bigint, a double, b double, shap__a double, shap__b double")
    row = explain.top_contributions(tied, ["a", "b"], 2).first()
    assert (row.exp_1_feature, row.exp_2_contribution) == ("a", -0.3)


def test_mean_abs(spark):
    _, _, explained = linear(spark)
    rows = [tuple(r) for r in explain.mean_abs_contributions(explained, ["a", "b"]).collect()]
    assert rows == [("a", pytest.approx(8 / 3)), ("b", pytest.approx(4 / 3))]


def test_static_explanations_are_typed(spark):
    df = spark.createDataFrame([(1, 7)], "customer_id bigint, a int")
    out = explain.static_explanations(df, ["a", "gone"], 2)
    assert dict(out.dtypes)["exp_2_value"] == "string" and dict(out.dtypes)["exp_1_contribution"] == "double"
    row = out.first()
    assert (row.exp_1_feature, row.exp_1_value, row.exp_1_contribution, row.exp_2_feature) == ("a", "7", None, None)


def test_column_names():
    assert contribution_column("annual_income") == "shap__annual_income"
    assert contribution_column(" a--b  c_") == "shap__a_b_c"


def test_lead_columns():
    have = ["decile", "p_apply", "email", "customer_id", "applied_cc", "auc_on_test", "b", "a", "shap__a",
            "exp_2_value", "exp_1_feature", "exp_10_feature", "exp_expected_value"]
    assert lead_columns(have, ["a", "b", "gone"]) == [
        "customer_id", "email", "a", "b", "shap__a", "p_apply", "decile", "exp_expected_value",
        "exp_1_feature", "exp_2_value", "exp_10_feature",
    ]


def test_name_clash_gets_a_suffix(spark):
    df = spark.createDataFrame([(1, 2.0, 9.0), (2, 4.0, 9.0)], "customer_id bigint, a double, shap__a double")
    out = explain.linear_contributions(df, df, {"a": (1.0, 0.0)})
    assert "shap__a_contribution" in out.columns
    row = explain.top_contributions(out, ["a"], 1).orderBy("customer_id").first()
    assert (row.exp_1_feature, row.exp_1_contribution, row.shap__a) == ("a", -1.0, 9.0)
    assert explain.mean_abs_contributions(out, ["a"]).first()["mean_abs_shap"] == 1.0


def test_features_with_one_safe_name_keep_a_column_each(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 3.0, 50.0)], "customer_id bigint, `a-b` double, a_b double")
    out = explain.linear_contributions(df, df, {"a-b": (1.0, 0.0), "a_b": (1.0, 0.0)})
    columns = explain.contribution_map(out, ["a-b", "a_b"])
    assert len(set(columns.values())) == 2
    row = explain.top_contributions(out, ["a-b", "a_b"], 2).orderBy("customer_id").first()
    assert (row.exp_1_feature, row.exp_1_contribution, row.exp_2_feature, row.exp_2_contribution) == ("a_b", -20.0, "a-b", -1.0)
    means = {r.feature: r.mean_abs_shap for r in explain.mean_abs_contributions(out, ["a-b", "a_b"]).collect()}
    assert means == {"a-b": 1.0, "a_b": 20.0}


def test_many_leaves_are_prepared_once():
    """5120 leaves: once prepared, a batch of ten rows takes a fraction of the time."""
    import time

    from leadlift.functions.shapley import LeafTables

    rng = np.random.default_rng(1)
    leaves = []
    for _ in range(5120):
        path = {}
        for j in rng.choice(13, size=6, replace=False):
            low, high = sorted(rng.normal(size=2))
            path[int(j)] = (low, high, None, float(rng.uniform(0.1, 0.9)))
        leaves.append((float(rng.normal()), path))
    tables, x = LeafTables(leaves), rng.normal(size=(10, 13))
    taken = []
    for _ in range(3):
        start = time.perf_counter()
        tables.contributions(x)
        taken.append(time.perf_counter() - start)
    assert min(taken) < 0.1
