"""Histogram boosting against plain computations, and what its trees may depend on."""

import math
import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from leadlift.functions.trees import CATEGORY, NUMBER, BoostedTrees, Feature, Tree, bin_rows
from leadlift.operators import boosting, models
from leadlift.operators.boosting import UNIT, Layout, best_splits, boost_params, exact_aucs, fit_boosted, fit_many, number_bounds
from leadlift.operators.explain import EXPECTED, contribution_map
from leadlift.operators.metrics import roc_auc
from leadlift.operators.splits import part
from leadlift.operators.tree_contributions import add_tree_contributions
from leadlift.settings import FEATURES, KEY, LABEL, SCORE
from leadlift.sources.model_store import load_model, save_model
from leadlift.sources.staging import stage

PLAIN = {"maxIter": 4, "maxDepth": 3, "subsamplingRate": 1.0, "randomStrength": 0.0}


def plain_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return float(((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg)))


def plain_best(sums, feature, l2, least):
    """Largest gain over all cuts of one feature, by trying every one on both sides of the missing bin."""
    total = sums.sum(axis=0)
    term = lambda s: s[0] ** 2 / (s[1] + l2)
    order = list(range(1, len(sums)))
    if feature.kind == CATEGORY:
        order.sort(key=lambda b: sums[b][0] / (sums[b][1] + l2))
    best = -math.inf
    for cut in range(1, len(order) + 1):
        for missing in ((), (0,)):
            left = sums[[*missing, *order[:cut]]].sum(axis=0)
            right = total - left
            if left[2] >= least and right[2] >= least:
                best = max(best, term(left) + term(right) - term(total))
    return best


def test_best_split_tries_every_cut():
    draw = np.random.default_rng(4)
    features = [Feature("a", NUMBER, (1.0, 2.0, 3.0)), Feature("b", CATEGORY, categories=tuple("pqrst")), Feature("c", NUMBER)]
    layout = Layout.of(features)
    for least in (1, 6):
        params = boost_params({"l2": 2.0, "minInstancesPerNode": least, "randomStrength": 0.0})
        sums = np.zeros((30, layout.cells, 3), np.int64)
        for node in sums:
            for i in range(40):
                g, h = int(draw.normal() * UNIT), int(0.2 * UNIT)
                for f, feature in enumerate(features):
                    node[layout.offsets[f] + draw.integers(feature.bins)] += (g, h, 1)
        for node, found in zip(sums, best_splits(sums, features, layout, params, None)):
            unit = node / np.array([UNIT, UNIT, 1.0])
            every = [unit[o : o + f.bins] for o, f in zip(layout.offsets, features)]
            wanted = max(plain_best(s, f, 2.0, least) for s, f in zip(every, features))
            if found is None:
                assert wanted < 1e-9
                continue
            f, left = found
            total, lefts = every[f].sum(axis=0), every[f][left].sum(axis=0)
            rights = total - lefts
            gain = sum(s[0] ** 2 / (s[1] + 2.0) for s in (lefts, rights)) - total[0] ** 2 / (total[1] + 2.0)
            assert gain == pytest.approx(wanted) and min(lefts[2], rights[2]) >= least


def test_bounds_and_bins():
    assert number_bounds(np.array([3.0, 1.0, np.nan, 1.0]), 8) == (2.0,)
    bounds = number_bounds(np.arange(1000.0), 4)
    assert bounds == (250.0, 500.0, 750.0)
    number = Feature("x", NUMBER, bounds)
    assert number.binned([0, 250.0, 251, 999, 5000, math.nan, None]).tolist() == [1, 1, 2, 4, 4, 0, 0]
    assert Feature("c", CATEGORY, categories=("u", "v")).binned(["v", "w", None, "u"]).tolist() == [2, 0, 0, 1]
    assert number_bounds(np.array([np.nan, 2.0, 2.0]), 8) == ()


@pytest.fixture(scope="module")
def fitted(prepared):
    return fit_many(prepared, FEATURES, [PLAIN, {**PLAIN, "maxDepth": 2, "l2": 9.0, "subsamplingRate": 0.7}])


def test_leaves_are_newton_steps(prepared, fitted):
    """Every leaf of every tree, from the rows that reach it."""
    found = fitted[0]
    train = part(prepared, "train").toPandas()
    bins, y = bin_rows(found.model.features, train), train[LABEL].to_numpy()
    margins = np.full(len(y), found.model.bias)
    for tree in found.grown:
        p = 1 / (1 + np.exp(-margins))
        at = tree.nodes_of(bins)
        for leaf in np.unique(at):
            rows = at == leaf
            step = -0.1 * (p - y)[rows].sum() / ((p * (1 - p))[rows].sum() + 3.0)
            assert tree.value[leaf] == pytest.approx(step, abs=1e-6) and tree.rows[leaf] == rows.sum()
        margins += tree.margins(bins)


def test_same_trees_however_partitioned_or_accompanied(prepared, fitted):
    again = fit_many(prepared.repartition(7, "age"), FEATURES, [PLAIN])
    assert BoostedTrees(fitted[0].model.features, 0.0, fitted[0].grown).to_json() == BoostedTrees(
        again[0].model.features, 0.0, again[0].grown
    ).to_json()
    alone = fit_many(prepared, FEATURES, [{**PLAIN, "maxDepth": 2, "l2": 9.0, "subsamplingRate": 0.7}])
    assert [t.value for t in alone[0].grown] == [t.value for t in fitted[1].grown]
    noisy = [fit_boosted(prepared, FEATURES, {**PLAIN, "randomStrength": 2.0}).to_json() for _ in range(2)]
    assert noisy[0] == noisy[1] != fitted[0].model.to_json()


def test_histograms_stay_off_the_driver(prepared, monkeypatch):
    """What reaches the driver is splits: no histogram, and no more of it from more partitions."""
    got, collect = [], RDD.collect

    def counted(rdd):
        found = collect(rdd)
        got.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", counted)
    sizes = []
    for rows in (4_096, 100):
        monkeypatch.setattr(boosting, "PARTITION_ROWS", rows)
        got.clear()
        fit_many(prepared, FEATURES, [PLAIN, {**PLAIN, "maxDepth": 2}])
        sizes.append(sum(got))
    assert max(got) < 8 * boosting.CELLS and sizes[0] == sizes[1] < 50_000


def test_sums_are_merged_in_steps(prepared, fitted, monkeypatch):
    monkeypatch.setattr(boosting, "TREE_MERGE", 1)
    monkeypatch.setattr(boosting, "PARTITION_ROWS", 150)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    assert fit_many(prepared, FEATURES, [PLAIN])[0].model.to_json() == fitted[0].model.to_json()


def test_kept_prefix_has_the_best_auc(prepared):
    params = {"maxIter": 30, "maxDepth": 4, "stepSize": 0.8, "patience": 4, "subsamplingRate": 1.0}
    found = fit_many(prepared, FEATURES, [params])[0]
    valid = part(prepared, "valid").toPandas()
    bins, y = bin_rows(found.model.features, valid), valid[LABEL].to_numpy()
    margins, aucs, cells = np.full(len(y), found.model.bias), [], []
    for tree in found.grown:
        margins = margins + tree.margins(bins)
        aucs.append(plain_auc(y, margins))
        cells.append(plain_auc(y, boosting.margin_cell(margins)))
    kept = len(found.model.trees)
    assert kept == aucs.index(max(aucs)) + 1 and found.valid_auc == pytest.approx(max(aucs))
    # growth stops by the AUC over cells of margins
    assert len(found.grown) == min(30, cells.index(max(cells)) + 1 + 4) < 30
    scored = stage(models.add_probability(found.model, part(prepared, "valid")).select(LABEL, SCORE))
    assert roc_auc(scored).first()[0] == pytest.approx(found.valid_auc)


def test_exact_aucs_of_shared_cells(spark, prepared, fitted):
    """Leaves so small that all margins fall into one cell."""
    model = fitted[0].model
    tiny = [Tree(t.feature, t.left, t.children, [v * 1e-5 for v in t.value], t.rows) for t in fitted[0].grown]
    small = BoostedTrees(model.features, model.bias, tiny)
    bins = boosting.binned_blocks(prepared, model.features, LABEL, KEY)
    found = exact_aucs(bins, {0: small}, {0: [1, 3]})
    valid = part(prepared, "valid").toPandas()
    rows, y = bin_rows(model.features, valid), valid[LABEL].to_numpy()
    for k in (1, 3):
        margins = BoostedTrees(model.features, model.bias, tiny[:k]).margins(rows)
        assert len(np.unique(boosting.margin_cell(margins))) <= 2
        assert found[0, k] == pytest.approx(plain_auc(y, margins))


def test_missing_values_have_their_own_way(spark, prepared):
    """The label says only whether a number is missing."""
    hole = F.pmod(F.xxhash64(KEY), F.lit(5)) < 2
    holed = prepared.withColumn("age", F.when(hole, F.lit(None)).otherwise(F.col("age")))
    holed = stage(holed.withColumn(LABEL, hole.cast("int")))
    model = fit_boosted(holed, ["age", "tenure_months", "region"], {"maxIter": 5, "maxDepth": 2})
    test = models.add_probability(model, part(holed, "test"))
    assert roc_auc(stage(test.select(LABEL, SCORE))).first()[0] > 0.95
    odd = part(holed, "test").limit(40).withColumn("region", F.lit("atlantis")).withColumn("tenure_months", F.lit(float("nan")))
    for rows in (test, models.add_probability(model, odd)):
        explained = add_tree_contributions(rows, model, ["tenure_months", "age", "region"])
        names = contribution_map(explained, ["tenure_months", "age", "region"])
        odds = F.col(EXPECTED) + sum(F.col(c) for c in names.values())
        assert explained.select(F.max(F.abs(1 / (1 + F.exp(-odds)) - F.col(SCORE)))).first()[0] < 1e-12


def test_importance_of_a_hand_made_tree():
    tree = Tree()
    a, b = tree.split(0, 0, [1])
    c, d = tree.split(b, 1, [2])
    for node, value, rows in ((a, 1.0, 6), (c, -1.0, 1), (d, 2.0, 3)):
        tree.value[node], tree.rows[node] = value, rows
    tree.rows[0], tree.rows[b] = 10, 4
    model = BoostedTrees([Feature("x", NUMBER, (0.0,)), Feature("y", NUMBER, (0.0,))], 0.0, [tree])
    right = (1 * -1.0 + 3 * 2.0) / 4
    mean = (6 * 1.0 + 4 * right) / 10
    x = 6 * (1.0 - mean) ** 2 + 4 * (right - mean) ** 2
    y = 1 * (-1.0 - right) ** 2 + 3 * (2.0 - right) ** 2
    assert model.prediction_change().tolist() == pytest.approx([100 * x / (x + y), 100 * y / (x + y)])
    assert BoostedTrees(model.features, 0.0, [Tree()]).prediction_change().tolist() == [0.0, 0.0]


def test_importance_scores_and_reload(spark, prepared, fitted, tmp_path):
    model = fitted[0].model
    table = models.feature_importance(model, prepared, FEATURES, scale=100.0)
    assert table.select(F.sum("importance")).first()[0] == pytest.approx(100.0)
    assert table.first()["feature"] == "credit_score"
    loaded = load_model(save_model(model, str(tmp_path / "trees")))
    assert loaded == model
    test = part(prepared, "test").withColumn(SCORE, F.lit("clash"))
    both = models.add_probability(loaded, test)
    assert both.where("p_apply between 0 and 1").count() == test.count() and both.columns == test.columns


def test_nothing_to_compare(spark, prepared):
    """One class, no valid rows, no rows at all."""
    one = fit_many(prepared.withColumn(LABEL, F.lit(1)), ["age"], [PLAIN])[0]
    assert one.model.trees == [] and one.valid_auc is None and one.model.bias > 3
    rest = prepared.where("split <> 'valid'")
    whole = fit_many(rest, ["age"], [PLAIN])[0]
    assert len(whole.model.trees) == 4 and whole.valid_auc is None
    empty = fit_many(prepared.limit(0), ["age", "region"], [PLAIN])[0]
    assert empty.model.trees == [] and empty.model.bias == 0.0
    assert fit_many(prepared, ["age"], []) == []
    with pytest.raises(ValueError):
        boost_params({"depth": 3})


def test_tuning_grows_all_trials_together(prepared):
    space = {"maxIter": (2, 5), "maxDepth": (2, 4), "l2": (1.0, 5.0)}
    tuned = boosting.tune_boosted(prepared, FEATURES, 3, space=space)
    rows = tuned.trials.collect()
    assert [r.valid_auc for r in rows] == sorted((r.valid_auc for r in rows), reverse=True)
    assert {r.trial for r in rows} == {1, 2, 3} and tuned.valid_auc == rows[0].valid_auc
    assert tuned.fitted[rows[0].trial - 1].model is tuned.model
    assert set(tuned.params) == set(space)
