"""Fitted models: invariants, not numbers of another library."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlift.operators import metrics, models, ranking
from leadlift.operators.explain import contribution_map
from leadlift.operators.splits import SPLIT, part
from leadlift.operators.tree_contributions import add_tree_contributions
from leadlift.plans import flows
from leadlift.settings import FEATURES, KEY, LABEL, SCORE, TUNE_SPACE
from leadlift.sources.customers import load_customers
from leadlift.sources.model_store import load_model, save_model
from leadlift.sources.staging import stage
from leadlift.sources.tables import read_csv

QUICK = {"maxIter": (3, 6), "maxDepth": (2, 4), "stepSize": (0.05, 0.2), "subsamplingRate": (0.7, 1.0), "maxBins": (16, 64)}


def auc(model, df):
    return metrics.roc_auc(stage(models.add_probability(model, df).select(LABEL, SCORE))).first()[0]


@pytest.fixture(scope="module")
def baseline(prepared):
    return models.fit_baseline(prepared, FEATURES)


def test_baseline_beats_chance(prepared, baseline):
    assert auc(baseline, part(prepared, "valid")) > 0.7


def test_baseline_minimises_the_penalised_loss(prepared, baseline):
    """The gradient of sum(log loss) + |w|^2 / 2 vanishes at the fitted weights."""
    rows = baseline.transform(part(prepared, "train")).select("features", LABEL).collect()
    x = np.array([r[0].toArray() for r in rows])
    y = np.array([r[1] for r in rows])
    fitted = baseline.stages[-1]
    w, b = fitted.coefficients.toArray(), fitted.intercept
    residual = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(x.T @ residual + w).max() / len(y) < 1e-3
    assert abs(residual.sum()) / len(y) < 1e-3


def test_reloaded_model_scores_the_same(spark, prepared, baseline, trees, tmp_path):
    for name, model in (("lr", baseline), ("trees", trees)):
        loaded = load_model(save_model(model, str(tmp_path / name)))
        before = {r[0]: r[1] for r in models.add_probability(model, part(prepared, "test")).select(KEY, SCORE).collect()}
        after = {r[0]: r[1] for r in models.add_probability(loaded, part(prepared, "test")).select(KEY, SCORE).collect()}
        assert before == after


def test_trees(prepared, trees):
    assert auc(trees, part(prepared, "valid")) > 0.6
    importance = models.feature_importance(trees, prepared, FEATURES)
    assert importance.select(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert [r.feature for r in importance.collect()][0] == "credit_score"
    assert models.top_features(importance, 3) == [r.feature for r in importance.limit(3).collect()]
    percent = models.feature_importance(trees, prepared, FEATURES, scale=100.0)
    assert percent.select(F.sum("importance")).first()[0] == pytest.approx(100.0)


def test_early_stop_keeps_the_best_prefix(spark, prepared, tmp_path):
    eager = {"maxIter": 12, "maxDepth": 5, "stepSize": 1.0, "subsamplingRate": 1.0}
    stopped = models.fit_trees(prepared, FEATURES, eager)
    whole = models.fit_trees(prepared, FEATURES, eager, early_stop=False)
    kept = stopped.stages[-1].getNumTrees
    assert 1 <= kept < 12 == whole.stages[-1].getNumTrees
    valid = whole.transform(models.normalise_categories(part(prepared, "valid"))).select("features", LABEL)
    losses = whole.stages[-1].evaluateEachIteration(valid)
    assert losses[kept - 1] == min(losses)
    assert stopped.stages[-1].treeWeights == whole.stages[-1].treeWeights[:kept]
    loaded = load_model(save_model(stopped, str(tmp_path / "prefix")))
    assert loaded.stages[-1].getNumTrees == kept
    assert auc(loaded, part(prepared, "test")) == auc(stopped, part(prepared, "test"))


def test_patience():
    losses = [0.9, 0.8, 0.85, 0.84, 0.7, 0.71, 0.72, 0.73, 0.6]
    assert models.rounds_to_keep(losses, 1) == 2
    assert models.rounds_to_keep(losses, 3) == 5
    assert models.rounds_to_keep(losses, 40) == 9


def test_tree_parameters_are_known_and_used(prepared):
    with pytest.raises(ValueError):
        models.fit_trees(prepared, FEATURES, {"max_depth": 3})
    large = models.fit_trees(prepared, FEATURES, {"maxIter": 1, "minInstancesPerNode": 700}, early_stop=False)
    assert large.stages[-1].totalNumNodes == 1


def test_missing_numbers_and_many_categories(spark, prepared):
    """A table with NULL and NaN numerics and 100 regions can be fitted, scored and explained."""
    hole = F.pmod(F.xxhash64(KEY), F.lit(4))
    holed = prepared.withColumn("credit_score", F.when(hole == 1, None).when(hole == 2, float("nan")).otherwise(F.col("credit_score")))
    holed = holed.withColumn("age", F.when(hole == 3, None).otherwise(F.col("age")))
    holed = stage(holed.withColumn("region", F.concat(F.lit("r"), F.pmod(F.xxhash64(KEY, F.lit(1)), F.lit(100)).cast("string"))))
    features = ["credit_score", "age", "utilization_rate", "region"]
    baseline = models.fit_baseline(holed, features)
    model = models.fit_trees(holed, features, {"maxIter": 3, "maxDepth": 3, "maxBins": 16})
    test = part(holed, "test")
    for fitted in (baseline, model):
        assert models.add_probability(fitted, test).where("p_apply between 0 and 1").count() == test.count()
    explained = add_tree_contributions(models.add_probability(model, test), model, features)
    odds = F.col("exp_expected_value") + sum(F.col(c) for c in contribution_map(explained, features).values())
    assert explained.select(F.max(F.abs(1 / (1 + F.exp(-odds)) - F.col(SCORE)))).first()[0] < 1e-12


def test_unseen_category_is_scored(prepared, baseline, trees):
    odd = part(prepared, "test").limit(5).withColumn("region", F.lit("atlantis")).withColumn("channel", F.lit(None).cast("string"))
    for model in (baseline, trees):
        assert models.add_probability(model, odd).where("p_apply between 0 and 1").count() == 5


def test_draws_are_seeded_and_in_range():
    draws = models.draw_params(40, seed=7)
    assert draws == models.draw_params(40, seed=7) != models.draw_params(40, seed=8)
    for params in draws:
        for name, (low, high) in TUNE_SPACE.items():
            assert low <= params[name] < high
            assert isinstance(params[name], int) == isinstance(low, int)


def test_tuning(prepared):
    tuned = models.tune_trees(prepared, FEATURES, 2, space=QUICK)
    rows = tuned.trials.collect()
    assert [r.valid_auc for r in rows] == sorted((r.valid_auc for r in rows), reverse=True)
    assert tuned.valid_auc == rows[0].valid_auc == pytest.approx(auc(tuned.model, part(prepared, "valid")))
    assert {f"param_{k}" for k in QUICK} < set(tuned.trials.columns)


def test_first_best_trial_wins(spark):
    trials = spark.createDataFrame([(1, None), (2, 0.7), (3, 0.7)], "trial int, valid_auc double")
    assert models.best_trial(trials).first()["trial"] == 2


def test_scored_test(prepared, baseline):
    scored = models.with_auc(models.score_part(baseline, prepared, ["age", "gone"]))
    assert scored.columns == ["customer_id", "email", "phone", LABEL, "age", SCORE, "auc_on_test"]
    assert scored.count() == part(prepared, "test").count()
    assert scored.select("auc_on_test").distinct().count() == 1


def test_full_flow(spark, medium, tmp_path):
    out = flows.full_flow(
        load_customers(spark, medium),
        tree_params={"maxIter": 4, "maxDepth": 3},
        trials=1,
        space=QUICK,
        top_k=5,
        model_path=str(tmp_path / "model"),
        leads_path=str(tmp_path / "leads"),
        metrics_path=str(tmp_path / "metrics"),
    )
    assert len(out["selected_features"]) == 5
    assert out["performance_metrics"].count() == 8
    assert {r["label"] for r in out["performance_metrics"].collect()} >= {"baseline_valid@0.3", "final_test_best_f1"}
    assert [r.decile for r in out["decile_table"].collect()] == list(range(10, 0, -1))
    leads = out["leads_explained"].collect()
    assert [r.p_apply for r in leads] == sorted((r.p_apply for r in leads), reverse=True)
    assert {r.decile for r in leads} == {9, 10}
    export = out["leads_export"]
    assert LABEL not in export.columns and "auc_on_test" not in export.columns
    written = read_csv(spark, out["leads_path"], export.schema)
    assert written.count() == len(leads) and written.columns == export.columns
    assert read_csv(spark, out["metrics_path"], out["performance_metrics"].schema).count() == 8
    heads = flows.report_heads(out)
    assert heads["leads"].count() == 10 and heads["tuning_trials"].count() == 1
    parts = out["prepared"].groupBy(SPLIT).count().collect()
    assert {r[0]: r[1] for r in parts} == {"test": 375, "valid": 225, "train": 900}
    assert ranking.decile_table(out["scored_test_with_deciles"]).select(F.sum("customers")).first()[0] == 375
