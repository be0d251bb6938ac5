"""The three end-to-end runs: ``baseline``, ``train`` and ``full``.

Each takes a customer table and returns its results by name. Tables that several steps read are staged; the rest stay
lazy until the caller writes or shows them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from leadlift.operators import metrics, ranking
from leadlift.operators.boosting import fit_boosted, tune_boosted
from leadlift.operators.columns import feature_columns, restrict_features, trial_columns
from leadlift.operators.explain import mean_abs_contributions, top_contributions
from leadlift.operators.exports import export_leads, export_metrics, lead_export
from leadlift.operators.labels import add_label
from leadlift.operators.models import (
    add_probability,
    feature_importance,
    fit_baseline,
    score_part,
    top_features,
    with_auc,
)
from leadlift.operators.splits import SPLIT, add_three_way_split, part, with_draw
from leadlift.operators.tree_contributions import add_tree_contributions
from leadlift.settings import (
    BASELINE_LABEL,
    BOOST_SPACE,
    EXPLAIN_TOP_N,
    F1_GRID_POINTS,
    FINAL_LABEL,
    LABEL,
    MIN_LEAD_DECILE,
    REPORT_THRESHOLDS,
    SCORE,
    SEED,
    TEST_SHARE,
    TOP_K,
    TUNE_TRIALS,
    VALID_SHARE,
)
from leadlift.sources.model_store import save_model
from leadlift.sources.staging import scope, stage

Results = dict[str, Any]


def prepare(
    customers: DataFrame, test_share: float = TEST_SHARE, valid_share: float = VALID_SHARE, label: str = LABEL
) -> DataFrame:
    """Labelled customers with their ``split``, staged by split part: a fit reads only the files of its part."""
    labelled = customers if label in customers.columns else add_label(customers)
    with scope(customers.sparkSession):
        labelled = stage(with_draw(with_draw(labelled, "split"), "valid"), "labelled")
        split = add_three_way_split(labelled, test_share, valid_share, label)
        return stage(split, "prepared", partition_by=[SPLIT], keep=True)


def baseline_flow(
    customers: DataFrame,
    thresholds: Sequence[float] = tuple(REPORT_THRESHOLDS),
    grid_points: int = F1_GRID_POINTS,
    prefix: str = BASELINE_LABEL,
    prepared: DataFrame | None = None,
) -> Results:
    """Scaled logistic regression on train, reported on valid."""
    data = prepare(customers) if prepared is None else prepared
    features = [c for c in feature_columns(data) if c != SPLIT]
    model = fit_baseline(data, features)
    scored = stage(add_probability(model, part(data, "valid")).select(LABEL, SCORE), "baseline")
    return {
        "prepared": data,
        "features": features,
        "baseline_model": model,
        "baseline_scores": scored,
        "baseline_metrics": metrics.metrics_report(scored, prefix, thresholds, grid_points),
    }


def train_flow(
    customers: DataFrame,
    tree_params: Mapping | None = None,
    top_k: int = TOP_K,
    trials: int = TUNE_TRIALS,
    seed: int = SEED,
    space: Mapping[str, tuple] = BOOST_SPACE,
    **baseline_args,
) -> Results:
    """The baseline, then boosted trees on all features, the top k features, and a random search on those."""
    out = baseline_flow(customers, **baseline_args)
    data, features = out["prepared"], out["features"]
    model_all = fit_boosted(data, features, tree_params, seed=seed)
    importance = feature_importance(model_all, data, features)
    selected = top_features(importance, top_k)
    # the split column travels along: the same rows train and validate as before
    narrow = restrict_features(data, selected, keep=(LABEL, SPLIT))
    tuned = tune_boosted(narrow, selected, trials, seed, space)
    return {
        **out,
        "model_all": model_all,
        "feature_importance": importance,
        "selected_features": selected,
        "restricted": narrow,
        "model": tuned.model,
        "best_params": tuned.params,
        "best_valid_auc": tuned.valid_auc,
        "tuning_trials": tuned.trials,
        "fitted_trials": tuned.fitted,
    }


def full_flow(
    customers: DataFrame,
    min_decile: int = MIN_LEAD_DECILE,
    explain_top_n: int = EXPLAIN_TOP_N,
    thresholds: Sequence[float] = tuple(REPORT_THRESHOLDS),
    grid_points: int = F1_GRID_POINTS,
    final_prefix: str = FINAL_LABEL,
    model_path: str | None = None,
    leads_path: str | None = None,
    metrics_path: str | None = None,
    **train_args,
) -> Results:
    """Training, then test scores, reports, deciles, the lift table and explained leads; files where a path is given."""
    out = train_flow(customers, thresholds=thresholds, grid_points=grid_points, **train_args)
    model, selected = out["model"], out["selected_features"]
    scored = score_part(model, out["restricted"], selected)
    final = metrics.metrics_report(scored, final_prefix, thresholds, grid_points)
    performance = stage(metrics.concat_reports(out["baseline_metrics"], final), "performance")
    with_deciles = ranking.add_deciles(with_auc(scored, metrics.roc_auc(scored).first()[0]))
    # one pass of the trees over the test rows serves both the leads and the overall importance
    explained = stage(add_tree_contributions(with_deciles, model, selected), "explained")
    lead_rows = top_contributions(ranking.leads(explained, min_decile), selected, explain_top_n)
    results = {
        **out,
        "scored_test": with_deciles.drop(ranking.DECILE),
        "scored_test_with_deciles": with_deciles,
        "decile_table": ranking.decile_table(with_deciles),
        "leads": ranking.leads(with_deciles, min_decile),
        "explained": explained,
        "leads_explained": lead_rows,
        "leads_export": lead_export(lead_rows, selected),
        "mean_abs_contributions": mean_abs_contributions(explained, selected),
        "final_metrics": final,
        "performance_metrics": performance,
    }
    if model_path:
        results["model_path"] = save_model(model, model_path)
    if leads_path:
        results["leads_path"] = export_leads(lead_rows, selected, leads_path)
    if metrics_path:
        results["metrics_path"] = export_metrics(performance, metrics_path)
    return results


def report_heads(results: Results, trials: int = 5, importance: int = 12, leads: int = 10) -> dict[str, DataFrame]:
    """The short excerpts a reader looks at first."""
    heads = {}
    if "tuning_trials" in results:
        table = results["tuning_trials"]
        heads["tuning_trials"] = table.select(*trial_columns(table)).limit(trials)
    if "feature_importance" in results:
        heads["feature_importance"] = results["feature_importance"].limit(importance)
    if "leads" in results:
        heads["leads"] = results["leads"].limit(leads)
    return heads
