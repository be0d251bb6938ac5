"""Known totals of the customer table, label and scorecard at the middle size."""

import pytest
from pyspark.sql import functions as F

from leadlift.operators import metrics, ranking
from leadlift.operators.labels import add_label, add_score, add_scorecard_probability
from leadlift.operators.splits import add_stratified_split
from leadlift.sources.customers import load_customers
from leadlift.sources.staging import stage


@pytest.fixture(scope="module")
def scored(spark, medium):
    return stage(add_scorecard_probability(add_score(add_label(load_customers(spark, medium)))))


def test_averages(scored):
    row = scored.agg(
        F.count("*"), F.sum("applied_cc"), F.avg("score"), F.avg("age"), F.avg("tenure_months"),
        F.avg("avg_txn_amount_3m"), F.avg("savings_balance"),
    ).first()
    assert row[:2] == (1500, 732)
    assert row[2:] == pytest.approx((-0.05568890, 47.106, 71.504667, 80.768107, 4536.854), rel=1e-7)


def test_split_sizes(scored):
    rows = add_stratified_split(scored).groupBy("split", "applied_cc").count().collect()
    assert {(r[0], r[1]): r[2] for r in rows} == {
        ("test", 0): 192, ("test", 1): 183, ("train", 0): 576, ("train", 1): 549,
    }


def test_report(scored):
    rows = {r["label"]: r for r in metrics.metrics_report(scored, "all").collect()}
    assert (rows["all@0.5"].tp, rows["all@0.5"].fp, rows["all@0.5"].tn, rows["all@0.5"].fn) == (502, 216, 552, 230)
    best = rows["all_best_f1"]
    assert (best.threshold, best.tp, best.fp, best.fn) == (0.27, 655, 454, 77)
    assert (best.auc_roc, best.auc_pr, best.log_loss, best.f1) == pytest.approx(
        (0.76309910, 0.75348535, 0.58276237, 0.71156980), abs=1e-8
    )


def test_lift(scored):
    table = {r["decile"]: r for r in ranking.decile_table(ranking.add_deciles(scored)).collect()}
    assert (table[10].customers, table[10].responders) == (150, 134)
    assert (table[10].avg_score, table[10].lift_vs_avg) == pytest.approx((0.919648, 1.830601), abs=1e-6)
    assert (table[1].customers, table[1].responders) == (150, 17)


def test_scope_deletes_what_was_staged_inside(spark):
    import os

    from leadlift.sources.staging import scope, stage

    def path_of(df):
        return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]

    outside = stage(spark.range(3))
    with scope(spark):
        inside, kept = stage(spark.range(4)), stage(spark.range(5), keep=True)
        with scope(spark):
            nested = path_of(stage(spark.range(6)))
        assert not os.path.exists(nested)
        gone = path_of(inside)
    assert not os.path.exists(gone)
    assert outside.count() == 3 and kept.count() == 5


def test_folders_of_one_machine_are_refused_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from leadlift.sources.staging import shared_folder

    def session(master, folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda *_: folder),
            sparkContext=SimpleNamespace(master=master, applicationId="app"),
        )

    assert shared_folder(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert shared_folder(session("local[2]", "file:///x")) == "file:///x"
    for folder in ("file:///x", None):
        with pytest.raises(ValueError):
            shared_folder(session("yarn", folder))
