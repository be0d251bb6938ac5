"""Metrics against brute force on small tables, and against the published rows of a finished run."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leadlift.operators import metrics
from leadlift.operators.columns import require_scored

# Published reports (n, pos_rate, accuracy, precision, recall, f1, tp, fp, tn, fn).
PUBLISHED = [
    (900, 0.5944444444444444, 0.6655555555555556, 0.6511627906976745, 0.9420560747663551, 0.7700534759358288, 504, 270, 95, 31),
    (900, 0.5944444444444444, 0.71, 0.7353951890034365, 0.8, 0.7663384064458371, 428, 154, 211, 107),
    (900, 0.5944444444444444, 0.6577777777777778, 0.8328445747800587, 0.5308411214953271, 0.6484018264840182, 284, 57, 308, 251),
    (900, 0.5944444444444444, 0.7066666666666667, 0.7068702290076336, 0.8654205607476636, 0.7781512605042017, 463, 192, 173, 72),
    (1500, 0.5946666666666667, 0.658, 0.6415235250186706, 0.9630044843049327, 0.770058269834155, 859, 480, 128, 33),
    (1500, 0.5946666666666667, 0.7013333333333334, 0.7251521298174443, 0.8015695067264574, 0.7614483493077743, 715, 271, 337, 177),
    (1500, 0.5946666666666667, 0.624, 0.8253968253968254, 0.4663677130044843, 0.5959885386819485, 416, 88, 520, 476),
    (1500, 0.5946666666666667, 0.6973333333333334, 0.691768826619965, 0.8856502242152466, 0.7767944936086529, 790, 352, 256, 102),
]


def make(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "applied_cc int, p_apply double")


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total = sum(y for y, _ in pairs)
    if not total:
        return 0.0
    ap = before = 0.0
    for threshold in sorted({s for _, s in pairs}, reverse=True):
        tp = sum(y for y, s in pairs if s >= threshold)
        recall, precision = tp / total, tp / sum(s >= threshold for _, s in pairs)
        ap, before = ap + (recall - before) * precision, recall
    return ap


def brute_cells(pairs, threshold):
    tp = sum(y == 1 and s >= threshold for y, s in pairs)
    fp = sum(y == 0 and s >= threshold for y, s in pairs)
    return tp, fp, sum(y == 0 for y, _ in pairs) - fp, sum(y == 1 for y, _ in pairs) - tp


def brute_f1(pairs, threshold):
    tp, fp, _, fn = brute_cells(pairs, threshold)
    return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


scores = st.one_of(st.sampled_from([0.0, 0.29, 0.41, 0.5, 0.57, 0.58, 1.0]), st.floats(0, 1))
tables = st.lists(st.tuples(st.integers(0, 1), scores), min_size=1, max_size=40)
few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@given(tables, st.sampled_from([3, 100_000]))
@few
def test_curve_scores(spark, pairs, rows_per_bucket):
    row = metrics.curve_scores(metrics.score_curve(make(spark, pairs), rows_per_bucket=rows_per_bucket)).first()
    for got, expected in zip(row, (brute_auc(pairs), brute_ap(pairs))):
        assert got == (None if expected is None else pytest.approx(expected, abs=1e-12))


@given(tables)
@few
def test_sweep_and_best_f1(spark, pairs):
    df = make(spark, pairs)
    grid = np.linspace(0.0, 1.0, 101)
    rows = sorted(metrics.grid_sweep(df).collect(), key=lambda r: r["threshold"])
    assert [r["threshold"] for r in rows] == grid.tolist()
    assert [(r["tp"], r["fp"], r["tn"], r["fn"]) for r in rows] == [brute_cells(pairs, t) for t in grid]
    f1 = [brute_f1(pairs, t) for t in grid]
    assert metrics.best_f1(df).first()["threshold"] == grid[int(np.argmax(f1))]


def test_ties_count_one_half(spark):
    pairs = [(1, 0.8), (0, 0.8), (1, 0.6), (0, 0.4), (1, 0.4), (0, 0.1)]
    row = metrics.curve_scores(metrics.score_curve(make(spark, pairs))).first()
    assert row["auc_roc"] == pytest.approx(brute_auc(pairs))
    assert row["auc_pr"] == pytest.approx(brute_ap(pairs))


@pytest.mark.parametrize("y", [0, 1])
def test_single_class(spark, y):
    df = make(spark, [(y, 0.2), (y, 0.9)])
    row = metrics.metrics_table(df, [0.5], "x").first()
    assert row["auc_roc"] is None
    assert row["auc_pr"] == (1.0 if y else 0.0)
    if y == 0:
        assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_inclusive_threshold_on_grid_points(spark):
    df = make(spark, [(1, 0.29), (1, 0.41), (0, 1.0), (0, 0.5)])
    cells = {r["threshold"]: (r["tp"], r["fp"]) for r in metrics.confusion_at(df, [0.29, 0.41, 0.5, 1.0], "x").collect()}
    assert cells == {0.29: (2, 2), 0.41: (1, 2), 0.5: (0, 2), 1.0: (0, 1)}


def test_log_loss_clips(spark):
    df = make(spark, [(1, 1.0), (0, 0.0), (1, 0.0)])
    eps = metrics.LOG_LOSS_EPS
    expected = (-math.log(1 - eps) * 2 - math.log(eps)) / 3
    assert metrics.log_loss(df).first()[0] == pytest.approx(expected)


def test_rates_of_published_reports(spark):
    cells = [r[6:] for r in PUBLISHED]
    df = spark.createDataFrame(cells, "tp bigint, fp bigint, tn bigint, fn bigint")
    names = ("accuracy", "precision", "recall", "f1")
    got = {(r.tp, r.fp, r.tn, r.fn): [r[n] for n in names] for r in metrics.add_rates(df).collect()}
    for row in PUBLISHED:
        assert got[row[6:]] == pytest.approx(row[2:6], abs=1e-14)
    for n, pos_rate, *_, tp, fp, tn, fn in PUBLISHED:
        assert tp + fp + tn + fn == n and (tp + fn) / n == pytest.approx(pos_rate)


def test_labels_and_columns(spark):
    report = metrics.metrics_report(make(spark, [(1, 0.9), (0, 0.2)]), "run", [0.3, 0.5], 11)
    assert report.columns == metrics.METRIC_COLUMNS
    assert [r["label"] for r in report.collect()] == ["run@0.3", "run@0.5", "run_best_f1"]


def test_concat_skips_missing_reports(spark):
    first = spark.createDataFrame([("a", 1)], "label string, n int")
    second = spark.createDataFrame([("b", 0.5)], "label string, auc double")
    both = metrics.concat_reports(first, None, second)
    assert sorted(both.collect()) == [("a", 1, None), ("b", None, 0.5)]
    assert metrics.concat_reports(None).count() == 0


def test_required_columns(spark):
    with pytest.raises(ValueError, match="applied_cc"):
        require_scored(spark.range(1))


def test_one_repeated_score(spark):
    """A third of the rows at one score: the curve sees it as one pre-aggregated row."""
    pairs = [(i % 2, 0.5) for i in range(300)] + [(i % 3 == 0, i / 600) for i in range(600)]
    df = make(spark, pairs)
    row = metrics.curve_scores(metrics.score_curve(df, rows_per_bucket=40)).first()
    assert row["auc_roc"] == pytest.approx(brute_auc([(int(y), s) for y, s in pairs]))
    curve = metrics.score_curve(df, rows_per_bucket=40)
    assert curve.where("score = 0.5").count() == 1


def test_no_thresholds_and_no_reports_give_empty_tables(spark):
    scored = make(spark, [(0, 0.2), (1, 0.9)])
    assert metrics.metrics_table(scored, []).count() == 0
    empty = metrics.concat_reports(None, spark=spark)
    assert empty.count() == 0 and empty.columns == metrics.metrics_report(scored, "x").columns
    assert empty.dtypes == metrics.metrics_report(scored, "x").dtypes


def test_clip_keeps_missing_values(spark):
    from leadlift.functions.numeric import clip, fixed

    rows = [(None,), (float("nan"),), (-5.0,), (3.0,), (900.0,)]
    df = spark.createDataFrame(rows, "x double")
    got = [r[0] for r in df.select(clip(df.x, 1.0, 600.0)).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [1.0, 3.0, 600.0]
    shown = [r[0] for r in df.select(fixed(df.x)).collect()]
    assert shown[0] is None and math.isnan(shown[1]) and shown[2:] == [-5.0, 3.0, 900.0]
