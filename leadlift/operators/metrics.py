"""Classification metrics over a scored table (a 0/1 label and a score in [0, 1]).

Everything a metrics row needs is an aggregate: one pass counts the confusion cells of all thresholds, one pass builds
the score curve behind ROC AUC and average precision, and the best-F1 sweep is a histogram over its threshold grid.
Scalars travel as scalar subqueries, not through the driver. Pass a staged table: a full report reads it a few times.

One rule for missing values holds everywhere: a row counts if its label is 0 or 1 and its score is neither NULL nor
NaN. ``n`` is the number of rows that count, and ``left_out`` tells how many do not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlift.functions.numeric import clip, grid_step, ratio, threshold_label
from leadlift.operators.columns import require_scored
from leadlift.operators.order_stats import BUCKET, ROWS_PER_BUCKET, in_buckets, is_ranked
from leadlift.settings import F1_GRID_POINTS, LABEL, METRIC_COLUMNS, REPORT_THRESHOLDS, SCORE

LOG_LOSS_EPS = 2.220446049250313e-16
METRIC_TYPES = {"label": "string", "n": "bigint", "tp": "bigint", "fp": "bigint", "tn": "bigint", "fn": "bigint"}


def _pairs(scored: DataFrame, label: str, score: str) -> DataFrame:
    require_scored(scored, label, score)
    pairs = scored.select(F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("s"))
    return pairs.where(F.col("y").isin(0, 1) & is_ranked("s"))


def left_out(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Rows without a label or a score, which no metric counts; one row."""
    counted = F.col("_y").isin(0, 1) & is_ranked("_s")
    pairs = scored.select(F.col(label).cast("int").alias("_y"), F.col(score).cast("double").alias("_s"))
    return pairs.agg(F.count_if(~F.coalesce(counted, F.lit(False))).alias("left_out"))


def add_predictions(scored: DataFrame, threshold: float, score: str = SCORE, column: str = "y_pred") -> DataFrame:
    """1 where the score reaches the threshold, inclusive."""
    return scored.withColumn(column, (F.col(score) >= F.lit(float(threshold))).cast("int"))


# ---- score curve: ROC AUC and average precision -------------------------------------------------------------------


def score_curve(
    scored: DataFrame, label: str = LABEL, score: str = SCORE, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """One row per distinct score: positives and negatives at it, and at or above it (``tp``, ``fp``).

    Rows are first aggregated per score, so copies of one score never meet in one task. The running sums are taken in
    score ranges of bounded size, on top of exact totals of the ranges above.
    """
    pairs = _pairs(scored, label, score)
    per_score = pairs.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    tagged = in_buckets(per_score, [F.desc("s")], rows_per_bucket)
    totals = tagged.groupBy(BUCKET).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    # one row per range
    ranges = Window.partitionBy(F.lit(1)).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        BUCKET, *(F.coalesce(F.sum(c).over(ranges), F.lit(0)).alias(f"{c}_above") for c in ("_pos", "_neg"))
    )
    above = Window.partitionBy(BUCKET).orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        tagged.withColumn("tp", F.sum("pos").over(above))
        .withColumn("fp", F.sum("neg").over(above))
        .join(offsets, BUCKET)
        .select(
            F.col("s").alias("score"),
            "pos",
            "neg",
            (F.col("tp") + F.col("_pos_above")).alias("tp"),
            (F.col("fp") + F.col("_neg_above")).alias("fp"),
        )
    )


def curve_scores(curve: DataFrame) -> DataFrame:
    """ROC AUC (ties count one half) and step-wise average precision, one row.

    With a single class the AUC is NULL; without positives the precision is 0. Both are NULL without rows.
    """
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    return curve.agg(
        ratio(F.sum(neg * (tp - pos / 2)), F.sum(pos) * F.sum(neg)).alias("auc_roc"),
        ratio(F.sum(pos * tp / (tp + fp)), F.sum(pos), empty=0.0).alias("auc_pr"),
    )


def roc_auc(scored: DataFrame, label: str = LABEL, score: str = SCORE, **tuning) -> DataFrame:
    return curve_scores(score_curve(scored, label, score, **tuning)).select("auc_roc")


def average_precision(scored: DataFrame, label: str = LABEL, score: str = SCORE, **tuning) -> DataFrame:
    return curve_scores(score_curve(scored, label, score, **tuning)).select("auc_pr")


# ---- counts -------------------------------------------------------------------------------------------------------


def log_loss_term(label: Column, score: Column) -> Column:
    p = clip(score, LOG_LOSS_EPS, 1.0 - LOG_LOSS_EPS)
    return -F.ln(F.when(label == 1, p).otherwise(F.lit(1.0) - p))


def summary(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """n, share of positives and log loss, one row."""
    return _pairs(scored, label, score).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("y").alias("pos_rate"),
        F.avg(log_loss_term(F.col("y"), F.col("s"))).alias("log_loss"),
    )


def log_loss(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    return summary(scored, label, score).select("log_loss")


def confusion_at(
    scored: DataFrame, thresholds: Sequence[float], prefix: str = "", label: str = LABEL, score: str = SCORE
) -> DataFrame:
    """tp, fp, tn, fn for every threshold, all counted in the same pass."""
    pairs = _pairs(scored, label, score)
    y, s = F.col("y"), F.col("s")
    counts = [F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")]
    cells = []
    nothing = "label string, threshold double, tp bigint, fp bigint, tn bigint, fn bigint"
    if not thresholds:
        return scored.sparkSession.createDataFrame([], nothing)
    for i, threshold in enumerate(thresholds):
        reached = s >= F.lit(float(threshold))
        counts += [F.count_if(reached & (y == 1)).alias(f"tp{i}"), F.count_if(reached & (y == 0)).alias(f"fp{i}")]
        cells.append(
            F.struct(
                F.lit(threshold_label(prefix, threshold)).alias("label"),
                F.lit(float(threshold)).alias("threshold"),
                F.col(f"tp{i}").alias("tp"),
                F.col(f"fp{i}").alias("fp"),
                (F.col("neg") - F.col(f"fp{i}")).alias("tn"),
                (F.col("pos") - F.col(f"tp{i}")).alias("fn"),
            )
        )
    return pairs.agg(*counts).select(F.inline(F.array(*cells)))


def grid_sweep(
    scored: DataFrame, grid_points: int = F1_GRID_POINTS, label: str = LABEL, score: str = SCORE
) -> DataFrame:
    """tp, fp, tn, fn and F1 at every threshold of an even grid over [0, 1].

    Each row adds to the histogram cell of the highest grid threshold its score reaches; running sums over the (at
    most ``grid_points``) cells then give every confusion matrix. One empty row per cell makes each threshold show.
    """
    points = max(2, int(grid_points))
    step = F.lit(grid_step(points))
    s = F.col("s")

    def threshold(k: Column) -> Column:
        return F.when(k >= points - 1, F.lit(1.0)).otherwise(k * step)

    guess = clip(F.floor(s * F.lit(float(points - 1))).cast("double"), 0.0, float(points - 1))
    # the product can round across a grid threshold in either direction
    cell = (
        F.when(threshold(guess) > s, guess - 1)
        .when((guess < points - 1) & (threshold(guess + 1) <= s), guess + 1)
        .otherwise(guess)
    )
    # scores below 0 reach no threshold: cell -1
    cell = F.when(s >= 0, cell).otherwise(F.lit(-1.0)).cast("int")
    rows = _pairs(scored, label, score).select(
        cell.alias("cell"),
        F.when(F.col("y") == 1, 1).otherwise(0).alias("pos"),
        F.when(F.col("y") == 0, 1).otherwise(0).alias("neg"),
    )
    empty = scored.sparkSession.range(-1, points, 1, 1).select(
        F.col("id").cast("int").alias("cell"), F.lit(0).alias("pos"), F.lit(0).alias("neg")
    )
    histogram = rows.unionByName(empty).groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    every = Window.partitionBy(F.lit(1))
    from_here = every.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = histogram.select(
        "cell",
        F.sum("pos").over(from_here).alias("tp"),
        F.sum("neg").over(from_here).alias("fp"),
        F.sum("pos").over(every).alias("_pos"),
        F.sum("neg").over(every).alias("_neg"),
    ).where(F.col("cell") >= 0)
    cells = swept.select(
        threshold(F.col("cell")).cast("double").alias("threshold"),
        "tp",
        "fp",
        (F.col("_neg") - F.col("fp")).alias("tn"),
        (F.col("_pos") - F.col("tp")).alias("fn"),
    )
    return cells.withColumn("f1", f1_score())


def best_f1(
    scored: DataFrame,
    grid_points: int = F1_GRID_POINTS,
    prefix: str = "",
    label: str = LABEL,
    score: str = SCORE,
) -> DataFrame:
    """Confusion counts at the grid threshold with the highest F1; the lowest such threshold wins."""
    best = grid_sweep(scored, grid_points, label, score).orderBy(F.desc("f1"), "threshold").limit(1)
    return best.select(F.lit(f"{prefix}_best_f1").alias("label"), "threshold", "tp", "fp", "tn", "fn")


# ---- rates and reports --------------------------------------------------------------------------------------------


def accuracy_score() -> Column:
    return ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"), 0.0)


def precision_score() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0.0)


def recall_score() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"), 0.0)


def f1_score() -> Column:
    return ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"), 0.0)


def add_rates(confusion: DataFrame) -> DataFrame:
    """accuracy, precision, recall and F1 from the confusion counts; 0 where a denominator is 0."""
    return confusion.withColumns(
        {
            "accuracy": accuracy_score(),
            "precision": precision_score(),
            "recall": recall_score(),
            "f1": f1_score(),
        }
    )


def _complete(confusion: DataFrame, scored: DataFrame, label: str, score: str, **tuning) -> DataFrame:
    """Full metrics rows: rates plus the threshold-free numbers, computed once for all rows."""
    totals = summary(scored, label, score).select(F.struct("n", "pos_rate", "log_loss")).scalar()
    curve = curve_scores(score_curve(scored, label, score, **tuning))
    areas = curve.select(F.struct("auc_roc", "auc_pr")).scalar()
    rows = add_rates(confusion).select("*", totals.alias("_totals"), areas.alias("_areas"))
    return rows.select("*", "_totals.*", "_areas.*").select(*METRIC_COLUMNS)


def metrics_table(
    scored: DataFrame,
    thresholds: Sequence[float] = tuple(REPORT_THRESHOLDS),
    prefix: str = "",
    label: str = LABEL,
    score: str = SCORE,
    **tuning,
) -> DataFrame:
    """One metrics row per threshold."""
    return _complete(confusion_at(scored, thresholds, prefix, label, score), scored, label, score, **tuning)


def best_f1_metrics(
    scored: DataFrame,
    grid_points: int = F1_GRID_POINTS,
    prefix: str = "",
    label: str = LABEL,
    score: str = SCORE,
    **tuning,
) -> DataFrame:
    """The metrics row of the best-F1 threshold."""
    return _complete(best_f1(scored, grid_points, prefix, label, score), scored, label, score, **tuning)


def metrics_report(
    scored: DataFrame,
    prefix: str,
    thresholds: Sequence[float] = tuple(REPORT_THRESHOLDS),
    grid_points: int = F1_GRID_POINTS,
    label: str = LABEL,
    score: str = SCORE,
    **tuning,
) -> DataFrame:
    """Threshold rows and the best-F1 row of one scored table, sharing one curve and one summary."""
    confusion = confusion_at(scored, thresholds, prefix, label, score).unionByName(
        best_f1(scored, grid_points, prefix, label, score)
    )
    return _complete(confusion, scored, label, score, **tuning)


def concat_reports(*reports: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """All rows of the given reports; missing reports are skipped, missing columns become NULL.

    Without any report the result is an empty metrics table.
    """
    given = [r for r in reports if r is not None]
    if not given:
        session = spark or SparkSession.active()
        return session.createDataFrame([], ", ".join(f"`{c}` {METRIC_TYPES.get(c, 'double')}" for c in METRIC_COLUMNS))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), given)
