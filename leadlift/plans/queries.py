"""The registered queries: every operator, run over the whole given tables.

``p_apply`` comes from the scorecard where a query is checked against SQL, and from fitted models in the model
queries. Computed doubles are rounded to six digits, so that summation order does not show in a comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlift.functions import draws
from leadlift.functions.numeric import clip, contribution_column, fixed
from leadlift.operators import boosting, categories, encoding, explain, exports, metrics, models, ranking, splits
from leadlift.operators.columns import (
    attach_features,
    feature_columns,
    normalise_categories,
    restrict_features,
    rows_of,
)
from leadlift.operators.labels import add_label, add_score, add_scorecard_probability
from leadlift.operators.order_stats import BUCKET, in_buckets, rank_rows
from leadlift.plans import flows
from leadlift.settings import (
    CATEGORICAL,
    EXPLAIN_TOP_N,
    FEATURES,
    ID_COLUMNS,
    KEY,
    LABEL,
    REPORT_THRESHOLDS,
    SCORE,
    SCORECARD,
    TOP_K,
)
from leadlift.sources.customers import latest_channel, load_customers, order_history, order_history_on, read_input
from leadlift.sources.model_store import load_model, save_model
from leadlift.sources.staging import dropped, stage, staging_path
from leadlift.sources.tables import read_csv, read_parquet, write_csv, write_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORECARD_FEATURES = list(SCORECARD)
NUMERIC = [f for f in FEATURES if f not in CATEGORICAL]

def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six digits for the named columns; without names, for every double."""
    chosen = names or tuple(name for name, kind in df.dtypes if kind == "double")
    return df.withColumns({name: fixed(F.col(name)) for name in chosen})


def scored_customers(spark: SparkSession, folder: str) -> DataFrame:
    return add_scorecard_probability(add_label(load_customers(spark, folder)))


def staged_scores(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """Key, label and score (and further columns), computed once."""
    return stage(scored_customers(spark, folder).select(KEY, LABEL, SCORE, *more), "scores")


# ---- features, draws, labels --------------------------------------------------------------------------------------


@query
def customer_features(spark, folder):
    return rounded(load_customers(spark, folder), "utilization_rate")


@query
def order_aggregates(spark, folder):
    history = order_history(read_input(spark, folder, "orders"), read_input(spark, folder, "lineitem"))
    return history.select(
        "o_custkey",
        F.col("first_order_age").cast("bigint").alias("first_order_age"),
        "recent_orders",
        F.coalesce("recent_cents", F.lit(0)).alias("recent_cents"),
        "late_orders",
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce("returned_lines", F.lit(0)).alias("returned_lines"),
    )


@query
def latest_channel_per_user(spark, folder):
    return latest_channel(read_input(spark, folder, "events"))


DRAWN_REGIONS = ["coast", "hills", "plains", "woods"]
DRAWN_CHANNELS = {"counter": 0.15, "phone_app": 0.45, "site": 0.25, "hotline": 0.15}


@query
def keyed_draws(spark, folder):
    customer = read_input(spark, folder, "customer")
    key = "c_custkey"
    drawn = customer.select(
        key,
        draws.uniform(key, "a").alias("uniform_draw"),
        draws.int_range(key, "b", 21, 75).alias("age"),
        draws.normal(key, "c", 65000, 22000).alias("income"),
        draws.lognormal(key, "d", 8.6, 0.9).alias("savings"),
        draws.poisson(key, "e", 18.0).alias("txn_count"),
        draws.poisson(key, "f", 0.35).alias("late_payments"),
        draws.beta(key, "g", 2.2, 4.5).alias("utilization"),
        draws.choice(key, "h", DRAWN_REGIONS).alias("region"),
        draws.weighted_choice(key, "i", DRAWN_CHANNELS).alias("channel"),
        draws.bernoulli(key, "j", 0.22).alias("is_premium"),
    )
    return rounded(drawn)


@query
def scorecard(spark, folder):
    scored = add_scorecard_probability(add_score(load_customers(spark, folder)))
    return rounded(scored.select(KEY, "score", SCORE))


@query
def scored_label(spark, folder):
    return rounded(add_score(add_label(load_customers(spark, folder))).select(KEY, "score", LABEL))


@query
def feature_matrix(spark, folder):
    labelled = add_label(load_customers(spark, folder))
    return rounded(labelled.select(*feature_columns(labelled)), "utilization_rate")


@query
def restricted_features(spark, folder):
    labelled = add_label(load_customers(spark, folder))
    return rounded(restrict_features(labelled, [*SCORECARD_FEATURES, "not_a_column"]), "utilization_rate")


@query
def normalized_categoricals(spark, folder):
    customer = read_input(spark, folder, "customer").select("c_custkey")
    channel = latest_channel(read_input(spark, folder, "events"))
    joined = customer.join(channel, customer.c_custkey == channel.user_id, "left")
    return normalise_categories(joined.select("c_custkey", "channel"), CATEGORICAL)


# ---- splits and joins ---------------------------------------------------------------------------------------------


def staged_labels(spark: SparkSession, folder: str, *more: str, salts: tuple[str, ...] = ("split",)) -> DataFrame:
    """Key, label, further columns and the draws of the splits to come, computed once."""
    labelled = add_label(load_customers(spark, folder)).select(KEY, LABEL, *more)
    return stage(reduce(splits.with_draw, salts, labelled), "labels")


@query
def stratified_split(spark, folder):
    return splits.add_stratified_split(staged_labels(spark, folder))


@query
def train_valid_split(spark, folder):
    return splits.add_three_way_split(staged_labels(spark, folder, salts=("split", "valid")))


@query
def bernoulli_split(spark, folder):
    return splits.add_bernoulli_split(load_customers(spark, folder).select(KEY))


@query
def split_shares(spark, folder):
    """Rows and positives per part, after the features were restricted: the split column keeps the parts the same."""
    labelled = staged_labels(spark, folder, *SCORECARD_FEATURES, salts=("split", "valid"))
    split = splits.add_valid_split(splits.add_stratified_split(labelled))
    narrow = restrict_features(split, SCORECARD_FEATURES[:3], keep=(LABEL, splits.SPLIT))
    shares = narrow.groupBy(splits.SPLIT).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(LABEL).cast("bigint")).alias("positives"),
        F.avg("credit_score").alias("avg_credit_score"),
    )
    return rounded(shares)


@query
def features_left_join(spark, folder):
    customers = stage(add_scorecard_probability(load_customers(spark, folder)), "customers")
    joined = attach_features(customers.select(KEY, SCORE), customers, KEY, SCORECARD_FEATURES)
    return rounded(joined)


@query
def test_rows_semi_join(spark, folder):
    labelled = staged_labels(spark, folder, "email", "phone")
    test = splits.part(splits.add_stratified_split(labelled), "test")
    return rows_of(labelled.select(*ID_COLUMNS, LABEL), test, KEY)


@query
def scores_joined_to_labels(spark, folder):
    """Scores and labels that arrive as separate tables meet on the key, never by position."""
    scored = staged_scores(spark, folder)
    joined = scored.select(KEY, LABEL).join(scored.select(KEY, SCORE), KEY)
    return rounded(metrics.add_predictions(joined, 0.5), SCORE)


# ---- metrics ------------------------------------------------------------------------------------------------------


@query
def threshold_predictions(spark, folder):
    scored = scored_customers(spark, folder).select(KEY, SCORE)
    for threshold in REPORT_THRESHOLDS:
        scored = metrics.add_predictions(scored, threshold, column=f"pred_{round(threshold * 100)}")
    return scored.drop(SCORE)


@query
def score_summary(spark, folder):
    return rounded(metrics.summary(scored_customers(spark, folder)))


@query
def confusion_at_thresholds(spark, folder):
    return metrics.confusion_at(scored_customers(spark, folder), REPORT_THRESHOLDS, "all")


@query
def threshold_rates(spark, folder):
    confusion = metrics.confusion_at(scored_customers(spark, folder), REPORT_THRESHOLDS, "all")
    return rounded(metrics.add_rates(confusion).select("label", "accuracy", "precision", "recall", "f1"))


@query
def score_curve(spark, folder):
    return rounded(metrics.score_curve(staged_scores(spark, folder)))


@query
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(staged_scores(spark, folder)))


@query
def average_precision(spark, folder):
    return rounded(metrics.average_precision(staged_scores(spark, folder)))


@query
def log_loss(spark, folder):
    return rounded(metrics.log_loss(scored_customers(spark, folder)))


@query
def metrics_table(spark, folder):
    return rounded(metrics.metrics_table(staged_scores(spark, folder), prefix="all"))


@query
def f1_sweep(spark, folder):
    return rounded(metrics.grid_sweep(scored_customers(spark, folder)))


@query
def best_f1(spark, folder):
    return rounded(metrics.best_f1_metrics(staged_scores(spark, folder), prefix="all"))


@query
def metrics_report(spark, folder):
    """Reports of two parts, one below the other."""
    split = stage(splits.add_stratified_split(staged_scores(spark, folder)), "split", [splits.SPLIT])
    reports = [metrics.metrics_report(splits.part(split, name), name) for name in ("train", "test")]
    return rounded(metrics.concat_reports(reports[0], None, reports[1]))


@query
def metrics_csv_round_trip(spark, folder):
    report = metrics.metrics_report(staged_scores(spark, folder), "all")
    path = exports.export_metrics(report, staging_path(spark, "metrics-csv"))
    return rounded(read_csv(spark, path, report.schema))


def event_values(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their largest and mean event value: NULL for the nine tenths without an event."""
    seen = read_input(spark, folder, "events").groupBy("user_id").agg(
        F.max("value").alias("top_value"), F.avg("value").alias("mean_value")
    )
    customer = read_input(spark, folder, "customer")
    return customer.join(seen, customer.c_custkey == seen.user_id, "left").select("c_custkey", "top_value", "mean_value")


@query
def clipped_with_missing(spark, folder):
    """Missing values stay missing within bounds."""
    values = event_values(spark, folder)
    return rounded(
        values.select(
            "c_custkey",
            clip(F.col("top_value"), 40.0, 60.0).alias("top_value"),
            clip(F.col("mean_value"), 45.0, 55.0).alias("mean_value"),
        )
    )


@query
def metrics_with_missing_scores(spark, folder):
    """A report over scores that most rows lack: it counts the rows that have one."""
    values = event_values(spark, folder).withColumn(KEY, F.col("c_custkey") + 100000)
    labelled = add_label(load_customers(spark, folder)).select(KEY, LABEL)
    scored = labelled.join(values, KEY, "left").select(LABEL, clip(F.col("mean_value") / 100, 0.0, 1.0).alias(SCORE))
    return rounded(metrics.metrics_report(stage(scored, "holed"), "mixed"))


# ---- ranks, deciles, leads ----------------------------------------------------------------------------------------


@query
def rank_first(spark, folder):
    return ranking.rank_first(staged_scores(spark, folder)).select(KEY, "rank")


@query
def rank_within_class(spark, folder):
    """Rank of every customer's split draw among the customers with the same label."""
    drawn = staged_labels(spark, folder)
    return rank_rows(drawn, splits.draw_column("split"), KEY, by=LABEL).select(KEY, LABEL, "rank")


@query
def deciles_qcut(spark, folder):
    return ranking.add_deciles(staged_scores(spark, folder)).select(KEY, ranking.DECILE)


@query
def deciles_ntile(spark, folder):
    return ranking.add_deciles(staged_scores(spark, folder), method="ntile").select(KEY, ranking.DECILE)


@query
def decile_table(spark, folder):
    return rounded(ranking.decile_table(ranking.add_deciles(staged_scores(spark, folder))))


def scored_test_part(spark: SparkSession, folder: str) -> DataFrame:
    labelled = staged_labels(spark, folder, "email", "phone", *SCORECARD_FEATURES)
    test = splits.part(splits.add_stratified_split(labelled), "test")
    scored = restrict_features(add_scorecard_probability(test), [*SCORECARD_FEATURES, SCORE])
    return models.with_auc(stage(scored, "scored-test"))


@query
def scored_test(spark, folder):
    return rounded(scored_test_part(spark, folder))


def all_leads(spark: SparkSession, folder: str) -> DataFrame:
    scored = staged_scores(spark, folder, "email", "phone", *SCORECARD_FEATURES)
    return ranking.leads(ranking.add_deciles(scored))


@query
def leads(spark, folder):
    return rounded(all_leads(spark, folder).select(*ID_COLUMNS, LABEL, SCORE, ranking.DECILE))


@query
def leads_top10(spark, folder):
    return flows.report_heads({"leads": leads(spark, folder)})["leads"]


# ---- explanations and exports -------------------------------------------------------------------------------------


def staged_for_explaining(spark: SparkSession, folder: str) -> DataFrame:
    scored = scored_customers(spark, folder).select(*ID_COLUMNS, LABEL, *SCORECARD_FEATURES, SCORE)
    # shares as the export shows them
    return stage(rounded(scored, "utilization_rate"), "explain")


def explained_leads(spark: SparkSession, folder: str) -> DataFrame:
    customers = staged_for_explaining(spark, folder)
    top = ranking.leads(ranking.add_deciles(customers))
    return explain.top_contributions(explain.linear_contributions(top, customers), SCORECARD_FEATURES)


@query
def lead_contributions(spark, folder):
    customers = staged_for_explaining(spark, folder)
    explained = explain.linear_contributions(customers, customers)
    names = [contribution_column(f) for f in SCORECARD_FEATURES]
    return rounded(explained.select(KEY, explain.EXPECTED, *names))


def ranked_columns() -> list[str]:
    return [f"exp_{i}_{f}" for i in range(1, EXPLAIN_TOP_N + 1) for f in exports.RANKED_FIELDS]


@query
def lead_top_contributions(spark, folder):
    return rounded(explained_leads(spark, folder).select(KEY, *ranked_columns()))


@query
def static_explanations(spark, folder):
    top = all_leads(spark, folder).select(KEY, "credit_score", "is_premium", "tenure_months")
    explained = explain.static_explanations(top, ["credit_score", "absent", "is_premium", "tenure_months"], 4)
    return explained.drop("credit_score", "is_premium", "tenure_months")


@query
def mean_abs_contribution(spark, folder):
    customers = staged_for_explaining(spark, folder)
    explained = explain.linear_contributions(customers, customers)
    return rounded(explain.mean_abs_contributions(explained, SCORECARD_FEATURES))


@query
def top_k_features(spark, folder):
    means = mean_abs_contribution(spark, folder).withColumnRenamed("mean_abs_shap", "importance")
    return models.sort_importance(means).limit(TOP_K // 2)


@query
def leads_export_csv(spark, folder):
    """Explained leads, written as CSV in the export's column order and read back."""
    table = exports.lead_export(explained_leads(spark, folder), SCORECARD_FEATURES)
    path = write_csv(table, staging_path(spark, "leads-csv"))
    return rounded(read_csv(spark, path, table.schema))


@query
def parquet_round_trip(spark, folder):
    customers = scored_customers(spark, folder).select(KEY, *SCORECARD_FEATURES, LABEL, SCORE)
    path = write_parquet(customers, staging_path(spark, "customers"))
    return rounded(read_parquet(spark, path))


# ---- encoders -----------------------------------------------------------------------------------------------------


def staged_split(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return splits.add_stratified_split(staged_labels(spark, folder, *more))


@query
def column_statistics(spark, folder):
    """Mean and population standard deviation of each numeric feature over the training rows."""
    train = splits.part(staged_split(spark, folder, *NUMERIC), "train")
    rows = [
        F.struct(
            F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("std")
        )
        for c in NUMERIC
    ]
    return rounded(train.agg(F.array(*rows).alias("rows")).select(F.inline("rows")))


@query
def standard_scaled(spark, folder):
    split = staged_split(spark, folder, *NUMERIC)
    scaled = encoding.standard_scaled(split, splits.part(split, "train"), NUMERIC)
    return rounded(scaled.select(KEY, *NUMERIC))


@query
def category_dictionary(spark, folder):
    """Distinct training categories in alphabetic order, with their numbers."""
    train = splits.part(staged_split(spark, folder, *CATEGORICAL), "train")
    table = categories.dictionaries(train, CATEGORICAL, by_frequency=False)
    return table.select("feature", "category", F.col("number").cast("int"), "n")


@query
def string_index(spark, folder):
    split = staged_split(spark, folder, *CATEGORICAL)
    indexed = encoding.string_indexed(split, splits.part(split, "train"), CATEGORICAL)
    return indexed.select(KEY, *[F.col(encoding.index_name(c)).cast("int").alias(f"{c}_index") for c in CATEGORICAL])


@query
def target_statistics(spark, folder):
    """Ordered target statistics of the training rows, and totals of all training rows for the test rows."""
    split = staged_split(spark, folder, *CATEGORICAL).select(KEY, LABEL, splits.SPLIT, *CATEGORICAL)
    train, test = splits.part(split, "train"), splits.part(split, "test")
    ordered = categories.ordered_target_statistics(train, CATEGORICAL)
    totals = categories.with_target_totals(test, categories.target_totals(train, CATEGORICAL), CATEGORICAL)
    return rounded(ordered.unionByName(totals).drop(LABEL, *CATEGORICAL))


@query
def one_hot(spark, folder):
    split = staged_split(spark, folder, *CATEGORICAL)
    encoded = encoding.one_hot_encoded(split, splits.part(split, "train"), CATEGORICAL)
    return encoded.select(
        KEY, *[F.array_join(encoding.slots_name(c), ",").alias(f"{c}_slots") for c in CATEGORICAL]
    )


# Days inside the years of the orders.
ASKED_DAYS = [date(1996, 3, 31), date(1998, 12, 31), date(2001, 6, 30)]


@query
def order_history_on_days(spark, folder):
    """Point-in-time aggregates of every customer on three days."""
    found = order_history_on(read_input(spark, folder, "orders"), read_input(spark, folder, "lineitem"), ASKED_DAYS)
    return found.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd"))


@query
def customers_as_of(spark, folder):
    """The recency features on one day in the past, and the newest event up to it."""
    day = F.lit(ASKED_DAYS[1])
    history = order_history(read_input(spark, folder, "orders"), read_input(spark, folder, "lineitem"), day)
    newest = latest_channel(read_input(spark, folder, "events"), F.lit(date(2024, 1, 15)))
    return (
        read_input(spark, folder, "customer")
        .select("c_custkey")
        .join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(newest, F.col("c_custkey") == F.col("user_id"), "left")
        .select("c_custkey", "first_order_age", "recent_orders", "recent_cents", "late_orders", "lines", "channel")
    )


# ---- fitted models (SQL checks only what does not depend on the fit) ----------------------------------------------


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    return flows.prepare(load_customers(spark, folder))


_flows: dict[tuple[str, str, int], flows.Results] = {}


def full_results(spark: SparkSession, folder: str) -> flows.Results:
    """The full flow with its own defaults, run once per application and folder: its queries show different results."""
    key = (spark.sparkContext.applicationId, folder, dropped(spark))
    if key not in _flows:
        _flows[key] = flows.full_flow(load_customers(spark, folder))
    return _flows[key]


@query
def lr_baseline_metrics(spark, folder):
    return flows.baseline_flow(load_customers(spark, folder))["baseline_metrics"]


@query
def gbt_scored_test(spark, folder):
    return full_results(spark, folder)["scored_test"]


@query
def gbt_importance(spark, folder):
    return full_results(spark, folder)["feature_importance"]


@query
def gbt_tuning_trials(spark, folder):
    return full_results(spark, folder)["tuning_trials"]


@query
def gbt_best_trial(spark, folder):
    return models.best_trial(gbt_tuning_trials(spark, folder))


@query
def gbt_lead_contributions(spark, folder):
    return full_results(spark, folder)["leads_export"]


@query
def gbt_mean_abs_contribution(spark, folder):
    return full_results(spark, folder)["mean_abs_contributions"]


def flag(condition) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


@query
def lr_gradient(spark, folder):
    """Whether the penalised loss of the baseline has slope zero in the weight of every numeric feature."""
    data = prepared(spark, folder)
    model = models.fit_baseline(data, FEATURES)
    train = stage(models.add_probability(model, splits.part(data, "train")), "train")
    rows = train.count()
    weights = model.stages[-1].coefficients.toArray()
    means = train.agg(*[F.avg(c).alias(c) for c in NUMERIC], *[F.stddev_pop(c).alias(f"{c}__std") for c in NUMERIC])
    fixed_means = means.first()
    residual = F.col(SCORE) - F.col(LABEL)
    slopes = train.agg(
        *[F.sum(residual * (F.col(c) - fixed_means[c]) / fixed_means[f"{c}__std"]).alias(c) for c in NUMERIC],
        F.sum(residual).alias("(intercept)"),
    )
    penalty = dict(zip(NUMERIC, map(float, weights)))
    entries = [
        F.struct(F.lit(c).alias("feature"), flag(F.abs(F.col(f"`{c}`") + penalty.get(c, 0.0)) / rows < 1e-3).alias("vanishes"))
        for c in [*NUMERIC, "(intercept)"]
    ]
    return slopes.select(F.inline(F.array(*entries)))


@query
def gbt_importance_totals(spark, folder):
    """Whether importances cover exactly the features, none negative, and add up to one."""
    table = gbt_importance(spark, folder)
    total = F.sum("importance").over(Window.partitionBy(F.lit(1)))
    return table.select(
        "feature", flag(F.col("importance") >= 0).alias("not_negative"), flag(F.abs(total - 1) < 1e-9).alias("all_add_up")
    )


@query
def gbt_scored_rows(spark, folder):
    """Keys and labels of the scored test rows, and whether their AUC is that of the rank formula."""
    scored = gbt_scored_test(spark, folder).select(KEY, LABEL, SCORE, "auc_on_test")
    per_score = scored.groupBy(SCORE).agg(F.sum(LABEL).alias("pos"), F.sum(1 - F.col(LABEL)).alias("neg"))
    # ranges of scores are windows of their own, on top of the totals of the ranges before
    tagged = in_buckets(per_score, [F.col(SCORE)])
    totals = tagged.groupBy(BUCKET).agg(F.sum("neg").alias("_neg"))
    before = Window.partitionBy(F.lit(1)).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(BUCKET, F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("_before"))
    below = Window.partitionBy(BUCKET).orderBy(SCORE).rowsBetween(Window.unboundedPreceding, -1)
    less = tagged.withColumn("_less", F.coalesce(F.sum("neg").over(below), F.lit(0))).join(offsets, BUCKET)
    ahead = F.col("_less") + F.col("_before") + F.col("neg") / 2
    won = F.sum(F.col("pos") * ahead) / (F.sum("pos") * F.sum("neg"))
    known = scored.select(F.max("auc_on_test")).scalar()
    agrees = less.agg(flag(F.abs(won - known) < 1e-9).alias("agrees")).scalar()
    return scored.select(KEY, LABEL, agrees.alias("auc_agrees"), flag(F.col(SCORE).between(0, 1)).alias("is_share"))


@query
def gbt_lead_rows(spark, folder):
    """Leads per decile, and whether each names its features from the largest contribution to the smallest."""
    explained = full_results(spark, folder)["leads_explained"]
    sizes = [F.abs(F.col(f"exp_{i}_contribution")) for i in range(1, EXPLAIN_TOP_N + 1)]
    falling = reduce(lambda a, b: a & b, (x >= y for x, y in zip(sizes, sizes[1:])))
    return explained.groupBy(ranking.DECILE).agg(
        F.count(F.lit(1)).alias("leads"), F.min(flag(falling)).alias("ranks_agree")
    )


@query
def gbt_trial_choice(spark, folder):
    """Whether the chosen trial has the highest AUC and, of those that have it, the lowest number."""
    results = full_results(spark, folder)
    trials, best = results["tuning_trials"], models.best_trial(results["tuning_trials"])
    chosen = best.select(F.struct("trial", "valid_auc")).scalar()
    numbered = trials.select("trial", "valid_auc", chosen.alias("chosen"))
    top = F.max("valid_auc")
    first = F.min(F.when(F.col("valid_auc") == F.col("chosen.valid_auc"), F.col("trial")))
    known = F.lit(float(results["best_valid_auc"]))
    return numbered.agg(
        F.count(F.lit(1)).alias("trials"),
        flag((top == F.max("chosen.valid_auc")) & (top == known)).alias("chosen_is_best"),
        flag(first == F.max("chosen.trial")).alias("chosen_is_first"),
        flag(F.count_distinct("trial") == F.max("trial")).alias("in_order"),
    )


@query
def gbt_prefix_choice(spark, folder):
    """Whether each trial kept some of the trees it grew, and the best trial's AUC is that of its validation scores."""
    results = full_results(spark, folder)
    valid = splits.part(results["restricted"], "valid")
    scored = stage(models.add_probability(results["model"], valid).select(LABEL, SCORE), "valid")
    agrees = F.abs(metrics.roc_auc(scored).scalar() - F.lit(float(results["best_valid_auc"]))) < 1e-9
    rows = [
        (i + 1, int(1 <= len(b.model.trees) <= len(b.grown) <= b.params["maxIter"]))
        for i, b in enumerate(results["fitted_trials"])
    ]
    table = spark.createDataFrame(rows, "trial int, kept_of_grown int")
    return table.select("trial", "kept_of_grown", flag(agrees).alias("auc_agrees"))


@query
def gbt_missing_direction(spark, folder):
    """Trees for a label that only says whether the age is missing: every row's score must lie on its label's side of
    the middle of all scores."""
    data = prepared(spark, folder)
    hole = F.pmod(F.col(KEY), F.lit(5)) < 2
    holed = stage(data.withColumn(LABEL, hole.cast("int")).withColumn("age", F.when(~hole, F.col("age"))), "holed")
    model = boosting.fit_boosted(holed, ["age", "tenure_months", "region"], {"maxIter": 8, "maxDepth": 2})
    test = stage(models.add_probability(model, splits.part(holed, "test")).select(KEY, LABEL, SCORE), "told")
    middle = test.select((F.min(SCORE) + F.max(SCORE)) / 2).scalar()
    return test.select(KEY, LABEL, flag((F.col(SCORE) > middle) == (F.col(LABEL) == 1)).alias("told"))


@query
def gbt_mean_abs_totals(spark, folder):
    """Whether mean contributions are those of the explained rows, largest first."""
    results = full_results(spark, folder)
    table, explained = results["mean_abs_contributions"], results["explained"]
    names = explain.contribution_map(explained, results["selected_features"])
    total = explained.agg(F.avg(reduce(lambda a, b: a + b, [F.abs(F.col(c)) for c in names.values()]))).scalar()
    listed = table.agg(
        F.count(F.lit(1)).alias("features"),
        F.min("mean_abs_shap").alias("least"),
        F.max("mean_abs_shap").alias("most"),
        F.sum("mean_abs_shap").alias("all"),
        F.first("mean_abs_shap").alias("leading"),
    )
    return listed.select(
        "features",
        flag(F.col("least") >= 0).alias("not_negative"),
        flag(F.col("most") >= F.col("leading")).alias("in_order"),
        flag(F.abs(F.col("all") - total) < 1e-9).alias("agrees"),
    )


@query
def flow_report_totals(spark, folder):
    """What the flow's reports must count whatever the fit: rows and positives, and that the cells add up."""
    report = full_results(spark, folder)["performance_metrics"]
    cells = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return rounded(report.select("label", "n", "pos_rate", flag(cells == F.col("n")).alias("cells_add_up")))


@query
def lr_report_totals(spark, folder):
    """What a report of fitted scores must count whatever the fit: rows and positives of the validation part."""
    report = flows.baseline_flow(load_customers(spark, folder))["baseline_metrics"]
    positives, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    totals = report.select("label", "n", "pos_rate", positives.alias("positives"), negatives.alias("negatives"))
    return rounded(totals)


@query
def gbt_decile_sizes(spark, folder):
    """Customers per decile of the fitted scores, and the responders of all deciles together."""
    table = full_results(spark, folder)["decile_table"]
    everyone = Window.partitionBy(F.lit(1))
    return table.select(ranking.DECILE, "customers", F.sum("responders").over(everyone).alias("all_responders"))


@query
def gbt_contributions_add_up(spark, folder):
    """Whether expected value plus contributions equal the log-odds of every test row's score."""
    results = full_results(spark, folder)
    explained = results["explained"]
    names = explain.contribution_map(explained, results["selected_features"])
    odds = reduce(lambda a, c: a + F.col(c), names.values(), F.col(explain.EXPECTED))
    gap = F.abs(1 / (1 + F.exp(-odds)) - F.col(SCORE))
    return explained.select(KEY, (gap < 1e-9).cast("int").alias("adds_up"))


@query
def model_reload_scores(spark, folder):
    """Whether a saved and reloaded model gives every test row the score it had before."""
    data = prepared(spark, folder)
    model = models.fit_baseline(data, FEATURES)
    loaded = load_model(save_model(model, staging_path(spark, "model")))
    test = splits.part(data, "test")
    both = models.add_probability(loaded, models.add_probability(model, test, "score_before"), "score_after")
    return both.select(KEY, LABEL, (F.col("score_before") == F.col("score_after")).cast("int").alias("same_score"))


@query
def full_flow_performance(spark, folder):
    return full_results(spark, folder)["performance_metrics"]
