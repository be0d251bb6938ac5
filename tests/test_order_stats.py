"""Ranks, cut-offs, deciles and splits against plain sorting, with many small buckets and heavy ties."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadlift.operators import metrics, order_stats, ranking, splits
from leadlift.operators.order_stats import BUCKET, MAX_GROUPS, group_counts, in_buckets, keys_at_ranks, rank_rows


def make(spark, pairs):
    return spark.createDataFrame(pairs, "customer_id bigint, p_apply double")


def skewed(n, seed=3):
    """A third of all rows share one score, another sixth a second one; ids are shuffled."""
    rng = random.Random(seed)
    ids = list(range(100, 100 + n))
    rng.shuffle(ids)
    scores = [0.25 if i < n // 3 else 0.75 if i < n // 2 else rng.random() for i in range(n)]
    return list(zip(ids, scores))


def in_order(pairs):
    return sorted(pairs, key=lambda p: (p[1], p[0]))


@pytest.mark.parametrize("rows_per_bucket", [7, 50, 10_000])
def test_rank_rows_matches_sorting(spark, rows_per_bucket):
    pairs = skewed(900)
    ranked = rank_rows(make(spark, pairs), "p_apply", "customer_id", rows_per_bucket=rows_per_bucket)
    got = {r["customer_id"]: r["rank"] for r in ranked.collect()}
    assert got == {key: i for i, (key, _) in enumerate(in_order(pairs), 1)}


def sizes(df, rows_per_bucket):
    tagged = in_buckets(df, [F.col("p_apply"), F.col("customer_id")], rows_per_bucket)
    return [r["count"] for r in tagged.groupBy(BUCKET).count().collect()]


def test_repeated_values_do_not_fill_a_bucket(spark):
    assert max(sizes(make(spark, skewed(3000)), 100)) <= 300


def test_repeated_value_with_crowded_keys(spark):
    """The third of the rows that share one score also have neighbouring keys."""
    pairs = [(100 + i, 0.25 if i < 1000 else (i * 7919 % 3000) / 3000) for i in range(3000)]
    assert max(sizes(make(spark, pairs), 100)) <= 300


def test_crowded_keys_in_thousands_of_buckets(spark):
    """As above, in 4096 buckets; the grid of scores has few distinct values besides."""
    n = 12288
    pairs = [(100 + i, 0.25 if i < n // 3 else (i * 7919 % 40) / 40) for i in range(n)]
    df = make(spark, pairs).coalesce(1)
    counts = sizes(df, 3)
    assert len(counts) > 2000 and max(counts) <= 60


def test_small_tables_run_in_many_buckets(spark):
    assert len(sizes(make(spark, skewed(900)), 200_000)) > 4


def test_string_keys(spark):
    pairs = [(f"k{key:05d}", score) for key, score in skewed(300)]
    df = spark.createDataFrame(pairs, "customer_id string, p_apply double")
    for rows_per_bucket in (7, 10_000):
        ranked = rank_rows(df, "p_apply", "customer_id", rows_per_bucket=rows_per_bucket).collect()
        assert {r["customer_id"]: r["rank"] for r in ranked} == {k: i for i, (k, _) in enumerate(in_order(pairs), 1)}
        deciles = ranking.add_deciles(df, rows_per_bucket=rows_per_bucket).collect()
        cuts = ranking.last_ranks(300)
        expected = {k: 1 + sum(r > c for c in cuts) for r, (k, _) in enumerate(in_order(pairs), 1)}
        assert {r["customer_id"]: r["decile"] for r in deciles} == expected


@pytest.mark.parametrize("rows_per_bucket", [2, 10_000])
def test_missing_scores_do_not_change_the_curve(spark, rows_per_bucket):
    rows = [(i % 2, i / 20) for i in range(20)]
    holes = [(0, None), (1, None), (1, float("nan")), (None, 0.5), (0, float("nan"))]
    kinds = "applied_cc int, p_apply double"
    whole, holed = spark.createDataFrame(rows, kinds), spark.createDataFrame(rows + holes, kinds)
    expected = sorted(metrics.score_curve(whole).collect())
    assert sorted(metrics.score_curve(holed, rows_per_bucket=rows_per_bucket).collect()) == expected
    report = metrics.metrics_report(holed, "x").collect()

    def shown(rows):
        return sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in rows)

    assert shown(report) == shown(metrics.metrics_report(whole, "x").collect())
    assert all(r["n"] == r["tp"] + r["fp"] + r["tn"] + r["fn"] == 20 for r in report)
    assert metrics.left_out(holed).first()[0] == 5
    swept = {r["threshold"]: r for r in metrics.grid_sweep(holed).collect()}
    cell = metrics.confusion_at(holed, [0.3]).first()
    near = swept[min(swept, key=lambda t: abs(t - 0.3))]
    assert [cell[c] for c in ("tp", "fp", "tn", "fn")] == [near[c] for c in ("tp", "fp", "tn", "fn")]


def test_ranks_per_group_with_a_missing_group(spark):
    rows = [(key, score, [0, 1, None][key % 3]) for key, score in skewed(120)]
    df = spark.createDataFrame(rows, "customer_id bigint, p_apply double, y int")
    got = {r["customer_id"]: r["rank"] for r in rank_rows(df, "p_apply", "customer_id", by="y", rows_per_bucket=9).collect()}
    for group in (0, 1, None):
        ordered = in_order([(k, s) for k, s, y in rows if y == group])
        assert [got[k] for k, _ in ordered] == list(range(1, len(ordered) + 1))


def test_many_groups_are_no_class_label(spark):
    with pytest.raises(ValueError):
        group_counts(spark.range(MAX_GROUPS + 5), "id")


@pytest.mark.parametrize("rows_per_bucket", [11, 10_000])
def test_keys_at_ranks_per_group(spark, rows_per_bucket):
    rows = [(key, score, key % 2) for key, score in skewed(600)]
    df = spark.createDataFrame(rows, "customer_id bigint, p_apply double, y int")
    wanted = {0: [1, 10, 150], 1: [2, 299]}
    found = keys_at_ranks(df, "p_apply", "customer_id", wanted, by="y", rows_per_bucket=rows_per_bucket)
    for group, ranks in wanted.items():
        ordered = in_order([(k, s) for k, s, y in rows if y == group])
        assert {r: found[group, r] for r in ranks} == {r: (ordered[r - 1][1], ordered[r - 1][0]) for r in ranks}


def test_rows_without_a_score_are_not_ranked(spark):
    df = make(spark, [(1, 0.5), (2, None), (3, float("nan")), (4, 0.1)])
    assert {r["customer_id"]: r["rank"] for r in rank_rows(df, "p_apply", "customer_id").collect()} == {4: 1, 1: 2}
    deciles = {r["customer_id"]: r["decile"] for r in ranking.add_deciles(df).collect()}
    assert deciles == {4: 1, 1: 10, 2: None, 3: None}


def expected_deciles(n):
    return [1 if r == 1 else ((r - 1) * 10 + n - 2) // (n - 1) for r in range(1, n + 1)]


@given(st.integers(min_value=1, max_value=5000))
@settings(max_examples=200, deadline=None)
def test_cut_ranks_give_the_decile_formula(n):
    cuts = ranking.last_ranks(n)
    assert [1 + sum(r > c for c in cuts) for r in range(1, n + 1)] == expected_deciles(n)


@pytest.mark.parametrize("n", [11, 13, 40, 101, 997, 1500])
def test_cut_ranks_match_pandas_qcut(n):
    cuts = ranking.last_ranks(n)
    expected = (pd.qcut(pd.Series(range(1, n + 1)), 10, labels=False) + 1).tolist()
    assert [1 + sum(r > c for c in cuts) for r in range(1, n + 1)] == expected


@given(st.integers(min_value=1, max_value=3000))
@settings(max_examples=100, deadline=None)
def test_ntile_cuts(n):
    cuts = ranking.last_ranks(n, "ntile")
    size, extra = divmod(n, 10)
    expected = [d for d in range(1, 11) for _ in range(size + (d <= extra))]
    assert [1 + sum(r > c for c in cuts) for r in range(1, n + 1)] == expected


@pytest.mark.parametrize("method", ["qcut", "ntile"])
@pytest.mark.parametrize("n", [1, 9, 13, 997])
def test_deciles(spark, n, method):
    pairs = skewed(n)
    result = ranking.add_deciles(make(spark, pairs), method, rows_per_bucket=20)
    got = {r["customer_id"]: r["decile"] for r in result.collect()}
    cuts = ranking.last_ranks(n, method)
    assert got == {key: 1 + sum(r > c for c in cuts) for r, (key, _) in enumerate(in_order(pairs), 1)}


def test_unknown_decile_method(spark):
    with pytest.raises(ValueError):
        ranking.add_deciles(make(spark, [(1, 0.5)]), "thirds")


def test_empty_table(spark):
    empty = make(spark, [])
    assert ranking.add_deciles(empty).count() == 0
    assert rank_rows(empty, "p_apply", "customer_id").count() == 0


@given(st.dictionaries(st.integers(0, 4), st.integers(1, 500), min_size=1), st.floats(0.05, 0.6))
@settings(max_examples=200, deadline=None)
def test_held_out_sizes(counts, share):
    import math

    sizes = splits.held_out_sizes(counts, share)
    total = sum(counts.values())
    assert sum(sizes.values()) == math.ceil(share * total)
    for c, n in counts.items():
        assert abs(sizes[c] - n * math.ceil(share * total) / total) < 1


def test_split_does_not_depend_on_layout(spark):
    rows = [(100000 + i, i % 3 == 0) for i in range(700)]
    df = spark.createDataFrame(rows, "customer_id bigint, hit boolean").select(
        "customer_id", F.col("hit").cast("int").alias("applied_cc")
    )
    one = splits.add_three_way_split(df.repartition(1))
    many = splits.add_three_way_split(df.repartition(13), rows_per_bucket=25)
    assert sorted(one.collect()) == sorted(many.collect())
    assert {r["split"]: r["count"] for r in one.groupBy("split").count().collect()} == {
        "test": 175, "valid": 105, "train": 420,
    }
    again = splits.add_valid_split(splits.add_stratified_split(df))
    assert sorted(again.collect()) == sorted(one.collect())


def test_split_of_string_keys(spark):
    rows = [(f"c{i:04d}", i % 3 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id string, hit boolean").select(
        "customer_id", F.col("hit").cast("int").alias("applied_cc")
    )
    split = splits.add_three_way_split(df)
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {
        "test": 100, "valid": 60, "train": 240,
    }


def test_bernoulli_split_is_map_only(spark):
    df = spark.range(1000).select((F.col("id") + 100000).alias("customer_id"))
    result = splits.add_bernoulli_split(df, 0.25)
    assert 190 <= result.where("split = 'test'").count() <= 310
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()


def looked_up_ranks(spark, rows, schema, wanted, by=None):
    df = spark.createDataFrame(rows, schema)
    return keys_at_ranks(df, "v", "k", wanted, by=by, rows_per_bucket=50)


@pytest.mark.parametrize("few", [1, 20])
def test_crowded_ranks_need_no_order_of_rows(spark, monkeypatch, few):
    """Scores within 1e-6 of each other, and one value for half of the rows: passes narrow both down."""
    monkeypatch.setattr(order_stats, "FEW_ROWS", few)
    monkeypatch.setattr(order_stats, "rank_rows", lambda *_, **__: pytest.fail("rows were ordered"))
    rng = np.random.default_rng(3)
    rows = [(int(k), 0.5 if i % 2 else 0.5 + float(rng.random()) * 1e-6) for i, k in enumerate(rng.permutation(3000))]
    wanted = [1, 2, 700, 1500, 1501, 2999, 3000]
    found = looked_up_ranks(spark, rows, "k bigint, v double", {0: wanted})
    ordered = sorted((v, k) for k, v in rows)
    assert found == {(0, r): ordered[r - 1] for r in wanted}


def test_odd_values_and_text_keys_are_ordered(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "FEW_ROWS", 3)
    values = [-math.inf, -1e308, -5e-324, 0.0, 5e-324, 0.25, 1.0, 7.0, 1e308, math.inf]
    rows = [(f"k{i:03d}", values[i % 10], i % 3) for i in range(300)]
    wanted = {g: list(range(1, 101, 9)) for g in range(3)}
    found = looked_up_ranks(spark, rows, "k string, v double, g int", wanted, by="g")
    for g in range(3):
        ordered = sorted((v, k) for k, v, own in rows if own == g)
        assert {r: found[g, r] for r in wanted[g]} == {r: ordered[r - 1] for r in wanted[g]}
    assert looked_up_ranks(spark, rows, "k string, v double, g int", {0: [301]}) == {}
