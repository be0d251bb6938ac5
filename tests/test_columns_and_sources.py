"""Draws, column helpers, encoders, and reading and writing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from leadlift.functions import draws
from leadlift.functions.numeric import clip, fixed, grid_step, ratio, sigmoid, threshold_label
from leadlift.operators import columns, encoding
from leadlift.sources import staging, tables
from leadlift.sources.customers import customer_table, latest_channel, read_inputs


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(40_000).withColumnRenamed("id", "k")


def moments(df, column):
    return df.select(F.avg(column.cast("double")), F.stddev_pop(column.cast("double"))).first()


@pytest.mark.parametrize(
    "column, mean, std",
    [
        (draws.uniform, 0.5, math.sqrt(1 / 12)),
        (draws.normal, 0.0, 1.0),
        (lambda k, s: draws.lognormal(k, s, 0.0, 0.5), math.exp(0.125), math.sqrt((math.exp(0.25) - 1) * math.exp(0.25))),
        (lambda k, s: draws.poisson(k, s, 18.0), 18.0, math.sqrt(18)),
        (lambda k, s: draws.poisson(k, s, 0.35), 0.35, math.sqrt(0.35)),
        (lambda k, s: draws.beta(k, s, 2.2, 4.5), 2.2 / 6.7, math.sqrt(2.2 * 4.5 / (6.7**2 * 7.7))),
        (lambda k, s: draws.int_range(k, s, 21, 75), 47.5, math.sqrt((54**2 - 1) / 12)),
        (lambda k, s: draws.bernoulli(k, s, 0.22), 0.22, math.sqrt(0.22 * 0.78)),
    ],
)
def test_draw_moments(spark, keys, column, mean, std):
    got_mean, got_std = moments(keys, column("k", "salt"))
    assert got_mean == pytest.approx(mean, abs=5 * std / 200)
    assert got_std == pytest.approx(std, rel=0.05)


def test_draws_do_not_depend_on_layout(keys):
    one = keys.repartition(1).select("k", draws.uniform("k", "x").alias("u"))
    many = keys.repartition(9).select("k", draws.uniform("k", "x").alias("u"))
    assert one.join(many.withColumnRenamed("u", "v"), "k").where("u != v").count() == 0


def test_choices(keys):
    weights = {"branch": 0.18, "app": 0.44, "web": 0.30, "call_center": 0.08}
    rows = keys.groupBy(draws.weighted_choice("k", "w", weights).alias("c")).count().collect()
    assert {r["c"]: r["count"] / 40_000 for r in rows} == {k: pytest.approx(v, abs=0.01) for k, v in weights.items()}
    rows = keys.groupBy(draws.choice("k", "c", ["n", "s"]).alias("c")).count().collect()
    assert {r["c"] for r in rows} == {"n", "s"}


def test_numeric_helpers(spark):
    df = spark.createDataFrame([(0.0, 2.5, 0)], "zero double, x double, none int")
    row = df.select(
        sigmoid(F.col("zero")), clip(F.col("x"), 0.0, 1.0), fixed(F.col("x"), 0),
        ratio(F.col("x"), F.col("none")), ratio(F.col("x"), F.col("none"), 0.0),
    ).first()
    assert tuple(row) == (0.5, 1.0, 3.0, None, 0.0)
    assert threshold_label("run", 0.30) == "run@0.3"
    assert [i * grid_step(101) for i in range(100)] == np.linspace(0, 1, 101)[:-1].tolist()


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, "e", "p", 3, "r", 1)], "customer_id int, email string, phone string, b int, region string, applied_cc int")
    assert columns.feature_columns(df) == ["b", "region"]
    assert columns.present(df, ["channel", "region"]) == ["region"]
    assert columns.present(df, None) == []
    assert columns.restrict_features(df, ["region", "gone"]).columns == ["customer_id", "email", "phone", "applied_cc", "region"]
    trials = spark.createDataFrame([(1, 0.5, 3, 9)], "trial int, valid_auc double, param_depth int, other int")
    assert columns.trial_columns(trials) == ["trial", "valid_auc", "param_depth"]


def test_categories_become_strings(spark):
    df = spark.createDataFrame([(None, 1), ("x", None)], "region string, channel int")
    assert sorted(map(tuple, columns.normalise_categories(df).collect())) == [("NA", "1"), ("x", "NA")]


def test_unseen_categories(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "region string")
    other = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "region string")
    slots = {r[0]: r[1] for r in encoding.one_hot_encoded(other, train, ["region"]).collect()}
    assert slots == {"a": [1, 0], "b": [0, 1], "z": [0, 0], None: [0, 0]}
    numbers = {r[0]: r[1] for r in encoding.string_indexed(other, train, ["region"]).collect()}
    assert numbers == {"b": 0.0, "a": 1.0, "z": 2.0, None: 2.0}


def test_population_scaling(spark):
    values = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "a double, flat double")
    got = sorted(tuple(r) for r in encoding.standard_scaled(df, df, ["a", "flat"]).collect())
    expected = [((v - np.mean(values)) / np.std(values), 0.0) for v in values]
    assert np.array(got) == pytest.approx(np.array(expected))


def test_rows_to_table_types_missing_values(spark):
    schema = StructType([StructField("label", StringType()), StructField("auc", DoubleType()), StructField("n", IntegerType())])
    table = tables.rows_to_table(spark, [{"label": "a"}, {"label": "b", "n": 2}], schema)
    assert table.schema == schema
    assert sorted(map(tuple, table.collect())) == [("a", None, None), ("b", None, 2)]


def test_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "x,y", 0.5), (2, None, None)], "id bigint, t string, v double")
    path = tables.write_csv(df, str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    assert sorted(tables.read_csv(spark, path, df.schema).collect()) == sorted(df.collect())
    path = tables.write_parquet(df, str(tmp_path / "pq"))
    tables.write_parquet(df, path)
    assert sorted(tables.read_parquet(spark, path).collect()) == sorted(df.collect())


def test_staged_tables(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "id int, part string, v double")
    staged = staging.stage(df, "t", ["part"])
    assert staged.columns == df.columns and sorted(staged.collect()) == sorted(df.collect())
    plan = staged.where("part = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    assert f"{staging.shared_folder(spark)}/leadlift/" in staged.inputFiles()[0]


def test_shared_folder_comes_from_the_session(spark, tmp_path, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return {"spark.checkpoint.dir": "hdfs://name/shared/"}.get(name, default)

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    assert staging.shared_folder(Session()) == "hdfs://name/shared"
    monkeypatch.setattr(Conf, "get", lambda self, name, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_no_customer_is_lost(spark, small):
    inputs = read_inputs(spark, small)
    no_history = {n: inputs[n].limit(0) for n in ("orders", "lineitem", "events", "region")}
    table = customer_table(**{**inputs, **no_history})
    assert table.count() == inputs["customer"].count()
    row = table.select("tenure_months", "txn_count_3m", "avg_txn_amount_3m", "utilization_rate", "channel", "region").distinct().collect()
    assert [tuple(r) for r in row] == [(0, 0, 1.0, 0.01, "NA", None)]


def test_as_of_day(spark, small):
    inputs = read_inputs(spark, small)
    newest = inputs["orders"].agg(F.max("o_orderdate").cast("date").cast("string")).first()[0]
    fixed_day = customer_table(**inputs, as_of=F.lit(newest).cast("date"))
    # all events are later than the newest order: on its day no channel is known yet
    assert sorted(fixed_day.drop("channel").collect()) == sorted(customer_table(**inputs).drop("channel").collect())
    assert {r[0] for r in fixed_day.select("channel").distinct().collect()} == {"NA"}
    years_later = customer_table(**inputs, as_of=F.date_add(F.lit(newest).cast("date"), 3000))
    assert years_later.agg(F.max("txn_count_3m")).first()[0] == 0


def test_newest_event_wins(spark):
    rows = [(1, "2020-01-01", 7, "view"), (2, "2020-01-02", 7, "click"), (3, "2020-01-02", 7, "buy"), (4, "2019-01-01", 8, "view")]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert {r[0]: r[1] for r in latest_channel(events).collect()} == {7: "buy", 8: "view"}


def test_newest_event_needs_no_sort_aggregate(spark, small):
    from leadlift.sources.customers import load_customers

    plan = load_customers(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_newest_event_of_odd_rows(spark):
    from leadlift.sources.customers import latest_channel

    rows = [
        (1, "2001-01-01 00:00:00", 5, "a"),
        (1, "2001-01-01 00:00:00", 6, "b"),
        (1, "1950-01-01 00:00:00", 9, "c"),
        (2, "1960-01-01 00:00:00", 1, "old"),
        (2, "1960-01-01 00:00:01", 0, "new"),
        (3, None, 7, "undated"),
        (4, None, 7, "x"),
        (4, "1900-01-01 00:00:00", 1, "dated"),
    ]
    events = spark.createDataFrame(rows, "user_id bigint, ts string, event_id bigint, event_type string")
    got = latest_channel(events.withColumn("ts", F.col("ts").cast("timestamp"))).collect()
    assert {r["user_id"]: r["channel"] for r in got} == {1: "b", 2: "new", 3: "undated", 4: "dated"}


def test_beta_table_is_the_integral_of_the_density():
    import numpy as np

    from leadlift.functions.draws import BETA_STEPS, beta_quantiles

    a, b = 2.2, 4.5
    nodes, weights = np.polynomial.legendre.leggauss(80)

    def integral(upper):
        # x = upper * t^2 makes the density smooth at zero
        t = (nodes + 1) / 2
        x = upper * t**2
        return float((weights / 2 * 2 * upper * t * x ** (a - 1) * (1 - x) ** (b - 1)).sum())

    whole, table = integral(1.0), beta_quantiles(a, b)
    for step in range(1, BETA_STEPS, 37):
        assert abs(integral(table[step]) / whole - step / BETA_STEPS) < 1e-6


def test_nothing_after_the_day_counts(spark):
    from datetime import date

    from leadlift.sources.customers import order_history, order_history_on

    orders = spark.createDataFrame(
        [
            (1, 7, "O", 10.0, "2020-01-20"),
            (2, 7, "P", 1000.0, "2021-01-01"),
            (3, 7, "P", 5.0, "2019-12-01"),
            (4, 8, "P", 2.0, "2020-03-01"),
            (5, 8, "P", 2.0, None),
        ],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, day string",
    ).withColumn("o_orderdate", F.col("day").cast("timestamp"))
    lineitem = spark.createDataFrame([(1, "R"), (2, "R"), (2, "N"), (3, "N")], "l_orderkey bigint, l_returnflag string")
    day = date(2020, 2, 1)
    names = ["o_custkey", "first_order_age", "recent_orders", "recent_cents", "late_orders", "lines", "returned_lines"]
    expected = [(7, 62, 2, 1500, 1, 2, 1)]
    assert [tuple(r) for r in order_history(orders, lineitem, F.lit(day)).select(*names).collect()] == expected
    days = [day, date(2020, 1, 31), date(2020, 3, 1), date(2022, 1, 1), day]
    found = order_history_on(orders, lineitem, days)
    for d in sorted(set(days)):
        one = sorted(map(tuple, order_history(orders.where("o_orderdate is not null"), lineitem, F.lit(d)).select(*names).collect()))
        assert sorted(map(tuple, found.where(F.col("as_of") == d).select(*names).collect())) == one
    assert order_history_on(orders.limit(0), lineitem, days).count() == 0

    events = spark.createDataFrame(
        [(1, 7, "2020-01-31 23:00:00", "view"), (2, 7, "2020-02-02 00:00:00", "buy"), (3, 9, None, "view")],
        "event_id bigint, user_id bigint, at string, event_type string",
    ).withColumn("ts", F.col("at").cast("timestamp"))
    assert [tuple(r) for r in latest_channel(events, F.lit(day)).collect()] == [(7, "view")]
