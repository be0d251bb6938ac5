"""Dictionaries and target statistics against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from leadlift.operators import categories

SCHEMA = "customer_id bigint, city string, applied_cc int"


def rows_of(n=1000, seed=1):
    """A third of the rows has one city; nulls, rare cities and null labels among the rest."""
    rng = random.Random(seed)
    cities = [None, "", "Ünye", "b", "B", "hot", *(f"c{i}" for i in range(40))]
    return [
        (100000 + i, "hot" if i % 3 == 0 else rng.choice(cities), rng.choice([0, 1, 1, None])) for i in range(n)
    ]


@pytest.mark.parametrize("by_frequency", [True, False])
@pytest.mark.parametrize("hot", [1, 1000])
def test_dictionary_and_look_up(spark, monkeypatch, by_frequency, hot):
    monkeypatch.setattr(categories, "HOT", hot)
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    table = categories.dictionaries(df, ["city", "applied_cc"], by_frequency, rows_per_bucket=7)
    for column, at in (("city", 1), ("applied_cc", 2)):
        counts = {}
        for row in rows:
            if row[at] is not None:
                counts[str(row[at])] = counts.get(str(row[at]), 0) + 1
        order = sorted(counts, key=lambda c: (-counts[c] if by_frequency else 0, c.encode()))
        found = {r["category"]: (r["n"], r["number"]) for r in table.where(F.col("feature") == column).collect()}
        assert found == {c: (counts[c], i) for i, c in enumerate(order)}
    others = spark.createDataFrame([*rows, (1, "never", 0), (1, "never", 0)], SCHEMA)
    got = categories.looked_up(others, table, "city", {"number": F.col("number")})
    numbers = {r["category"]: r["number"] for r in table.where("feature = 'city'").collect()}
    expected = [(*row, numbers.get(row[1])) for row in [*rows, (1, "never", 0), (1, "never", 0)]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_many_categories_stay_off_the_driver(spark):
    df = spark.range(200_000).select(F.concat(F.lit("v"), "id").alias("city"))
    table = categories.dictionaries(df, ["city"], rows_per_bucket=20_000)
    row = table.agg(F.count_distinct("number"), F.min("number"), F.max("number")).first()
    assert tuple(row) == (200_000, 0, 199_999)
    numbered = categories.looked_up(df, table, "city", {"number": F.col("number")})
    assert numbered.where("number is null").count() == 0 and numbered.count() == 200_000


@pytest.mark.parametrize("rows_per_bucket", [30, 10_000])
def test_ordered_statistics_match_plain_prefix_sums(spark, rows_per_bucket):
    from leadlift.functions import draws

    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = categories.ordered_target_statistics(df, ["city"], rows_per_bucket=rows_per_bucket)
    found = {r["customer_id"]: r["city__target"] for r in got.collect()}
    keyed = df.withColumn("_k", F.col("customer_id") - 100000).withColumn("u", draws.uniform("_k", "target"))
    seen, expected = {}, {}
    for row in sorted(keyed.collect(), key=lambda r: (r["u"], r["customer_id"])):
        n, ones = seen.get(row["city"], (0, 0))
        expected[row["customer_id"]] = (ones + 0.5) / (n + 1)
        seen[row["city"]] = (n + 1, ones + (row["applied_cc"] or 0))
    assert found == pytest.approx(expected)
    assert got.columns == [*df.columns, "city__target"]


def test_own_label_does_not_count(spark):
    """Turning one row's label changes no value of that row."""
    rows = rows_of(300)
    turned = [(k, c, 1 - (y or 0)) if k == 100007 else (k, c, y) for k, c, y in rows]
    value = [
        categories.ordered_target_statistics(spark.createDataFrame(r, SCHEMA), ["city"])
        .where("customer_id = 100007")
        .first()["city__target"]
        for r in (rows, turned)
    ]
    assert value[0] == value[1]


def test_totals_for_other_rows(spark):
    rows = rows_of()
    totals = categories.target_totals(spark.createDataFrame(rows, SCHEMA), ["city"])
    others = spark.createDataFrame([(1, "hot"), (2, None), (3, "never"), (4, "hot")], "customer_id bigint, city string")
    got = {r[0]: r["city__target"] for r in categories.with_target_totals(others, totals, ["city"]).collect()}

    def share(city):
        own = [y or 0 for _, c, y in rows if c == city]
        return (sum(own) + 0.5) / (len(own) + 1)

    assert got == pytest.approx({1: share("hot"), 2: share(None), 3: 0.5, 4: share("hot")})


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert categories.dictionaries(none, ["city"]).count() == 0
    assert categories.ordered_target_statistics(none, ["city"]).count() == 0
    totals = categories.target_totals(none, ["city"])
    other = spark.createDataFrame([(1, "a", 0)], SCHEMA)
    assert categories.with_target_totals(other, totals, ["city"]).first()["city__target"] == 0.5
