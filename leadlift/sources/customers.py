"""The customer feature table, derived from customers, orders, line items and events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import WindowSpec

from leadlift.functions import draws
from leadlift.functions.numeric import clip
from leadlift.sources.tables import read_parquet

INPUTS = ["region", "nation", "customer", "orders", "lineitem", "events"]
FIRST_MICROS = 62_135_596_800_000_000  # from year 1 to 1970: makes every timestamp a positive number
_schemas: dict[tuple[str, str], StructType] = {}


def read_input(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An input table. Inputs do not change while an application runs, so each schema is looked up only once."""
    path = f"{folder}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _schemas:
        _schemas[known] = read_parquet(spark, path).schema
    return spark.read.schema(_schemas[known]).parquet(path)


def read_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_input(spark, folder, name) for name in INPUTS}


def load_customers(spark: SparkSession, folder: str) -> DataFrame:
    return customer_table(**read_inputs(spark, folder))


def customer_table(
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    events: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per customer with ids, the 13 features, and contact columns; with ``as_of`` nothing after that day counts.

    All joins are left joins from ``customer``, so no customer is lost, and each right side is unique on its key:
    Catalyst drops the joins whose columns a caller does not use. Nothing is hinted: Catalyst and AQE broadcast the
    nation and region sides from their measured size, and fall back to a shuffle join above the limit.
    """
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        "n_nationkey", F.lower("r_name").alias("region")
    )
    returned_share = F.coalesce(F.try_divide(F.col("returned_lines"), F.col("lines")), F.lit(0.0))
    # mean of o_totalprice / 1000 to two digits, in exact integer cents
    spend = F.floor(F.try_divide(F.col("recent_cents"), F.lit(1000.0) * F.col("recent_orders")) + 0.5) / 100
    months = F.floor(F.col("first_order_age") / 30)

    joined = (
        own_columns(customer)
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(order_history(orders, lineitem, as_of), F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(latest_channel(events, as_of), F.col("c_custkey") == F.col("user_id"), "left")
    )
    return joined.select(
        "customer_id",
        "age",
        "annual_income",
        "credit_score",
        clip(returned_share, 0.01, 0.99).alias("utilization_rate"),
        F.coalesce(months, F.lit(0)).cast("int").alias("tenure_months"),
        F.least(F.coalesce(F.col("recent_orders"), F.lit(0)), F.lit(120)).cast("int").alias("txn_count_3m"),
        clip(F.coalesce(spend, F.lit(0.0)), 1.0, 600.0).alias("avg_txn_amount_3m"),
        F.least(F.coalesce(F.col("late_orders"), F.lit(0)), F.lit(10)).cast("int").alias("late_payments_12m"),
        "savings_balance",
        "region",
        "is_premium",
        "has_mortgage",
        F.coalesce(F.col("channel"), F.lit("NA")).alias("channel"),
        "email",
        "phone",
    )


def own_columns(customer: DataFrame) -> DataFrame:
    """The columns that need the customer row alone.

    They are computed in the scan's stage, ahead of the shuffle joins: together with the joined columns and the label
    they would make one generated method longer than the JVM is willing to compile.
    """
    income = 65000 + F.lit(22000.0) * (F.col("c_acctbal") - 4500) / 3175
    number = (F.col("c_custkey") + 100000).cast("bigint")
    area = draws.int_range("c_custkey", "area", 100, 999)
    suffix = draws.int_range("c_custkey", "suffix", 1000, 9999)
    # fixed values: the formats of email and phone
    return customer.select(
        "c_custkey",
        "c_nationkey",
        number.alias("customer_id"),
        draws.int_range("c_custkey", "age", 21, 75).alias("age"),
        F.round(clip(income, 15000.0, 250000.0)).alias("annual_income"),
        F.round(clip(draws.normal("c_custkey", "credit", 690, 55), 450.0, 850.0)).alias("credit_score"),
        F.round(clip(F.col("c_acctbal"), 0.0, 250000.0)).alias("savings_balance"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("is_premium"),
        draws.bernoulli("c_custkey", "mortgage", 0.45).alias("has_mortgage"),
        F.concat(F.lit("cust"), number.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(
            F.lit("+1-555-"),
            F.lpad(area.cast("string"), 3, "0"),
            F.lit("-"),
            F.lpad(suffix.cast("string"), 4, "0"),
        ).alias("phone"),
    )


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Line items and returned ones per order."""
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("order_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("order_returned"),
    )


def order_history(orders: DataFrame, lineitem: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Order and line-item aggregates per customer, as of a day: by default that of the newest order.

    Orders after the day count for nothing, nor do their line items. Line items shrink to two counts per order before
    they meet the orders, so the big table crosses the network as partial counts, already partitioned on the join key; a
    second partial aggregate keyed by customer follows. Both aggregates combine on the map side, so one customer or
    order holding a third of the rows stays a few rows per task.
    """
    day = orders.select(F.max("o_orderdate")).scalar() if as_of is None else as_of
    age = F.col("order_age")
    aged = orders.withColumn("order_age", F.datediff(day, F.col("o_orderdate")))
    known = aged if as_of is None else aged.where(age >= 0)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (
        known.join(order_lines(lineitem), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey")
        .agg(
            F.max(age).alias("first_order_age"),
            F.count_if(age < 90).alias("recent_orders"),
            F.sum(F.when(age < 90, cents)).alias("recent_cents"),
            F.count_if((age < 365) & (F.col("o_orderstatus") == "P")).alias("late_orders"),
            F.sum("order_lines").alias("lines"),
            F.sum("order_returned").alias("returned_lines"),
        )
    )


def order_history_on(orders: DataFrame, lineitem: DataFrame, days: Sequence[date]) -> DataFrame:
    """``order_history`` as of each of ``days``, in one pass: o_custkey, as_of, and the same aggregates.

    Orders shrink to one row per customer and day. The asked days join them as rows of their own, and sums over the days
    before, over ranges of days, are read there. A customer has at most as many rows as there are days, however many
    orders. Customers have a row for a day once they have an order; orders without a date count for nothing.
    """
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    per_day = (
        orders.where("o_orderdate is not null")
        .join(order_lines(lineitem), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey", F.unix_date(F.to_date("o_orderdate")).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(cents).alias("cents"),
            F.count_if(F.col("o_orderstatus") == "P").alias("late"),
            F.sum("order_lines").alias("lines"),
            F.sum("order_returned").alias("returned"),
        )
    )
    amounts = ["orders", "cents", "late", "lines", "returned"]
    asked = F.explode(F.array(*[F.lit(d.toordinal() - date(1970, 1, 1).toordinal()) for d in sorted(set(days))]))
    nothing = [F.lit(None).cast("bigint").alias(a) for a in amounts]
    questions = per_day.select("o_custkey").distinct().select("o_custkey", asked.alias("day"), *nothing, F.lit(True).alias("asked"))
    both = per_day.select("o_custkey", "day", *amounts, F.lit(False).alias("asked")).unionByName(questions)

    def within(last: int | None) -> WindowSpec:
        start = Window.unboundedPreceding if last is None else 1 - last
        return Window.partitionBy("o_custkey").orderBy("day").rangeBetween(start, Window.currentRow)

    first = F.min(F.when(F.col("orders") > 0, F.col("day"))).over(within(None))
    told = both.select(
        "o_custkey",
        "asked",
        F.date_from_unix_date("day").alias("as_of"),
        (F.col("day") - first).alias("first_order_age"),
        F.coalesce(F.sum("orders").over(within(90)), F.lit(0)).alias("recent_orders"),
        F.sum("cents").over(within(90)).alias("recent_cents"),
        F.coalesce(F.sum("late").over(within(365)), F.lit(0)).alias("late_orders"),
        F.sum("lines").over(within(None)).alias("lines"),
        F.sum("returned").over(within(None)).alias("returned_lines"),
    )
    return told.where("asked and first_order_age is not null").drop("asked")


def latest_channel(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The type of each user's newest event up to the day ``as_of``, the larger event id among events of one time.

    Time and id are packed in one fixed-width number, so the large table shrinks to one row per user and type in a
    hash aggregate; what is then ordered per user is as many rows as there are types. Events without a time come
    first; with a day they do not count, as nothing says that they came before it. Of equal events the type that comes
    first in the alphabet counts.
    """
    if as_of is not None:
        events = events.where(F.datediff(as_of, F.col("ts")) >= 0)
    packed = F.expr(
        f"CAST(coalesce(unix_micros(CAST(ts AS TIMESTAMP)) + {FIRST_MICROS}L, 0L) AS DECIMAL(18, 0))"
        " * 10000000000000000000BD + CAST(coalesce(event_id, 0L) AS DECIMAL(19, 0))"
    )
    per_type = events.groupBy("user_id", "event_type").agg(F.max(packed).alias("_newest"))
    newest_first = Window.partitionBy("user_id").orderBy(F.desc("_newest"), "event_type")
    first = per_type.withColumn("_place", F.row_number().over(newest_first)).where("_place = 1")
    return first.select("user_id", F.col("event_type").alias("channel"))
