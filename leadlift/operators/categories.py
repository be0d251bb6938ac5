"""Category dictionaries and target statistics as tables: no category ever reaches the driver.

A dictionary has one row per column and category. Its numbers are dense ranks over range buckets, so a column may have
any number of categories. Values are looked up by joins: the ``HOT`` most frequent categories of a column are few enough
to broadcast whatever the table's size; rows that have one of them, or none, are spread over all tasks of the join
with the remaining categories, whose rows Spark moves only if the staged dictionary is too large to broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlift.functions import draws
from leadlift.operators.labels import DRAW_KEY, with_draw_key
from leadlift.operators.order_stats import BUCKET, ROWS_PER_BUCKET, in_buckets
from leadlift.settings import KEY, LABEL
from leadlift.sources.staging import scope, stage

HOT = 1000
PRIOR = 0.5
WEIGHT = 1.0


def long_categories(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """(feature, category, ..) for every row and column, category as a string."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("category")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("_pair"), *more).select("_pair.feature", "_pair.category", *more)


def dictionaries(
    train: DataFrame, columns: list[str], by_frequency: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """(feature, category, n, number): numbers from 0 per column, most frequent first (ties by category) or by category.

    Categories compare as UTF-8 bytes; nulls are none. The result is staged.
    """
    with scope(train.sparkSession):
        present = long_categories(train, columns).where("category is not null")
        counts = stage(present.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n")), "categories")
        order = [F.desc("n"), F.asc("category")] if by_frequency else [F.asc("category")]
        tagged = in_buckets(counts, [F.col("feature"), *order], rows_per_bucket)
        sizes = tagged.groupBy("feature", BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
        earlier = Window.partitionBy("feature").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("feature", BUCKET, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
        inside = F.row_number().over(Window.partitionBy("feature", BUCKET).orderBy(*order))
        numbered = tagged.withColumn("_place", inside).join(offsets, ["feature", BUCKET])
        number = (F.col("_before") + F.col("_place") - 1).alias("number")
        return stage(numbered.select("feature", "category", "n", number), "dictionaries", keep=True)


def looked_up(df: DataFrame, table: DataFrame, column: str, values: dict[str, Column]) -> DataFrame:
    """``df`` with ``values`` of the row of ``table(feature, category, n, ..)`` for its category; null where none is.

    ``values`` maps new names to columns of ``table``. Every row of ``df`` stays once.
    """
    fields = F.struct(*[value.alias(name) for name, value in values.items()])
    own = table.where(F.col("feature") == column).select("category", "n", fields.alias("_values"))
    most = [F.desc("n"), F.asc("category")]
    hot = own.orderBy(*most).limit(HOT).select(F.col("category").alias("_hot"), F.col("_values").alias("_hot_values"))
    category = F.col(f"`{column}`").cast("string")
    marked = df.join(F.broadcast(hot), category == F.col("_hot"), "left")
    # what needs no second look gets a place of its own in that join instead of its category's
    settled = F.col("_hot").isNotNull() | category.isNull()
    marked = marked.withColumn("_spread", F.when(settled, F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    marked = marked.withColumn("_asked", F.when(~settled, category).otherwise(F.lit("")))
    rest = own.select(
        F.col("category").alias("_asked"), F.lit(-1).cast("bigint").alias("_spread"), F.col("_values").alias("_rest_values")
    )
    both = marked.join(rest, ["_asked", "_spread"], "left")
    found = F.coalesce("_hot_values", "_rest_values")
    return both.select(*[F.col(f"`{c}`") for c in df.columns], *[found[name].alias(name) for name in values])


def sizes(table: DataFrame, column: str) -> Column:
    """How many categories a dictionary holds for ``column``, as a scalar."""
    return table.where(F.col("feature") == column).select(F.count(F.lit(1))).scalar()


def ordered_target_statistics(
    train: DataFrame,
    columns: list[str],
    key: str = KEY,
    label: str = LABEL,
    salt: str = "target",
    prior: float = PRIOR,
    weight: float = WEIGHT,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``train`` plus ``<column>__target``: the smoothed share of positives among rows of the same category that come
    earlier in the order of keyed draws (ties by key). So no row's own label takes part in its value.

    The share is ``(positives + weight * prior) / (rows + weight)``; the first row of a category gets the prior. A null
    is a category of its own; a null label counts as a row without a positive. The draws are cut into ranges, with
    exact totals per category and range, so a category that most rows have is no single window. ``key`` must be unique.
    """
    rows = train.count()
    ranges = max(1, math.ceil(rows / rows_per_bucket), int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = with_draw_key(train, key).withColumn("_draw", draws.uniform(DRAW_KEY, salt)).drop(DRAW_KEY)
    out = drawn.withColumn("_range", F.floor(F.col("_draw") * F.lit(float(ranges))).cast("int"))
    positive = F.coalesce(F.col(f"`{label}`").cast("bigint"), F.lit(0).cast("bigint"))
    for c in columns:
        own = f"`{c}`"
        totals = out.groupBy(F.col(own).alias("_category"), F.col("_range").alias("_of")).agg(
            F.count(F.lit(1)).alias("_rows"), F.sum(positive).alias("_ones")
        )
        earlier = Window.partitionBy("_category").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
        before = totals.select(
            "_category",
            "_of",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_ones").over(earlier), F.lit(0)).alias("_ones_before"),
        )
        inside = Window.partitionBy(own, "_range").orderBy("_draw", F.col(f"`{key}`")).rowsBetween(Window.unboundedPreceding, -1)
        counted = out.withColumn("_rows_here", F.count(F.lit(1)).over(inside)).withColumn(
            "_ones_here", F.coalesce(F.sum(positive).over(inside), F.lit(0))
        )
        both = counted.join(before, F.col(own).eqNullSafe(F.col("_category")) & (F.col("_range") == F.col("_of")))
        share = smoothed(F.col("_ones_before") + F.col("_ones_here"), F.col("_rows_before") + F.col("_rows_here"), prior, weight)
        out = both.select(*[F.col(f"`{name}`") for name in out.columns], share.alias(target_name(c)))
    return out.drop("_draw", "_range")


def target_totals(train: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    """(feature, category, n, positives) over all training rows, staged; for rows that are no training rows."""
    pairs = long_categories(train.withColumn("_label", F.col(f"`{label}`")), columns, "_label")
    ones = F.sum(F.coalesce(F.col("_label").cast("bigint"), F.lit(0).cast("bigint"))).alias("positives")
    return stage(pairs.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"), ones), "target_totals")


def with_target_totals(
    df: DataFrame, totals: DataFrame, columns: list[str], prior: float = PRIOR, weight: float = WEIGHT
) -> DataFrame:
    """``df`` plus ``<column>__target`` from the totals of all training rows; the prior for unseen categories.

    A null takes the value of the training rows without a category, if there are any.
    """
    share = smoothed(F.col("positives"), F.col("n"), prior, weight)
    for c in columns:
        # one row at most
        missing = totals.where((F.col("feature") == c) & F.col("category").isNull()).select(share).scalar()
        df = looked_up(df, totals.where("category is not null"), c, {target_name(c): share})
        of_missing = F.when(F.col(f"`{c}`").isNull(), missing)
        df = df.withColumn(target_name(c), F.coalesce(target_name(c), of_missing, F.lit(float(prior))))
    return df


def smoothed(positives: Column, rows: Column, prior: float, weight: float) -> Column:
    return (positives + F.lit(float(prior * weight))) / (rows + F.lit(float(weight)))


def target_name(column: str) -> str:
    return f"{column}__target"
