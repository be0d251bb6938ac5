"""The next row of a table in descending order of an integer key, without a global sort.

Keys fall into blocks of ``WIDTH`` consecutive values, so a block has at most that many keys, whatever the table. Within
a block the next row is a window away. For the last row of a block it is the head (largest key) of the next block that
has any; those are found the same way among the blocks' numbers, level by level. Each such head row is then copied into
the block before it, so that one window gives every row its successor with all its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlift.sources.staging import stage

BITS = 10
WIDTH = 1 << BITS


def lower_heads(heads: DataFrame, levels: int) -> DataFrame:
    """(number, lower): for each ``heads(number, head)`` the head of the next lower number, null for the lowest."""
    group = F.shiftright("number", BITS)
    inside = heads.withColumn("group", group if levels else F.lit(0).cast("bigint"))
    w = Window.partitionBy("group").orderBy(F.desc("number"))
    inside = inside.withColumn("lower", F.lead("head").over(w))
    if not levels:
        return inside.select("number", "lower")
    above = lower_heads(
        inside.groupBy("group").agg(F.max_by("head", "number").alias("head")).withColumnRenamed("group", "number"),
        levels - 1,
    )
    above = above.select(F.col("number").alias("group"), F.col("lower").alias("_above"))
    return inside.join(above, "group", "left").select("number", F.coalesce("lower", "_above").alias("lower"))


def with_successor(rows: DataFrame, key: str, ties: list[Column], wanted: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each of ``wanted``, that expression of the row that follows in descending ``key`` order.

    Rows with equal keys follow one another by ``ties``. After the last row comes the first. A row with a null key has
    no place in the order: what it wants is null, and no row has it as a successor.
    """
    spark = rows.sparkSession
    keys = rows.select(F.col(key).alias("_key")).where("_key is not null")
    low, high = keys.agg(F.min("_key"), F.max("_key")).first()
    block = F.shiftright(F.col(key), BITS)
    if low is None:
        table = spark.createDataFrame([], "_key bigint, _before bigint")
    else:
        # levels until one group can hold all numbers
        levels, first, last = 0, low // WIDTH, high // WIDTH
        while last - first >= WIDTH:
            levels, first, last = levels + 1, first // WIDTH, last // WIDTH
        heads = keys.groupBy(F.shiftright("_key", BITS).alias("number")).agg(F.max("_key").alias("head"))
        lower = lower_heads(heads, levels)
        table = lower.select(F.coalesce("lower", F.lit(high).cast("bigint")).alias("_key"), F.col("number").alias("_before"))
    # written first: its size is then known, and a join with it needs no shuffle of the texts while it is small
    table = stage(table, "heads")
    joined = rows.join(table, rows[key] == table["_key"], "left").drop("_key")
    own = F.struct(F.when(F.col(key).isNotNull(), block).alias("block"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("_before").alias("block"), F.lit(True).alias("copy"))
    places = F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, copy))
    placed = joined.withColumn("_place", F.explode(places)).select(
        *rows.columns, F.col("_place.block").alias("_block"), F.col("_place.copy").alias("_copy")
    )
    # rows without a key are spread over windows of their own
    spread = F.when(F.col("_block").isNull(), F.xxhash64(*[F.col(c) for c in rows.columns if c != key])).otherwise(0)
    w = Window.partitionBy("_block", "_spread").orderBy("_copy", F.desc(key), *ties)
    next_row = F.lead(F.struct(*(e.alias(n) for n, e in wanted.items()))).over(w)
    following = placed.withColumn("_spread", spread).withColumn("_next", next_row)
    return following.where(~F.col("_copy")).select(
        *rows.columns, *(F.when(F.col(key).isNotNull(), F.col(f"_next.{n}")).alias(n) for n in wanted)
    )
