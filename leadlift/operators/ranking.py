"""Score ranks, deciles, the lift table and leads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlift.functions.numeric import ratio
from leadlift.operators.order_stats import at_or_before, is_ranked, keys_at_ranks, rank_rows
from leadlift.settings import KEY, LABEL, MIN_LEAD_DECILE, SCORE

DECILE = "decile"
TILES = 10


def rank_first(scored: DataFrame, score: str = SCORE, key: str = KEY, column: str = "rank", **tuning) -> DataFrame:
    """Unique ascending rank of every row by (score, key)."""
    return rank_rows(scored, score, key, column=column, **tuning)


def last_ranks(rows: int, method: str = "qcut", tiles: int = TILES) -> list[int]:
    """The highest rank inside each tile but the last.

    ``qcut`` cuts 1..n at interpolated quantiles, right-closed; ``ntile`` gives the remainder to the first tiles.
    """
    if method == "qcut":
        return [1 + (rows - 1) * t // tiles for t in range(1, tiles)]
    if method == "ntile":
        size, extra = divmod(rows, tiles)
        return [t * size + min(t, extra) for t in range(1, tiles)]
    raise ValueError(f"unknown method {method!r}; use 'qcut' or 'ntile'")


def add_deciles(
    scored: DataFrame, method: str = "qcut", score: str = SCORE, key: str = KEY, rows: int | None = None, **tuning
) -> DataFrame:
    """Add ``decile`` 1..10, 10 for the highest scores.

    Deciles only need the nine rows at the cut-offs, so those are looked up and every row is then compared with them
    in place: no global sort and no shuffle of the scored table. Reads ``scored`` more than once; pass a staged table.
    """
    total = scored.where(is_ranked(score)).count() if rows is None else rows
    if total == 0:
        return scored.withColumn(DECILE, F.lit(None).cast("int"))
    ranks = last_ranks(total, method)
    cuts = keys_at_ranks(scored, score, key, {0: ranks}, **tuning)
    decile = F.lit(1)
    for rank in ranks:
        decile = decile + F.when(at_or_before(score, key, cuts[0, rank]), 0).otherwise(1)
    return scored.withColumn(DECILE, F.when(is_ranked(score), decile).cast("int"))


def decile_table(
    with_deciles: DataFrame, label: str = LABEL, score: str = SCORE, key: str = KEY, zero_base_rate: float | None = None
) -> DataFrame:
    """Customers, responders, mean score, response rate and lift per decile, best decile first.

    One partial aggregate over the rows. The base rate comes from its (at most eleven) result rows, so the scored
    table is read once. ``zero_base_rate`` replaces a base rate of 0; without it the lift is then NULL.
    """
    per_decile = with_deciles.groupBy(DECILE).agg(
        F.count(key).alias("customers"),
        F.sum(F.col(label).cast("bigint")).alias("responders"),
        F.avg(score).alias("avg_score"),
        F.count(label).alias("_labelled"),
    )
    overall = Window.partitionBy(F.lit(1))
    base_rate = ratio(F.sum("responders").over(overall), F.sum("_labelled").over(overall))
    if zero_base_rate is not None:
        base_rate = F.when(base_rate == 0, F.lit(zero_base_rate)).otherwise(base_rate)
    return (
        per_decile.withColumn("_base_rate", base_rate)
        .withColumn("response_rate", ratio(F.col("responders"), F.col("customers")))
        .withColumn("lift_vs_avg", ratio(F.col("response_rate"), F.col("_base_rate")))
        .where(F.col(DECILE).isNotNull())
        .select(DECILE, "customers", "responders", "avg_score", "response_rate", "lift_vs_avg")
        .orderBy(F.desc(DECILE))
    )


def leads(
    with_deciles: DataFrame, min_decile: int = MIN_LEAD_DECILE, score: str = SCORE, key: str = KEY
) -> DataFrame:
    """The rows of the top deciles, best score first."""
    return with_deciles.where(F.col(DECILE) >= int(min_decile)).orderBy(F.desc(score), key)
