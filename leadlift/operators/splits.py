"""Train / valid / test splits that stay the same on every run and file layout."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.functions import draws
from leadlift.operators.labels import DRAW_KEY, with_draw_key
from leadlift.operators.order_stats import at_or_before, group_counts, keys_at_ranks
from leadlift.settings import KEY, LABEL, TEST_SHARE, VALID_SHARE

SPLIT = "split"


def held_out_sizes(counts: dict, share: float) -> dict:
    """Held-out rows per class: ceil(share * n) in total, the rest spread over the classes by largest remainder."""
    total = sum(counts.values())
    kept = total - math.ceil(share * total)
    sizes = {c: counts[c] * kept // total for c in counts} if total else {}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * kept % total), c)) if total else []
    for c in by_remainder[: kept - sum(sizes.values())]:
        sizes[c] += 1
    return {c: counts[c] - sizes[c] for c in sizes}


def held_out_condition(
    df: DataFrame, share: float, salt: str, label: str, key: str, counts: dict | None = None, **tuning
) -> Column:
    """Which rows of ``df`` a stratified split holds out, as a condition on the draw and the key.

    Finds, per class, the draw at the class's cut-off rank; telling the rows apart is then a comparison in place,
    with no shuffle of the rows themselves. ``counts`` (rows per class) saves a pass where they are known.
    """
    counts = group_counts(df, label) if counts is None else counts
    draw = draw_column(salt)
    drawn = with_draw(df, salt, key).select(label, key, draw)
    sizes = {c: n for c, n in held_out_sizes(counts, share).items() if n > 0}
    cuts = keys_at_ranks(drawn, draw, key, {c: [n] for c, n in sizes.items()}, by=label, **tuning)
    condition = F.lit(False)
    for (group, _), cut in sorted(cuts.items()):
        condition = condition | ((F.col(label) == F.lit(group)) & at_or_before(draw, key, cut))
    return condition


def draw_column(salt: str) -> str:
    return f"_draw_{salt}"


def with_draw(df: DataFrame, salt: str, key: str = KEY) -> DataFrame:
    """Add the keyed draw that a split sorts by, unless the table brings it along."""
    name = draw_column(salt)
    if name in df.columns:
        return df
    return with_draw_key(df, key).withColumn(name, draws.uniform(DRAW_KEY, salt)).drop(DRAW_KEY)


def add_stratified_split(
    df: DataFrame,
    share: float = TEST_SHARE,
    salt: str = "split",
    held_out: str = "test",
    rest: str = "train",
    label: str = LABEL,
    key: str = KEY,
    counts: dict | None = None,
    **tuning,
) -> DataFrame:
    """Add ``split``: exact class shares, chosen by keyed draws. Reads ``df`` more than once; pass a staged table."""
    condition = held_out_condition(df, share, salt, label, key, counts, **tuning)
    chosen = F.when(condition, held_out).otherwise(rest)
    return with_draw(df, salt, key).withColumn(SPLIT, chosen).drop(draw_column(salt))


def add_valid_split(
    df: DataFrame,
    share: float = VALID_SHARE,
    salt: str = "valid",
    label: str = LABEL,
    key: str = KEY,
    counts: dict | None = None,
    **tuning,
) -> DataFrame:
    """Move a stratified share of the ``train`` rows to ``valid``. The split column is carried from here on, so
    restricting the features later cannot change which rows are in which part."""
    train = part(df, "train")
    condition = held_out_condition(train, share, salt, label, key, counts, **tuning)
    moved = F.when((F.col(SPLIT) == "train") & condition, "valid").otherwise(F.col(SPLIT))
    return with_draw(df, salt, key).withColumn(SPLIT, moved).drop(draw_column(salt))


def add_three_way_split(
    df: DataFrame,
    test_share: float = TEST_SHARE,
    valid_share: float = VALID_SHARE,
    label: str = LABEL,
    key: str = KEY,
    **tuning,
) -> DataFrame:
    """``test``, then ``valid`` out of the rest; the classes are counted once for both.

    Stage ``df`` with the draws of both salts (``with_draw``) to have them computed only once.
    """
    counts = group_counts(df, label)
    held_out = held_out_sizes(counts, test_share)
    rest = {c: counts[c] - held_out[c] for c in counts}
    split = add_stratified_split(df, test_share, label=label, key=key, counts=counts, **tuning)
    return add_valid_split(split, valid_share, label=label, key=key, counts=rest, **tuning)


def add_bernoulli_split(
    df: DataFrame,
    share: float = TEST_SHARE,
    salt: str = "split",
    held_out: str = "test",
    rest: str = "train",
    key: str = KEY,
) -> DataFrame:
    """Unstratified split by a keyed draw: map-only, shares hold on average."""
    chosen = F.when(F.col(draw_column(salt)) < share, held_out).otherwise(rest)
    return with_draw(df, salt, key).withColumn(SPLIT, chosen).drop(draw_column(salt))


def part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(SPLIT) == name)
