"""Scorecard and the reproducible noisy label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from leadlift.functions import draws
from leadlift.functions.numeric import linear_score, sigmoid
from leadlift.settings import KEY, LABEL, LABEL_NOISE, SCORE, SCORECARD

# Draws are keyed by the customer number without the offset of customer_id.
DRAW_KEY = "_draw_key"


def with_draw_key(df: DataFrame, key: str = KEY, offset: int = 100000) -> DataFrame:
    """The key that draws depend on: numbers without the offset, anything else as it is."""
    numeric = isinstance(df.schema[key].dataType, NumericType)
    return df.withColumn(DRAW_KEY, F.col(key) - F.lit(offset) if numeric else F.col(key))


def add_score(df: DataFrame, column: str = "score") -> DataFrame:
    """The scorecard's log-odds."""
    return df.withColumn(column, linear_score(SCORECARD))


def add_scorecard_probability(df: DataFrame, column: str = SCORE) -> DataFrame:
    return df.withColumn(column, sigmoid(linear_score(SCORECARD)))


def add_label(df: DataFrame, column: str = LABEL) -> DataFrame:
    """1 where a keyed uniform draw falls below the noisy probability; the same on every run and layout."""
    noise = draws.normal(DRAW_KEY, "noise", 0.0, LABEL_NOISE)
    hit = draws.uniform(DRAW_KEY, "label") < sigmoid(linear_score(SCORECARD) + noise)
    return with_draw_key(df).withColumn(column, hit.cast("int")).drop(DRAW_KEY)
