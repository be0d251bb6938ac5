"""Scores of boosted trees over bins, in Arrow batches where the rows are."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.functions.trees import CATEGORY, NUMBER, BoostedTrees, bin_rows
from leadlift.sources.shipping import ship

KINDS = {NUMBER: "double", CATEGORY: "string"}


def feature_struct(model: BoostedTrees) -> Column:
    """The model's features of a row; a missing category is the category NA, as in training."""
    values = []
    for feature in model.features:
        value = F.col(f"`{feature.name}`").cast(KINDS[feature.kind])
        values.append((F.coalesce(value, F.lit("NA")) if feature.kind == CATEGORY else value).alias(feature.name))
    return F.struct(*values)


def margin_column(model: BoostedTrees, df: DataFrame) -> Column:
    """The model's log-odds of every row; missing numbers and unseen categories have a bin of their own."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def margins(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.margins(bin_rows(shared.value.features, rows)))

    return margins(feature_struct(model))
