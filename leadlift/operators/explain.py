"""Why a customer scored as they did: contributions per feature, ranked per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.functions.numeric import contribution_column, contribution_names
from leadlift.settings import EXPLAIN_TOP_N, SCORECARD

EXPECTED = "exp_expected_value"
# Column metadata: the feature whose contribution a column holds. Writers set it, readers go by it, so a column that
# merely has such a name is never taken for one.
MARK = "contribution_of"


def contribution_columns(contributions: dict[str, Column], taken: Sequence[str]) -> dict[str, Column]:
    """Columns to add, by name: one per feature, marked with it, none with a name that is taken."""
    names = contribution_names(list(contributions), taken)
    return {names[f]: c.alias(names[f], metadata={MARK: f}) for f, c in contributions.items()}


def contribution_map(df: DataFrame, features: Sequence[str]) -> dict[str, str]:
    """The column that holds each feature's contribution: the marked one, else (read from a file) the usual name."""
    marked = {field.metadata[MARK]: field.name for field in df.schema if MARK in field.metadata}
    return {f: marked.get(f, contribution_column(f)) for f in features}


def linear_contributions(
    df: DataFrame, background: DataFrame, weights: dict[str, tuple[float, float]] = SCORECARD
) -> DataFrame:
    """Contributions of a linear score, ``weight * (value - mean)``, with means taken over ``background``.

    They add up to the score minus the expected score. The means are one aggregate row, used as a scalar subquery.
    """
    means = background.select(F.struct(*[F.avg(f"`{f}`").alias(f) for f in weights])).scalar()
    out = df.withColumn("_means", means)
    expected = F.lit(0.0)
    values = {}
    for feature, (weight, centre) in weights.items():
        mean = F.col("_means").getField(feature)
        expected = expected + F.lit(weight) * (mean - F.lit(centre))
        values[feature] = F.lit(weight) * (F.col(f"`{feature}`") - mean)
    columns = contribution_columns(values, df.columns)
    kept = [F.col(f"`{c}`") for c in df.columns if c != EXPECTED]
    return out.select(*kept, expected.alias(EXPECTED), *columns.values())


def top_contributions(
    df: DataFrame,
    features: Sequence[str],
    top_n: int = EXPLAIN_TOP_N,
    contributions: dict[str, Column] | None = None,
) -> DataFrame:
    """Add exp_i_feature, exp_i_contribution and exp_i_value for the features with the largest |contribution|.

    Ties go to the feature listed first; ranks beyond the number of features are NULL. The sort runs inside each
    row, over one short array.
    """
    given = contributions or {f: F.col(f"`{c}`") for f, c in contribution_map(df, features).items()}
    entries = [
        F.struct(
            (-F.abs(given[f])).alias("order"),
            F.lit(position).alias("position"),
            F.lit(f).alias("feature"),
            given[f].alias("contribution"),
            F.col(f"`{f}`").cast("string").alias("value"),
        )
        for position, f in enumerate(features)
    ]
    ranked = df.withColumn("_ranked", F.array_sort(F.array(*entries)))
    columns = {}
    for i in range(max(1, int(top_n))):
        entry = F.get(F.col("_ranked"), F.lit(i))
        for field in ("feature", "contribution", "value"):
            columns[f"exp_{i + 1}_{field}"] = entry.getField(field)
    return ranked.withColumns(columns).drop("_ranked")


def static_explanations(df: DataFrame, selected: Sequence[str], top_n: int = EXPLAIN_TOP_N) -> DataFrame:
    """The globally most important features and this row's values for them. These are no contributions: the
    contribution and expected-value columns are typed NULLs."""
    names = [f for f in selected if f in df.columns]
    columns = {EXPECTED: F.lit(None).cast("double")}
    for i in range(max(1, int(top_n))):
        known = i < len(names)
        columns[f"exp_{i + 1}_feature"] = F.lit(names[i] if known else None).cast("string")
        columns[f"exp_{i + 1}_contribution"] = F.lit(None).cast("double")
        columns[f"exp_{i + 1}_value"] = F.col(names[i]).cast("string") if known else F.lit(None).cast("string")
    return df.withColumns(columns)


def mean_abs_contributions(explained: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean |contribution| per feature, largest first; ties in feature order."""
    columns = contribution_map(explained, features)
    means = explained.agg(*[F.avg(F.abs(F.col(f"`{columns[f]}`"))).alias(f"m{i}") for i, f in enumerate(features)])
    rows = [
        F.struct(F.lit(i).alias("_position"), F.lit(f).alias("feature"), F.col(f"m{i}").alias("mean_abs_shap"))
        for i, f in enumerate(features)
    ]
    table = means.select(F.inline(F.array(*rows)))
    return table.orderBy(F.desc("mean_abs_shap"), "_position").select("feature", "mean_abs_shap")
