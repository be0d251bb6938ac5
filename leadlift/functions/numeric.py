"""Small numeric and naming helpers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clip(x: Column, low: float, high: float) -> Column:
    """``x`` within the bounds; NULL and NaN stay what they are."""
    number = x.cast("double")
    return F.when(number < low, F.lit(low)).when((number > high) & ~F.isnan(number), F.lit(high)).otherwise(x)


def fixed(x: Column, digits: int = 6) -> Column:
    """Round half up with plain arithmetic, so that other engines get the same double."""
    scale = float(10**digits)
    rounded = F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.isnan(x), F.lit(float("nan"))).otherwise(rounded)


def ratio(numerator: Column, denominator: Column, empty: float | None = None) -> Column:
    """numerator / denominator as doubles; ``empty`` (NULL by default) where the denominator is 0."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if empty is None else F.when(denominator == 0, F.lit(float(empty))).otherwise(quotient)


def linear_score(weights: dict[str, tuple[float, float]]) -> Column:
    """Sum of weight * (feature - centre)."""
    terms = [f"{weight!r}D * (`{feature}` - {centre!r}D)" for feature, (weight, centre) in weights.items()]
    return F.expr(" + ".join(["0D", *terms]))


def grid_step(points: int) -> float:
    """Spacing of an even grid over [0, 1]."""
    return 1.0 / (max(2, int(points)) - 1)


def threshold_label(prefix: str, threshold: float) -> str:
    return f"{prefix}@{float(threshold):g}"


def contribution_column(feature: str) -> str:
    """Export-safe name of a feature's contribution column."""
    return "shap__" + re.sub(r"_+", "_", re.sub(r"[^\w]", "_", feature)).strip("_")


def contribution_names(features: Sequence[str], taken: Iterable[str] = ()) -> dict[str, str]:
    """One column name per feature, none of them taken (in any case) or given twice: a clash gets a suffix."""
    used = {name.lower() for name in taken}
    names = {}
    for feature in features:
        base = name = contribution_column(feature)
        number = 1
        while name.lower() in used:
            name = f"{base}_contribution" if number == 1 else f"{base}_contribution_{number}"
            number += 1
        used.add(name.lower())
        names[feature] = name
    return names
