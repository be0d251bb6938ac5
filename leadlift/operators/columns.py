"""Column selection and cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.settings import CATEGORICAL, ID_COLUMNS, LABEL, SCORE


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table must contain {list(names)}")


def require_scored(df: DataFrame, label: str = LABEL, score: str = SCORE) -> None:
    require_columns(df, [label, score])


def feature_columns(df: DataFrame, ids: list[str] = ID_COLUMNS, label: str = LABEL) -> list[str]:
    """Everything that is neither an id nor the label, in table order."""
    return [c for c in df.columns if c not in ids and c != label]


def present(df: DataFrame, names: list[str] | None) -> list[str]:
    """The given names that the table has, in the given order."""
    return [n for n in names or [] if n in df.columns]


def normalise_categories(df: DataFrame, categorical: list[str] | None = None) -> DataFrame:
    """Categoricals as strings, NULL as its own category ``NA``."""
    names = present(df, CATEGORICAL if categorical is None else categorical)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in names})


def restrict_features(
    df: DataFrame, selected: list[str], ids: list[str] = ID_COLUMNS, keep: Iterable[str] = (LABEL,)
) -> DataFrame:
    """Ids, the label and the selected features; names the table lacks are dropped."""
    return df.select(*present(df, [*ids, *keep, *selected]))


def trial_columns(trials: DataFrame) -> list[str]:
    """The columns of a trial table that a report shows."""
    return [c for c in trials.columns if c in ("trial", "valid_auc") or c.startswith("param_")]


def attach_features(scored: DataFrame, features: DataFrame, key: str, selected: list[str]) -> DataFrame:
    """Add feature columns to scored rows by key; every scored row stays."""
    return scored.join(features.select(key, *selected), key, "left")


def rows_of(full: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """The rows of ``full`` whose key occurs in ``part``."""
    return full.join(part.select(key), key, "left_semi")
