"""Column contracts of the exported tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.functions.numeric import contribution_column
from leadlift.operators.explain import EXPECTED, contribution_map
from leadlift.operators.ranking import DECILE
from leadlift.settings import ID_COLUMNS, SCORE
from leadlift.sources.tables import write_csv

RANKED_FIELDS = ("feature", "contribution", "value")


def lead_columns(columns: list[str], selected: list[str], contributions: dict[str, str] | None = None) -> list[str]:
    """Export order: ids, features, contributions, score, decile, expected value, ranked explanations. Columns the
    table lacks are left out; the label and the test AUC are never exported."""
    names = contributions or {f: contribution_column(f) for f in selected}
    ranks = sorted({int(m[1]) for c in columns if (m := re.fullmatch(r"exp_(\d+)_(?:feature|contribution|value)", c))})
    ordered = [
        *ID_COLUMNS,
        *selected,
        *[names[f] for f in selected],
        SCORE,
        DECILE,
        EXPECTED,
        *[f"exp_{i}_{name}" for i in ranks for name in RANKED_FIELDS],
    ]
    return [c for c in dict.fromkeys(ordered) if c in columns]


def lead_export(leads: DataFrame, selected: list[str]) -> DataFrame:
    names = lead_columns(leads.columns, selected, contribution_map(leads, selected))
    return leads.select(*[F.col(f"`{c}`") for c in names])


def export_leads(leads: DataFrame, selected: list[str], path: str, single_file: bool = False) -> str:
    return write_csv(lead_export(leads, selected), path, single_file=single_file)


def export_metrics(metrics: DataFrame, path: str) -> str:
    """A metrics report has a handful of rows, so it goes to one file."""
    return write_csv(metrics, path, single_file=True)
