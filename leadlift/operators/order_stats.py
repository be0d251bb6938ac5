"""Exact global ranks and rank cut-offs without a single-task window.

Rows are ordered by (value, key); the key breaks ties. Spark range-partitions the rows by that pair, from a sample of
pairs, so a value that a third of all rows share is cut further by its keys, whatever their type. The partition's number
is staged with the rows, so every later pass and every retried task sees the same buckets. Sampling only decides how
even the buckets are: counts per bucket are exact, so ranks are exact. The number of buckets follows the number of rows;
it is never less than the session's shuffle partitions, so small tables run the same code as large ones.

A look-up of single ranks moves no rows: it counts them in cells of the value, and then in ever finer cells around the
wanted rank, of the value and of the key. Those are partial aggregates with bounded results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from leadlift.sources.staging import scope, stage

ROWS_PER_BUCKET = 200_000
CELLS = 4096  # of [0, 1]; what lies outside shares the first or the last
MAX_GROUPS = 1000
FEW_ROWS = 1000  # fetched per wanted rank
MAX_PASSES = 8  # a pass narrows 4095-fold; what is wider after these is ordered

BUCKET = "_bucket"
GROUP = "_group"


def is_ranked(value: str) -> Column:
    """Rows that take part in an order: a value that is neither NULL nor NaN."""
    return F.col(value).isNotNull() & ~F.isnan(F.col(value))


def in_buckets(df: DataFrame, order: list[Column], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` staged in the given order: a larger bucket number always means later in the order."""
    rows = df.count()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_per_bucket))
    ranged = df.repartitionByRange(parts, *order)
    return stage(ranged.withColumn(BUCKET, F.spark_partition_id().cast("bigint")), "buckets")


def group_counts(df: DataFrame, by: str | None) -> dict:
    """Rows per group; the groups are the few classes of a label, more than ``MAX_GROUPS`` are refused."""
    if by is None:
        return {0: df.count()}
    rows = df.groupBy(by).count().limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{by} has more than {MAX_GROUPS} values; it is no class label")
    return {row[by]: row["count"] for row in rows}


def _grouped(df: DataFrame, by: str | None) -> DataFrame:
    return df.withColumn(GROUP, F.lit(0) if by is None else F.col(by))


def rank_rows(
    df: DataFrame,
    value: str,
    key: str,
    by: str | None = None,
    column: str = "rank",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Unique ascending rank 1..n by (value, key) within each group; rows without a value are left out.

    Offsets of buckets stay a table: a group has one row per bucket, and there may be any number of groups.
    """
    order = [F.col(GROUP), F.col(value), F.col(key)]
    tagged = in_buckets(_grouped(df.where(is_ranked(value)), by), order, rows_per_bucket)
    counts = tagged.groupBy(GROUP, BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(GROUP).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(GROUP, BUCKET, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(GROUP, BUCKET).orderBy(value, key)
    # null is a group like any other, hence the null-safe comparison
    ranked = tagged.withColumn(column, F.row_number().over(inside).cast("bigint")).alias("r")
    same = F.col(f"r.{GROUP}").eqNullSafe(F.col(f"o.{GROUP}")) & (F.col(f"r.{BUCKET}") == F.col(f"o.{BUCKET}"))
    joined = ranked.join(offsets.alias("o"), same)
    names = [F.col(f"r.`{c}`") for c in df.columns if c != column]
    out = joined.select(*names, (F.col(f"r.{column}") + F.col("o._before")).alias(column))
    return out.select(*[c for c in df.columns if c != column], column)


def cell_of(value: str) -> Column:
    """The value's cell; a larger cell always means larger values."""
    inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(value).cast("double")))
    return F.floor(inside * F.lit(float(CELLS))).cast("int")


def keys_at_ranks(
    df: DataFrame,
    value: str,
    key: str,
    ranks: dict,
    by: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> dict:
    """The (value, key) pairs found at given ranks: ``{group: [rank, ..]}`` -> ``{(group, rank): (value, key)}``.

    Passes count cells: first fixed ones of the value, then finer ones between the smallest and the largest value of
    the rows in question, then, where all of these have one value, of a numeric key. Each result is bounded by the
    cells. Once at most ``FEW_ROWS`` rows are left for a rank they are fetched. Ranks that are not narrowed that far
    (one value for many rows whose keys are no numbers, infinite values) are looked up in an order of their rows.
    """
    wanted = [(group, rank) for group, group_ranks in ranks.items() for rank in sorted(set(group_ranks))]
    if not wanted:
        return {}
    rows = _grouped(df.where(is_ranked(value)), by).select(GROUP, value, key)
    if by is not None:
        rows = rows.where(F.col(GROUP).isin(list(ranks)))
    value_number, key_number = F.col(f"`{value}`").cast("double"), F.lit(None).cast("double")
    numeric_key = isinstance(df.schema[key].dataType, NumericType)
    if numeric_key:
        key_number = F.col(f"`{key}`").cast("double")
    rows = rows.select("*", value_number.alias("_value"), key_number.alias("_key"))
    # at most CELLS + 1 rows for each of the asked groups
    counted = _bounds(rows.select("*", cell_of("_value").alias("_cell")), GROUP)
    open_spans = _chosen({(group, rank): rank for group, rank in wanted}, counted, {})
    found: dict[tuple, tuple] = {}
    hard: dict[tuple, Span] = {}
    for _ in range(MAX_PASSES):
        finer = {}
        for spot, span in open_spans.items():
            if span.rows <= FEW_ROWS:
                continue
            width = span.by_value and span.low < span.high
            tied = span.low == span.high if span.by_value else True
            by_key = tied and numeric_key and span.first is not None and span.first < span.last
            if width and math.isfinite(span.high / 2 - span.low / 2):
                finer[spot] = span
            elif by_key and math.isfinite(span.last / 2 - span.first / 2):
                finer[spot] = replace(span, by_value=False)
            else:
                hard[spot] = span
        if not finer:
            break
        open_spans = {s: span for s, span in open_spans.items() if s not in hard and s not in finer}
        done = open_spans
        places = list({_place_of(s, span): None for s, span in finer.items()})
        number = {place: i for i, place in enumerate(places)}
        celled = rows.withColumn("_place", _case([(_inside(*p), F.lit(i)) for i, p in enumerate(places)]))
        cell = _case([(F.col("_place") == i, _cell_between(p[1])) for i, p in enumerate(places)])
        counted = _bounds(celled.where("_place is not null").withColumn("_cell", cell), "_place")
        asked = {s: (number[_place_of(s, span)], span) for s, span in finer.items()}
        open_spans = {**done, **_chosen({s: span.rank for s, (_, span) in asked.items()}, counted, asked)}
    hard |= {s: span for s, span in open_spans.items() if span.rows > FEW_ROWS}
    easy = {s: span for s, span in open_spans.items() if s not in hard}
    if easy:
        places = list({_place_of(s, span): None for s, span in easy.items()})
        placed = rows.withColumn("_place", _case([(_inside(*p), F.lit(i)) for i, p in enumerate(places)]))
        held: dict[tuple, list] = {}
        # at most FEW_ROWS rows per place
        for row in placed.where("_place is not null").select("_place", value, key).collect():
            held.setdefault(places[row[0]], []).append((row[1], row[2]))
        for pairs in held.values():
            pairs.sort(key=lambda pair: (pair[0], pair[1] is not None, pair[1]))
        found |= {s: held[_place_of(s, span)][span.rank - 1] for s, span in easy.items()}
    if hard:
        places = list({_place_of(s, span): None for s, span in hard.items()})
        placed = rows.withColumn("_place", _case([(_inside(*p), F.lit(i)) for i, p in enumerate(places)]))
        spots = {(places.index(_place_of(s, span)), span.rank): s for s, span in hard.items()}
        hit = reduce(lambda a, b: a | b, [(F.col("_place") == i) & (F.col("_position") == r) for i, r in spots])
        with scope(df.sparkSession):
            narrow = placed.where("_place is not null").select("_place", value, key)
            ranked = rank_rows(narrow, value, key, by="_place", column="_position", rows_per_bucket=rows_per_bucket)
            for row in ranked.where(hit).collect():  # one row per wanted rank
                found[spots[row["_place"], row["_position"]]] = (row[value], row[key])
    return found


@dataclass(frozen=True)
class Span:
    """Rows that hold a wanted rank: ``rank`` counts from the first of them in the order of (value, key)."""

    low: float
    high: float
    first: float | None  # bounds of the keys, as far as they are numbers
    last: float | None
    rows: int
    rank: int
    by_value: bool = True  # else one value, and the keys between the bounds only


def _bounds(celled: DataFrame, by: str) -> dict:
    """Per group or place: its cells in order, with rows and bounds."""
    ends = [f(c).alias(n) for n, f, c in (("low", F.min, "_value"), ("high", F.max, "_value"), ("first", F.min, "_key"), ("last", F.max, "_key"))]
    nulls = F.count(F.when(F.col("_key").isNull() | F.isnan("_key"), 1)).alias("unknown")
    found: dict = {}
    for row in celled.groupBy(by, "_cell").agg(F.count(F.lit(1)).alias("rows"), nulls, *ends).collect():
        found.setdefault(row[by], []).append(row)
    return {name: sorted(rows, key=lambda r: r["_cell"]) for name, rows in found.items()}


def _chosen(ranks: dict, counted: dict, asked: dict) -> dict:
    """The span of each wanted rank after a pass; a rank beyond the last row has none."""
    out = {}
    for spot, rank in ranks.items():
        name, earlier = asked.get(spot, (spot[0], None))
        for row in counted.get(name, []):
            if rank <= row["rows"]:
                keyed = (row["first"], row["last"]) if not row["unknown"] else (None, None)
                by_value = earlier is None or earlier.by_value
                out[spot] = Span(row["low"], row["high"], *keyed, row["rows"], rank, by_value)
                break
            rank -= row["rows"]
    return out


def _place_of(spot: tuple, span: Span) -> tuple:
    return spot[0], replace(span, rows=0, rank=0)


def _inside(group, span: Span) -> Column:
    """Whether a row of ``group`` belongs to the span."""
    inside = F.col(GROUP).eqNullSafe(F.lit(group)) & F.col("_value").between(span.low, span.high)
    return inside if span.by_value else inside & F.col("_key").between(span.first, span.last)


def _cell_between(span: Span) -> Column:
    """One of ``CELLS`` between the span's bounds; the two ends never share one."""
    number, low, high = ("_value", span.low, span.high) if span.by_value else ("_key", span.first, span.last)
    # halves do not overflow; where halving would lose a tiny difference, the difference itself is finite
    half = 0.5 if high * 0.5 - low * 0.5 > 0 and not math.isfinite(high - low) else 1.0
    share = (F.col(number) * half - F.lit(low * half)) / F.lit(high * half - low * half)
    return F.floor(share * F.lit(float(CELLS - 1))).cast("int")


def _case(branches: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda otherwise, b: F.when(b[0], b[1]).otherwise(otherwise), branches, F.lit(None).cast("int"))


def at_or_before(value: str, key: str, cut: tuple) -> Column:
    """Whether a row comes no later than ``cut`` in the (value, key) order."""
    cut_value, cut_key = F.lit(cut[0]), F.lit(cut[1])
    return (F.col(value) < cut_value) | ((F.col(value) == cut_value) & (F.col(key) <= cut_key))
