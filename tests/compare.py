"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame

# Spark type -> the DuckDB types that hold the same values
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def sortable(row: tuple) -> tuple:
    return tuple((value is not None, value) for value in row)


def differences(spark_result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types, row counts and values agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    if sorted(names) != sorted(spark_result.columns):
        return [f"columns {sorted(spark_result.columns)} != {sorted(names)}"]
    problems = [
        f"type of {name}: {kind} != {kinds[name]}"
        for name, kind in spark_result.dtypes
        if kinds[name] not in SAME_TYPE.get(kind, {kind.upper()})
    ]
    order = sorted(names)
    theirs = sorted((tuple(r[names.index(n)] for n in order) for r in found.fetchall()), key=sortable)
    ours = sorted((tuple(r[n] for n in order) for r in spark_result.collect()), key=sortable)
    if len(ours) != len(theirs):
        return [*problems, f"rows {len(ours)} != {len(theirs)}"]
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} of {len(ours)} rows differ, first {dict(zip(order, zip(*wrong[0])))}")
    return problems
