"""Parquet and CSV tables, and small tables made from driver rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """CSV with an explicit schema: no inference pass, no drifting types."""
    return spark.read.schema(schema).option("header", header).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> str:
    """CSV folder with headers. ``single_file`` pulls everything into one task; only for small reports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def rows_to_table(spark: SparkSession, rows: Iterable[Mapping], schema: StructType) -> DataFrame:
    """A table from driver-side records; keys missing from a record become NULL."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)
