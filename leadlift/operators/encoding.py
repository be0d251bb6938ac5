"""Scaling and category encoding: Spark ML stages for models that are saved, plain joins where a table is wanted."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.operators.categories import dictionaries, looked_up, sizes

# Category orders of StringIndexer.
ALPHABETIC = "alphabetAsc"
BY_FREQUENCY = "frequencyDesc"


def index_name(column: str) -> str:
    return f"{column}__idx"


def slots_name(column: str) -> str:
    return f"{column}__slots"


def filled(numeric: list[str]) -> list[str]:
    """Names of the numeric columns with missing values filled."""
    return [f"{c}__filled" for c in numeric]


def filling_stages(numeric: list[str]) -> list:
    """Missing numbers (NULL or NaN) as the median of the training rows. One stage, so one pass for all columns."""
    if not numeric:
        return []
    casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}__number`" for c in numeric)
    return [
        SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"),
        Imputer(strategy="median", inputCols=[f"{c}__number" for c in numeric], outputCols=filled(numeric)),
    ]


def index_stages(categorical: list[str], order: str = BY_FREQUENCY) -> list:
    """Category -> number; values not seen in training share one extra number. One stage, so one counting job."""
    if not categorical:
        return []
    outputs = [index_name(c) for c in categorical]
    return [StringIndexer(inputCols=categorical, outputCols=outputs, handleInvalid="keep", stringOrderType=order)]


def one_hot_stages(categorical: list[str]) -> list:
    """One slot per training category. Dropping the last slot removes exactly the extra "unseen" number, so unseen
    values become all zeros and no training category is lost."""
    if not categorical:
        return []
    encoder = OneHotEncoder(
        inputCols=[index_name(c) for c in categorical],
        outputCols=[slots_name(c) for c in categorical],
        handleInvalid="error",
        dropLast=True,
    )
    return [*index_stages(categorical, ALPHABETIC), encoder]


def scaling_stages(numeric: list[str], rows: int, output: str = "scaled") -> list:
    """(x - mean) / population standard deviation. StandardScaler divides by the sample deviation, so a constant
    factor that depends only on the number of training rows turns one into the other."""
    factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    return [
        VectorAssembler(inputCols=numeric, outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_standard", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="_standard", outputCol=output, scalingVec=Vectors.dense([factor] * len(numeric))
        ),
    ]


def fit_stages(stages: list, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(train)


def standard_scaled(df: DataFrame, train: DataFrame, numeric: list[str]) -> DataFrame:
    """Replace each numeric column by its scaled value, with statistics of ``train``."""
    model = fit_stages(scaling_stages(numeric, train.count()), train)
    values = model.transform(df).withColumn("_scaled_values", vector_to_array("scaled"))
    scaled = {c: F.get("_scaled_values", F.lit(i)) for i, c in enumerate(numeric)}
    return values.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def string_indexed(
    df: DataFrame, train: DataFrame, categorical: list[str], order: str = BY_FREQUENCY
) -> DataFrame:
    """Add ``<column>__idx``, the category's number in the training dictionary; other values, and none, get the number
    of categories. The dictionary stays a table, whatever its size."""
    table = dictionaries(train, categorical, order == BY_FREQUENCY)
    for c in categorical:
        df = looked_up(df, table, c, {index_name(c): F.col("number")})
        df = df.withColumn(index_name(c), F.coalesce(index_name(c), sizes(table, c)).cast("double"))
    return df


def one_hot_encoded(df: DataFrame, train: DataFrame, categorical: list[str]) -> DataFrame:
    """Add ``<column>__slots`` as an array of 0/1, one slot per training category in alphabetic order."""
    table = dictionaries(train, categorical, by_frequency=False)
    for c in categorical:
        df = looked_up(df, table, c, {slots_name(c): F.col("number")})
        # the array's length comes first: no subquery may stand inside the function over its places
        df = df.withColumn("_empty", F.array_repeat(F.lit(0), sizes(table, c).cast("int")))
        number = F.col(slots_name(c))
        slots = F.transform("_empty", lambda _, i: F.coalesce((i == number).cast("int"), F.lit(0)))
        df = df.withColumn(slots_name(c), slots).drop("_empty")
    return df
