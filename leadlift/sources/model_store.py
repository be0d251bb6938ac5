"""Saving and loading fitted models: Spark ML folders, or a folder with one row for trees over bins."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from leadlift.functions.trees import BoostedTrees

BOOSTED = "boosted_trees"


def save_model(model: PipelineModel | BoostedTrees, path: str, overwrite: bool = True) -> str:
    if isinstance(model, BoostedTrees):
        spark = SparkSession.getActiveSession()
        table = spark.createDataFrame([(model.to_json(),)], "content string").coalesce(1)
        table.write.mode("overwrite" if overwrite else "error").parquet(f"{path}/{BOOSTED}")
    else:
        writer = model.write()
        (writer.overwrite() if overwrite else writer).save(path)
    return path


def load_model(path: str) -> PipelineModel | BoostedTrees:
    spark = SparkSession.getActiveSession()
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BOOSTED}")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return BoostedTrees.from_json(spark.read.parquet(f"{path}/{BOOSTED}").first()["content"])
    return PipelineModel.load(path)
