"""Corpus pipeline over ``documents``: quality, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadlift.llm.line_crf import keep_good
from leadlift.llm.packing import pack_documents
from leadlift.llm.personal_data import mask_personal_data
from leadlift.llm.queries import WORD_VOCABULARY
from leadlift.llm.simhash import keep_one
from leadlift.sources.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the classifier takes for good; it learns from the labels of the documents it is given."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: four-word shingles, at most four different bits."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document with their place in a sequence."""
    return pack_documents(docs, WORD_VOCABULARY)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

# SQL expresses neither the classifier nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
