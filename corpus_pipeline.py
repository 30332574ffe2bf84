"""A corpus pipeline of the training-data operators; each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesprism.llm import fertility, jaccard, mixing, packing, pii
from salesprism.session import materialised


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    return fertility.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id."""
    return jaccard.first_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as many times as the mix of the sources takes it."""
    return mixing.repeated(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their ids."""
    return packing.packed(docs)


STAGES = [
    ("quality", quality),
    ("near copies", near_copies),
    ("personal data", personal_data),
    ("mixture", mixture),
    ("packing", sequences),
]

#: Tokenizers and trees are no SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage leaves is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir))
    return docs
