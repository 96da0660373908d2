"""The training-data pipeline: each stage applies one operator to all that its predecessor kept.

Every stage but the last returns the columns of its input. Null texts are empty ones, rows may
repeat, and an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldsieve.llm import jaccard_join, labelled, queries
from fieldsieve.llm import mixing as mixtures
from fieldsieve.session import pin


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labels of ``sf_dir``, lets pass."""
    model = queries.toxicity_model(spark, sf_dir)
    return labelled.kept_documents(docs, model.score, lambda s: s < queries.TOXIC_FROM)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels of ``sf_dir``, lets pass."""
    model = queries.quality_model(spark, sf_dir)
    return labelled.kept_documents(docs, model.score, lambda s: s >= queries.GOOD_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles are linked at a similarity of 0.8 or more.

    The smallest id stays, rows without an id come last. Rows are told apart by id and text: a copy
    takes no other text of its id with it, and of rows equal in both one stays.
    """
    return jaccard_join.without_copies(docs, jaccard_join.Similarity(words=5, percent=80))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, each as often as it is taken."""
    return mixtures.mixed_documents(docs, lambda keyed, key: queries.mixture(keyed, carried=(key,)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of 2048 tokens."""
    return queries.packed_digest(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("jaccard_join", near_duplicates),
    ("mixing", mixing),
    ("best_fit_packing", packing),
]

#: The classifiers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
