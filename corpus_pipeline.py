"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillflow.llm import minhash, mixing, packing, rules, storage, substrings

#: Words of a shingle and percent of similarity from which documents are near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.deduplicated(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of words that occur more than once are cut from the texts."""
    return substrings.cleaned(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights, in training order; a document can stand there twice."""
    return mixing.curriculum(docs, whole=True)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed to sequences."""
    return packing.packed(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed_sources", mixed_sources),
    ("packed_sequences", packed_sequences),
]

#: SQL can't express the quality rules' references; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = storage.shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = storage.stored(docs, folder, name)
    return docs
