"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytecnn, embeddings, langid, minhash, mixing, packing, pitmanyor, rules, substrings, tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_sub_n_words").alias("n_words"), F.col("_sub_n_removed").alias("n_removed"), F.sha2("_sub_kept", 256).alias("kept_sha256"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = tokens.written_and_read(_table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytecnn.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(_table(spark, sf_dir, "documents"))


def op7_pitmanyor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.scored(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(_table(spark, sf_dir, "documents"))


QUERIES = {"op1_minhash": op1_minhash, "op2_substrings": op2_substrings, "op3_embeddings": op3_embeddings, "op4_tokens": op4_tokens, "op5_quality": op5_quality, "op6_rules": op6_rules, "op7_pitmanyor": op7_pitmanyor, "op8_packing": op8_packing, "op9_mixing": op9_mixing, "op10_langid": op10_langid}
