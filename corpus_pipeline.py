"""A training corpus from `documents`: good texts, one of each group of near copies, without secrets, mixed, encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark import shared
from tidemark.llm import bpe, mixing, near, quality, secrets
from tidemark.llm.common import prepare, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("near_copies", near_copies), ("secret_scans", secret_scans), ("mix_sources", mix_sources), ("encode", encode)]
#: Weak supervision, chosen paths and byte pairs aren't SQL: run() is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    at = shared.scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}-{name}")
        docs = spark.read.parquet(f"{at}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
