"""The numbered operators over the tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, copies, lm, mixing, near, negatives, packing, quality, repair, secrets, toxicity, vectors
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.render(turns.unionByName(chat.control_conversation(spark))))


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_copies(table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("mean_rate", F.round("mean_rate", 9))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(repair.damage(table(spark, sf_dir, "conversations")))


def op12_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.exact_copies(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.relabelled(table(spark, sf_dir, "embeddings")))


QUERIES = {
    f.__name__: f
    for f in (op1_chat, op2_near_copies, op3_lm_scores, op4_mix_sources, op5_secrets, op6_quality, op7_near_vectors, op8_bpe, op9_toxicity, op10_token_files, op11_repair, op12_exact_copies, op13_hard_negatives)
}
ORACLE = {"op4_mix_sources": mixing.SQL, "op12_exact_copies": copies.SQL, "op13_hard_negatives": negatives.SQL}
