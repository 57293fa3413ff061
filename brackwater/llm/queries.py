"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe
from .caps import near_vectors
from .common import table
from .kneser_ney import held_out_scores
from .licences import licences
from .oracle import ORACLE_SQL  # noqa: F401  handed on
from .packing import pack
from .pii import pii
from .quality import quality
from .retrieval import ranked
from .simhash import simhash_groups
from .topk import top_products
from .toxicity import toxicity
from .urls import judge_urls
from .whitening import whitened


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).drop("purity")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 6))


def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return pack(table(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank_file = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe(table(spark, sf_dir, "documents"), rank_file, public_tokenizers.PATTERN)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_near_vectors": op2_near_vectors,
    "op3_urls": op3_urls,
    "op4_pii": op4_pii,
    "op5_licences": op5_licences,
    "op6_top_products": op6_top_products,
    "op7_lm_scores": op7_lm_scores,
    "op8_simhash": op8_simhash,
    "op9_packing": op9_packing,
    "op10_bpe": op10_bpe,
    "op11_whitening": op11_whitening,
    "op12_toxicity": op12_toxicity,
    "op13_ranked": op13_ranked,
}
