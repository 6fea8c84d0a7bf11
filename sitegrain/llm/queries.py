"""The dealt queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sitegrain.llm.exact_dedup import exact_dedup
from sitegrain.llm.licenses import scan_licenses
from sitegrain.llm.mixing import mix_sources
from sitegrain.llm.packing import pack
from sitegrain.llm.pii import scan_pii
from sitegrain.llm.quality import quality
from sitegrain.llm.repair import repair_conversations
from sitegrain.llm.secret_scan import scan_secrets
from sitegrain.llm.simhash import near_duplicates
from sitegrain.llm.tokencount import count_tokens
from sitegrain.llm.toxicity import score_toxicity
from sitegrain.llm.trie import conversation_trie
from sitegrain.llm.warc import page_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, documents(spark, sf_dir))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark, documents(spark, sf_dir)).drop("uid")


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(spark, documents(spark, sf_dir))


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark, documents(spark, sf_dir))


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(spark, documents(spark, sf_dir))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark, documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, documents(spark, sf_dir))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
