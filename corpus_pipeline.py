"""From raw documents to packed sequences: toxicity, exact dedup, near dedup, source mixing, packing.

Every stage takes the session, the documents that its predecessor left, and the folder of the
tables; it returns documents with the same columns, the last one the packed pieces. ``run`` writes
each stage's result below the shared folder and reads it back, so a lost executor costs no more
than the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sitegrain.llm.common import settings, stored
from sitegrain.llm.exact_dedup import drop_copies
from sitegrain.llm.mixing import apply_mix
from sitegrain.llm.packing import pack
from sitegrain.llm.simhash import drop_near_duplicates
from sitegrain.llm.toxicity import drop_toxic

# The Python workers that pack have run the other stages before, so they keep less than by default.
REMEMBERED = 150_000
# Nor do they or the executors hold more texts than these at once: a batch is in both, several times.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model calls toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return drop_copies(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of texts whose SimHash fingerprints link one document stays."""
    return drop_near_duplicates(spark, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions: documents are left out, cut at the target's end, or repeated."""
    return apply_mix(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), remembered=REMEMBERED)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# SQL has no tokenizer and no XXH64: the stages are tested one by one against plain counterparts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with settings(spark, BATCHES):
        for name, stage in STAGES:
            docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
