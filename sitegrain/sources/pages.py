"""Page snapshots as batch or streaming tables, and the seed list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrain.functions.urls import normalize_url

PAGE_SCHEMA = (
    T.StructType()
    .add("page_id", "long")
    .add("url", "string")
    .add("final_url", "string")
    .add("seq", "long")
    .add("html", "string")
)


def page_table(raw: DataFrame) -> DataFrame:
    """``page_id, url, final_url, seq, html`` of any table that has at least page_id, url and html.

    ``final_url`` is the URL after redirects, which every later step uses; ``seq`` is the
    order of arrival.
    """
    final = F.coalesce(F.col("final_url"), F.col("url")) if "final_url" in raw.columns else F.col("url")
    seq = F.col("seq") if "seq" in raw.columns else F.col("page_id")
    return raw.select("page_id", "url", final.alias("final_url"), seq.cast("long").alias("seq"), "html")


def read_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Pages where they lie. ``partitions`` asks for a shuffle of the bodies, for a table of few, large splits."""
    raw = spark.read.parquet(path)
    return page_table(raw if partitions is None else raw.repartition(partitions, "page_id"))


def stream_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE_SCHEMA,
                 files_per_batch: int = 16) -> DataFrame:
    """Page files as they arrive in a folder."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return page_table(raw)


def seed_urls(spark: SparkSession, urls: Sequence[str]) -> DataFrame:
    """The first frontier. Seeds are not scope-filtered."""
    rows = [(i, u) for i, u in enumerate(urls) if u]
    return spark.createDataFrame(rows, "seq long, url string").withColumn("key", normalize_url(F.col("url")))
