"""Merging a batch of parts into stored entities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrain.functions.text import name_key, strip
from sitegrain.functions.urls import normalize_media_url
from sitegrain.operators.merge import (
    dedupe_media, merge_awards, merge_list, merge_map, merge_scalar, required,
)
from sitegrain.rules import SiteRules
from sitegrain.schemas import PRODUCT, PRODUCT_DETAILS, PRODUCT_NUMBERS, WINERY


def stable_id(key: Column) -> Column:
    """An id that a retried task computes again, unlike a random one."""
    return F.sha2(key, 256)


def seed_winery(spark: SparkSession, rules: SiteRules) -> DataFrame:
    """The bare house record that precedes all pages, so that products find their parent."""
    fields = "name string, website_url string, source_page_url string"
    row = [(rules.entity_name, rules.website_url, rules.website_url)]
    return spark.createDataFrame(row, fields).select(
        F.lit(-1).cast("long").alias("page_id"), F.lit(-1).cast("long").alias("seq"), F.lit(0).alias("pos"),
        "name", "website_url", "source_page_url", F.lit(None).cast("string").alias("description"),
        F.create_map().cast("map<string,string>").alias("family_spirit"),
        F.array().cast(WINERY["history_timeline"].dataType).alias("history_timeline"),
    )


def read_existing(stored: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The stored rows whose key occurs in ``keys``. Spark broadcasts the keys when they are few."""
    return stored.join(keys.select(key), key, "left_semi")


def winery_ids(wineries: DataFrame) -> DataFrame:
    return wineries.select(name_key(F.col("name")).alias("name_key"), "id")


def product_ids(products: DataFrame) -> DataFrame:
    return products.select("product_url", "id")


def default_winery_id(ids: DataFrame, rules: SiteRules) -> DataFrame:
    """One row: the only known house, or else the one under the site's own name."""
    own = F.max(F.when(F.col("name_key") == name_key(F.lit(rules.entity_name)), F.col("id")))
    return ids.agg(F.when(F.count("*") == 1, F.max("id")).otherwise(own).alias("id"))


def resolve_parent(products: DataFrame, default_id: DataFrame) -> DataFrame:
    """A product keeps its own house, else takes the default one; without any it is dropped."""
    own = F.when(F.col("winery_id") != "", F.col("winery_id"))
    return products.withColumn("winery_id", F.coalesce(own, default_id.scalar())).where("winery_id is not null")


def stamps(old: str | None, now: Column, refresh: bool) -> list[Column]:
    if old is None:
        return [now.alias("created_at"), now.alias("updated_at")]
    updated = now if refresh else F.coalesce(F.col(f"{old}.updated_at"), now)
    return [F.coalesce(F.col(f"{old}.created_at"), now).alias("created_at"), updated.alias("updated_at")]


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def merge_wineries(batch: DataFrame, stored: DataFrame, now: Column, refresh: bool = False) -> DataFrame:
    """All stored houses with the grouped batch merged in.

    A house is looked up under its trimmed name and written under the name it came with.
    """
    b, e = batch.alias("b"), stored.alias("e")
    new = F.col("e.name").isNull()

    def merged(c: str, merge: Callable[[Column, Column], Column]) -> Column:
        return F.when(new, F.col(f"b.{c}")).otherwise(merge(F.col(f"e.{c}"), F.col(f"b.{c}"))).alias(c)

    found = b.join(e, strip(F.col("b.name")) == F.col("e.name"), "left").select(
        F.coalesce(F.when(F.col("b.name") == F.col("e.name"), F.col("e.id")), stable_id(F.col("b.name"))).alias("id"),
        "b.name",
        *[merged(c, merge_scalar) for c in ("website_url", "source_page_url", "description")],
        merged("family_spirit", merge_map), merged("history_timeline", merge_list), *stamps("e", now, refresh),
    )
    rest = stored.join(found.select("name"), "name", "left_anti").select(*WINERY.fieldNames())
    return _typed(found, WINERY).unionByName(rest)


def merge_products(batch: DataFrame, stored: DataFrame, now: Column, refresh: bool = False) -> DataFrame:
    """All stored products with the grouped batch merged in: one full outer join on the URL."""
    cast = [F.col(c).try_cast(t).alias(c) for c, t in PRODUCT_NUMBERS.items()]
    kept = [c for c in batch.columns if c not in PRODUCT_NUMBERS and c != "product_url"]
    b = batch.select(*kept, *cast).alias("b")
    e = stored.alias("e")
    both = b.join(e, F.col("b.url_key") == F.col("e.product_url"), "full_outer")
    new, old = F.col("b.url_key").isNotNull(), F.col("e.product_url").isNotNull()

    def merged(c: str) -> Column:
        value = merge_scalar(F.col(f"e.{c}"), F.col(f"b.{c}"), PRODUCT[c].dataType)
        return F.when(old, value).otherwise(F.col(f"b.{c}")).alias(c)

    awards = (
        F.when(~new, F.col("e.awards_and_ratings"))
        .when(~old, F.col("b.awards_and_ratings"))
        .otherwise(merge_awards(F.col("e.awards_and_ratings"), F.col("b.awards_and_ratings")))
    )
    details = [awards.alias(c) if c == "awards_and_ratings" else merged(c) for c in PRODUCT_DETAILS]
    times = stamps("e", now, refresh)
    if refresh:
        times[1] = F.when(new, now).otherwise(F.col("e.updated_at")).alias("updated_at")
    return _typed(
        both.select(
            F.coalesce("e.id", stable_id(F.col("b.url_key"))).alias("id"),
            F.coalesce("b.winery_id", "e.winery_id").alias("winery_id"),
            F.coalesce("b.name", "e.name").alias("name"),
            F.coalesce("b.url_key", "e.product_url").alias("product_url"),
            merged("source_page_url"), *details, *times,
        ),
        PRODUCT,
    )


def replace_rows(batch: DataFrame, stored: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stored rows with those of the batch put in their place; ``keep`` columns stay as stored."""
    b, e = batch.alias("b"), stored.alias("e")
    both = b.join(e, F.col(f"b.{key}") == F.col(f"e.{key}"), "full_outer")
    new = F.col(f"b.{key}").isNotNull()

    def pick(c: str) -> Column:
        if c in keep:
            return F.coalesce(f"e.{c}", f"b.{c}").alias(c)
        return F.when(new, F.col(f"b.{c}")).otherwise(F.col(f"e.{c}")).alias(c)

    return both.select(*[pick(c) for c in stored.columns])


def merge_media(batch: DataFrame, stored: DataFrame, now: Column, run_id: str) -> DataFrame:
    """Stored media with the batch in their place, but for media this run has stored already."""
    fresh = batch.select(
        stable_id(F.col("url")).alias("id"), "media_type", "url", "source_page_url",
        now.alias("created_at"), F.lit(run_id).alias("run_id"),
    )
    mine = stored.where(F.col("run_id") == run_id).select("url")
    return replace_rows(fresh.join(mine, "url", "left_anti"), stored, "url", keep=("id", "created_at"))


def prepare_media(parts: DataFrame) -> DataFrame:
    """Complete media rows, the first of each normalised URL, under that URL."""
    first = dedupe_media(required(parts, "media_type", "url", "source_page_url"))
    return first.withColumn("url", normalize_media_url(F.col("url")))


def delete_cascade(products: DataFrame, deleted_ids: DataFrame) -> DataFrame:
    """Products whose house stays. Orphans without any house stay, too."""
    gone = deleted_ids.select(F.col("id").alias("winery_id"))
    return products.join(gone, "winery_id", "left_anti").select(*products.columns)
