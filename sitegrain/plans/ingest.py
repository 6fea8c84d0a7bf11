"""Whole runs: pages to stored entities, with or without following links."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions.urls import in_scope, may_be_in_scope, normalize_url
from sitegrain.operators.frontier import Closure, expand_frontier
from sitegrain.operators.inspection import overflowing_numbers
from sitegrain.operators.merge import dedupe_media, dedupe_products, dedupe_wineries
from sitegrain.operators.routing import first_per_final_url
from sitegrain.operators.store import EntityStore
from sitegrain.operators.upsert import seed_winery
from sitegrain.plans.extract import Parts, extract_pages, split_parts
from sitegrain.rules import SiteRules
from sitegrain.session import work_dir


@dataclass(frozen=True)
class Run:
    """``stored`` tells whether the store took the run; it does not take a run id and batch twice."""

    parts: Parts
    extracted: DataFrame
    closure: Closure | None = None
    stored: bool = False


def drop_repeated_pages(pages: DataFrame, rules: SiteRules) -> DataFrame:
    """Only the first page of each canonical name.

    Page bodies are many times larger than everything else, so they should not be shuffled
    for this: the repeats are found on narrow columns and written; by the size written Spark
    removes them where the pages lie or, if they are many, by a shuffle.
    """
    spark = pages.sparkSession
    folder = work_dir(spark, "repeats")
    keys = pages.select("page_id", "final_url", "seq")
    first = first_per_final_url(keys, rules).select("page_id")
    keys.select("page_id").join(first, "page_id", "left_anti").write.parquet(folder)
    return pages.join(spark.read.parquet(folder), "page_id", "left_anti")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several later steps read, in the shared folder."""
    folder = work_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def process_pages(pages: DataFrame, rules: SiteRules) -> Run:
    """Parts of a page table in which every page counts as reached."""
    extracted = materialize(extract_pages(drop_repeated_pages(pages, rules), rules), "extracted")
    return Run(split_parts(extracted), extracted)


def crawl(spark: SparkSession, pages: DataFrame, seeds: DataFrame, rules: SiteRules,
          budget: int | None = None) -> Run:
    """Parts of the pages reached from the seeds.

    Only seeds and pages in scope can be reached, so the others are left out by their URL before
    parsing: those in scope by a test of the raw text, seeds out of scope by their number, which are
    as few as such seeds. What is left is parsed once; following links then is joins over narrow tables.
    """
    # Written first: the names computed from a URL use it many times over.
    narrow = materialize(pages.select("page_id", "url", "final_url", "seq"), "page-urls")
    keys = narrow.select("page_id", normalize_url(F.col("url")).alias("key"))
    outside = seeds.select("key").distinct().where(~in_scope(F.col("key"), rules.scope))
    named = materialize(keys.join(outside, "key", "left_semi").select("page_id", F.lit(True).alias("is_seed")), "seed-pages")
    near = pages.join(named, "page_id", "left").where(may_be_in_scope(F.col("url"), rules.scope) | F.col("is_seed")).drop("is_seed")
    extracted = materialize(extract_pages(near, rules), "extracted")
    links = extracted.select("page_id", F.explode("links").alias("url"))
    closure = expand_frontier(spark, narrow, links, seeds, rules, budget)
    wave = closure.done.select("page_id", F.col("wave").cast("long").alias("wave"))
    reached = extracted.join(wave, "page_id")
    # Waves come before pages in the order of arrival.
    ordered = reached.withColumn("seq", F.col("wave") * F.lit(1 << 40) + F.col("seq")).drop("wave")
    return Run(split_parts(ordered), ordered, closure)


def store_parts(store: EntityStore, parts: Parts, run_id: str, batch_id: int = 0, now: Column | None = None) -> bool:
    """In-run dedupe, then houses before products (their parents), then media, then what went wrong and the links.

    Returns whether any table took the batch: one that has been stored under this run and number
    before is left alone, whatever it holds now.
    """
    wineries, products, media = dedupe_wineries(parts.winery), dedupe_products(parts.product), dedupe_media(parts.media)
    taken = [
        store.upsert_wineries(wineries, run_id, batch_id, now),
        store.upsert_products(products, run_id, batch_id, now),
        store.upsert_media(media, run_id, batch_id, now),
    ]
    store.note("errors", parts.errors, run_id, batch_id)
    store.note("overflows", overflowing_numbers(products), run_id, batch_id)
    store.note("links", parts.links, run_id, batch_id)
    counts = written_counts(parts)
    store.note("flushes", counts.agg(*[F.sum(F.when(F.col("entity") == n, F.col("written"))).alias(f"written_{n}") for n in ("wineries", "products", "media")]), run_id, batch_id)
    return any(taken)


def ingest(spark: SparkSession, pages: DataFrame, store: EntityStore, rules: SiteRules, run_id: str,
           seeds: DataFrame | None = None, now: Column | None = None) -> Run:
    """A batch run into the store, the bare house record first. A finished run is not repeated (see ``Run.stored``)."""
    run = process_pages(pages, rules) if seeds is None else crawl(spark, pages, seeds, rules)
    winery = seed_winery(spark, rules).unionByName(run.parts.winery)
    parts = Parts(winery, run.parts.product, run.parts.media, run.parts.links, run.parts.errors)
    return replace(run, stored=store_parts(store, parts, run_id, now=now))


def written_counts(parts: Parts) -> DataFrame:
    """Records handed to the writer after in-run dedupe and before merging, per entity."""
    tables = {
        "wineries": dedupe_wineries(parts.winery),
        "products": dedupe_products(parts.product),
        "media": dedupe_media(parts.media),
    }
    rows = [t.agg(F.lit(n).alias("entity"), F.count("*").alias("written")) for n, t in tables.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])

