"""Micro-batch ingestion of arriving page files, and running metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitegrain.operators.metrics import LATENCIES_KEPT, attempt_counts, latest, with_rates
from sitegrain.operators.routing import first_per_final_url
from sitegrain.operators.store import EntityStore
from sitegrain.operators.upsert import seed_winery
from sitegrain.plans.extract import Parts, extract_pages, split_parts
from sitegrain.plans.ingest import materialize, store_parts
from sitegrain.rules import SiteRules


def on_all_cores(pages: DataFrame) -> DataFrame:
    """A batch of few, large files has fewer splits than there are cores: its pages are dealt before they are parsed."""
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages if pages.rdd.getNumPartitions() >= cores else pages.repartition(2 * cores, "page_id")


def ingest_batch(store: EntityStore, pages: DataFrame, batch_id: int, run_id: str, rules: SiteRules,
                 now: Column | None = None) -> None:
    """One micro-batch: pages this run has not processed, extracted and merged into the store.

    Every table remembers the last batch it took, so a batch that is run again after a
    failure continues where it stopped.
    """
    keys = pages.select("page_id", "final_url", "seq")
    fresh = materialize(first_per_final_url(keys, rules), "batch-keys")
    stored = store.pages.read(store.spark, store.pages.touched(fresh.select("canon")))
    # A replayed batch must see the pages as its first attempt did: those of other batches.
    known = stored.where((F.col("run_id") == run_id) & (F.col("batch_id") != batch_id))
    new = materialize(fresh.join(known.select("canon"), "canon", "left_anti"), "batch-new")
    bodies = on_all_cores(pages).join(new.select("page_id"), "page_id", "left_semi")
    parts = split_parts(materialize(extract_pages(bodies, rules), "batch-extracted"))
    winery = seed_winery(store.spark, rules).unionByName(parts.winery) if batch_id == 0 else parts.winery
    store_parts(store, Parts(winery, parts.product, parts.media, parts.links, parts.errors), run_id, batch_id, now)
    if not store.taken(store.pages, run_id, batch_id):
        store.pages.append(new.select("canon", F.lit(run_id).alias("run_id"), "page_id", F.lit(batch_id).cast("long").alias("batch_id")))
        store.take(store.pages, run_id, batch_id)


def stream_ingest(pages: DataFrame, store: EntityStore, checkpoint: str, run_id: str, rules: SiteRules,
                  now: Column | None = None) -> StreamingQuery:
    """Ingest all page files present (``readStream``), one micro-batch after another."""
    return (
        pages.writeStream.foreachBatch(lambda df, i: ingest_batch(store, df, i, run_id, rules, now))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedupe(rows: DataFrame, *keys: str, watermark: tuple[str, str] | None = None) -> DataFrame:
    """One row per key over the life of a stream.

    State grows with the number of keys, as in any run-long set. With a watermark (event
    time column, delay) it is bounded and keys are forgotten after the delay.
    """
    if watermark is None:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(keys))


def stream_first(rows: DataFrame, key: Column, order: Column) -> DataFrame:
    """The first row of each key by ``order``, whenever it comes (update mode).

    The state holds the smallest arrival of a key; an earlier one that comes later is emitted as a
    correction. So what is kept does not depend on files or batches, as it does with ``stream_dedupe``.
    """
    first = F.min_by(F.struct(*rows.columns), order).alias("row")
    return rows.groupBy(key.alias("key")).agg(first).select("key", "row.*")


def write_corrections(first: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write what ``stream_first`` emits, a part for each batch; a batch that is run again replaces its part."""
    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    writer = first.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def corrected(corrections: DataFrame) -> DataFrame:
    """The last row written for each key."""
    columns = [c for c in corrections.columns if c not in ("key", "batch")]
    return corrections.groupBy("key").agg(F.max_by(F.struct(*columns), "batch").alias("row")).select("row.*")


def live_metrics(fetch_log: DataFrame) -> DataFrame:
    """Counters and error rate so far (update or complete mode)."""
    return with_rates(fetch_log.groupBy().agg(*attempt_counts()))


def keep_latest(previous: DataFrame, batch: DataFrame, n: int = LATENCIES_KEPT) -> DataFrame:
    """The newest attempts after one more batch: what a running percentile needs, never more than n rows."""
    return latest(previous.unionByName(batch), n)
