"""Counters, ratios and latency of an ingestion run, from its fetch log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain.functions.urls import canonical_page_url
from sitegrain.operators.percentile import percentile

LATENCIES_KEPT = 10_000


def attempt_counts() -> list[Column]:
    """Aggregates over ``ok``: every attempt counts, repeats included."""
    return [
        F.count("*").alias("total_requests"),
        F.count_if("ok").alias("success_requests"),
        F.count_if(~F.col("ok")).alias("failed_requests"),
    ]


def latest(fetch_log: DataFrame, n: int = LATENCIES_KEPT) -> DataFrame:
    """The newest attempts. A top-n: every task sends at most n rows on."""
    return fetch_log.orderBy(F.desc("ts"), F.desc("attempt_id")).limit(n)


def p95_latency(fetch_log: DataFrame, n: int = LATENCIES_KEPT) -> DataFrame:
    """Exact interpolated 95th percentile of the newest ``n`` latencies."""
    newest = latest(fetch_log.select("ts", "attempt_id", "latency_s"), n)
    return newest.agg(F.percentile("latency_s", F.lit(0.95)).alias("p95_latency_s"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Error rate over the attempts; null when there were none."""
    return counts.withColumn("error_rate", F.try_divide("failed_requests", "total_requests"))


def crawled_pages(host: str) -> Column:
    """How many pages were fetched: successful attempts, by the canonical name of their final URL."""
    return F.count_distinct(F.when(F.col("ok"), canonical_page_url(F.coalesce("final_url", "url"), host)))


def ingest_metrics(fetch_log: DataFrame, host: str, elapsed_s: Column | None = None, latencies: int | None = None) -> DataFrame:
    """One row for the run. Without a given duration the log's own time span counts.

    ``fetch_log``: attempt_id, url, final_url, ts, ok, latency_s. The percentile covers all
    latencies (``p95_latency_s``, selected by a few jobs that run at once), or the newest
    ``latencies`` (``p95_latency_last_n_s``).
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = F.max(micros) - F.min(micros)
    counts = fetch_log.agg(
        *attempt_counts(),
        crawled_pages(host).alias("crawled_pages"),
        (span / F.lit(1e6)).alias("span_s"),
    )
    seconds = F.col("span_s") if elapsed_s is None else elapsed_s
    if latencies is None:
        p95 = F.lit(percentile(fetch_log, "latency_s", 0.95)).cast("double").alias("p95_latency_s")
    else:
        p95 = p95_latency(fetch_log, latencies).scalar().alias(f"p95_latency_last_{latencies}_s")
    return with_rates(counts).select(
        "total_requests", "success_requests", "failed_requests", "crawled_pages", "error_rate",
        F.try_divide("total_requests", F.when(seconds > 0, seconds)).alias("requests_per_s"),
        p95,
    )


def processed_pages(pages: DataFrame, errors: DataFrame) -> DataFrame:
    """Pages that went through without an error, those that yielded nothing included."""
    failed = errors.select("page_id").distinct().agg(F.count("*").alias("n")).scalar()
    return pages.agg((F.count("*") - failed).alias("pages"))
