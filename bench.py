"""Times the headline queries once each on one session and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query is run in
full and its rows are discarded by Spark. A first run at the smallest scale starts the
Python workers and builds the cached projections, as a long-lived session would have.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from sitegrain.session import local_session  # noqa: E402

HEADLINE = (
    "url_normalize", "links_discovered", "links_distinct", "link_report", "page_language", "page_classify",
    "dedupe_final_url", "page_title", "text_numbers", "product_roundtrip", "media_roundtrip", "listing_cards",
    "house_history", "last_non_empty", "union_list_by_key", "merge_map", "group_products", "upsert_merge",
    "upsert_replace", "dedupe_run_products", "ingest_metrics", "p95_latency_last_n", "constraint_audit",
    "frontier_closure", "ingest_run",
)
ROWS = {"pages": ("links_discovered", "page_title"), "part": ("product_roundtrip",), "lineitem": ("group_products",)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        QUERIES["product_roundtrip"](spark, small).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in wanted:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    rates = {}
    for table, names in ROWS.items():
        n = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
        rates.update({f"{q}_rows_per_s": round(n / times[q]) for q in names if times.get(q)})
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "rates": rates, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
