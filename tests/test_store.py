from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sitegrain.operators.store import EntityStore
from sitegrain.operators.upsert import delete_cascade, merge_wineries
from sitegrain.operators import houses as H
from sitegrain.operators.merge import group_wineries
from sitegrain.plans.ingest import ingest, materialize, process_pages, store_parts
from sitegrain.rules import SiteRules
from sitegrain.schemas import WINERY
from sitegrain.session import work_dir
from sitegrain.sources.pages import PAGE_SCHEMA, stream_pages
from sitegrain.sources.tables import Table
from sitegrain.streaming.ingest import (
    corrected, ingest_batch, keep_latest, live_metrics, stream_dedupe, stream_first, stream_ingest, write_corrections,
)
from tests.fixtures.site import page_snapshot

RULES = SiteRules()


def _now():
    return F.lit("2024-01-01").cast("timestamp")


def _store(spark):
    return EntityStore(spark, work_dir(spark, "store"), RULES, buckets=4)


def _content(spark, store):
    sort = lambda df, key: [str(r) for r in df.orderBy(key).collect()]
    media = store.media.read(spark).drop("run_id")
    return sort(store.houses(), "name"), sort(store.products.read(spark), "product_url"), sort(media, "url")


@pytest.fixture(scope="module")
def batch_result(spark):
    store = _store(spark)
    ingest(spark, page_snapshot(spark), store, RULES, "r", now=_now())
    return store, _content(spark, store)


def test_batch_run(spark, batch_result):
    store, (wineries, products, media) = batch_result
    assert len(wineries) == 1 and len(products) == 4
    w = store.houses().first()
    assert w.description == "Some text note and more" and len(w.history_timeline) == 4 and set(w.family_spirit) == {"Jean-claude Foo", "B"}
    assert {r.winery_id for r in store.products.read(spark).collect()} == {w.id}


def test_a_run_is_taken_once_and_again_changes_nothing(spark, batch_result):
    store, before = batch_result
    assert ingest(spark, page_snapshot(spark), store, RULES, "r", now=_now()).stored is False
    later = F.lit("2025-01-01").cast("timestamp")
    assert ingest(spark, page_snapshot(spark), store, RULES, "another run", now=later).stored is True
    assert _content(spark, store) == before


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_stream_equals_batch_for_any_batch_size(spark, batch_result, files_per_batch):
    folder = work_dir(spark, "stream")
    pages = page_snapshot(spark)
    ids = [r.page_id for r in pages.select("page_id").orderBy("page_id").collect()]
    for n, chunk in enumerate((ids[:9], ids[9:])):
        pages.where(F.col("page_id").isin(chunk)).coalesce(1).write.mode("append").parquet(f"{folder}/pages")
    store = EntityStore(spark, f"{folder}/store", RULES, buckets=4)
    stream = stream_pages(spark, f"{folder}/pages", PAGE_SCHEMA, files_per_batch)
    stream_ingest(stream, store, f"{folder}/checkpoint", "r", RULES, _now()).awaitTermination()
    assert _content(spark, store)[1:] == batch_result[1][1:]
    assert store.wineries.read(spark).count() == 1


def test_replaying_a_batch_changes_nothing(spark):
    store, pages = _store(spark), page_snapshot(spark)
    ingest_batch(store, pages.where("page_id < 40"), 0, "r", RULES, _now())
    ingest_batch(store, pages.where("page_id >= 22"), 1, "r", RULES, _now())
    before = _content(spark, store), store.pages.read(spark).count()
    ingest_batch(store, pages.where("page_id >= 22"), 1, "r", RULES, _now())
    assert (_content(spark, store), store.pages.read(spark).count()) == before


def test_a_batch_that_was_cut_off_is_completed(spark, monkeypatch):
    """The merged rows lie aside: a bucket lost while they are moved comes back when the batch is repeated."""
    store = _store(spark)
    parts = process_pages(page_snapshot(spark), RULES).parts
    store.upsert_media(parts.media, "r1", 0, _now())
    whole = {r.url for r in store.media.read(spark).collect()}

    def dies(self, rows, buckets):
        rows.limit(0).write.mode("overwrite").parquet(self.path)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(Table, "replace", dies)
        with pytest.raises(RuntimeError):
            store.upsert_media(parts.media, "r2", 0, _now())
    assert store.upsert_media(parts.media, "r2", 0, _now()) is True
    assert {r.url for r in store.media.read(spark).collect()} == whole
    assert store.upsert_media(parts.media, "r2", 0, _now()) is False


def test_only_touched_buckets_are_rewritten_and_media_of_a_later_run_replace(spark):
    store = _store(spark)
    parts = process_pages(page_snapshot(spark), RULES).parts
    store.upsert_media(parts.media, "r1", 0, _now())
    files = lambda: {b: frozenset(f for f in some) for b, some in _files(spark, store.media.path).items()}
    first = files()
    one = store.media.read(spark).orderBy("url").limit(1).collect()[0]
    row = [(1, 1, 0, "video", one.url + "#again", "p2"), (2, 2, 0, "image", one.url, "p3"), (3, 3, 0, "", "u", "p")]
    batch = spark.createDataFrame(row, "page_id long, seq long, pos int, media_type string, url string, source_page_url string")
    store.upsert_media(batch, "r1", 1, _now())
    assert store.media.read(spark).where(F.col("url") == one.url).first().source_page_url == one.source_page_url
    store.upsert_media(batch, "r2", 0, F.lit("2025-01-01").cast("timestamp"))
    got = store.media.read(spark).where(F.col("url") == one.url).first()
    assert (got.media_type, got.source_page_url, got.id, got.created_at) == ("video", "p2", one.id, one.created_at)
    last = files()
    assert sum(last[b] != f for b, f in first.items()) == 1


def _files(spark, path):
    """Data files by bucket."""
    out = {}
    for r in spark.read.parquet(path).select("bucket", F.input_file_name().alias("f")).distinct().collect():
        out.setdefault(r.bucket, set()).add(r.f)
    return out


def test_product_without_a_house_is_dropped(spark):
    store = _store(spark)
    store_parts(store, process_pages(page_snapshot(spark).where("page_id >= 40"), RULES).parts, "r", now=_now())
    assert store.products.read(spark).count() == 0


def test_a_table_replaces_buckets_and_empties_them(spark):
    schema = spark.range(1).schema
    table = Table(work_dir(spark, "table"), schema, "id", buckets=4)
    assert table.read(spark).count() == 0
    table.replace(spark.range(20), range(4))
    assert sorted(r.id for r in table.read(spark).collect()) == list(range(20))
    one = table.touched(spark.range(1))
    kept = table.read(spark, one).count()
    table.replace(spark.range(0), one)
    assert table.read(spark).count() == 20 - kept and table.read(spark, one).count() == 0
    table.append(spark.range(1))
    assert table.read(spark, one).count() == 1


def test_deleting_all_houses_empties_the_tables(spark):
    store = _store(spark)
    ingest(spark, page_snapshot(spark), store, RULES, "r", now=_now())
    store.delete_wineries(store.wineries.read(spark).select("id"), "gone")
    tables = (store.wineries, store.products, store.milestones, store.members)
    assert [t.read(spark).count() for t in tables] == [0, 0, 0, 0]


def test_houses_as_child_rows_are_those_merged_whole(spark):
    """Batches of odd houses through the child tables, and through ``merge_wineries``, which holds lists and maps."""
    part = "page_id long, seq long, pos int, name string, website_url string, source_page_url string, description string, " \
        "family_spirit map<string,string>, history_timeline array<struct<year:string,event:string>>"
    twice = [("1900", "a"), ("1900 ", " a"), ("1900", "a")]
    batches = [
        [("A", "", {"x": "", "y": "1"}, twice), ("B", "d", {}, [("1", "b"), ("2", "c")]), ("b ", None, {"z": None, "w": "q"}, [("2", "c"), ("3", "d")])],
        [("A", "new", {"x": "", "y": "", "v": ""}, []), (" B", "e", {"w": "r"}, [("3", "d"), ("4", None)]), ("C", None, {}, twice)],
        [("C", None, {"m": "n"}, [("1950", "z"), *twice]), ("A", None, {"x": "2"}, [("1800", "first"), ("1900", "a")]), ("D", None, None, None)],
    ]
    store, whole, seq = _store(spark), None, 0
    whole = spark.createDataFrame([], WINERY)
    for n, batch in enumerate(batches):
        rows = [(seq + i, seq + i, 0, name, "w", f"p{seq + i}", d, m, t) for i, (name, d, m, t) in enumerate(batch)]
        seq += len(batch)
        parts = spark.createDataFrame(rows, part)
        assert store.upsert_wineries(parts, "r", n, _now()) is True
        assert store.upsert_wineries(parts, "r", n, _now()) is False
        whole = materialize(merge_wineries(group_wineries(parts), whole, _now()), "test")
        shown = lambda df: sorted((r.id, r.name, r.description, r.source_page_url, sorted(r.family_spirit.items(), key=str), [tuple(m) for m in r.history_timeline]) for r in df.collect())
        assert shown(store.houses()) == shown(whole)


def test_no_list_is_collected_on_the_way_into_the_store(spark):
    parts = process_pages(page_snapshot(spark).where("false"), RULES).parts.winery
    rows = H.keyed(parts)
    batch = H.heads(rows)
    for df in (batch, H.milestones(rows, batch, 0), H.members(rows, batch)):
        assert "collect_list" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_reused_run_says_so_and_losses_are_kept(spark):
    store = _store(spark)
    part = spark.createDataFrame([(1, 1, 0, "n", "https://h/p", "s", 123456.0)], "page_id long, seq long, pos int, name string, product_url string, source_page_url string, dosage_g_per_l double")
    blank = process_pages(page_snapshot(spark).limit(0), RULES).parts
    rows = part.select(*[c if c in part.columns else F.lit(None).cast(blank.product.schema[c].dataType).alias(c) for c in blank.product.columns])
    rows = rows.withColumn("winery_id", F.lit("w")) if "winery_id" in rows.columns else rows
    parts = replace(blank, product=rows)
    assert store_parts(store, parts, "r") is True
    assert [(r.product_url, r.field) for r in store.notes("overflows").collect()] == [("https://h/p", "dosage_g_per_l")]
    assert store_parts(store, parts, "r") is False


def test_a_cluster_without_a_shared_folder_is_refused():
    class Session:
        class sparkContext:
            master = "yarn"

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session, "x")


def test_delete_takes_products_along(spark, batch_result):
    store, _ = batch_result
    ids = store.wineries.read(spark).select("id")
    assert delete_cascade(store.products.read(spark), ids).count() == 0
    assert delete_cascade(store.products.read(spark), ids.where("id = ''")).count() == 4


def test_stream_dedupe_and_live_metrics(spark):
    folder = work_dir(spark, "log")
    log = spark.range(40).select(
        F.concat(F.lit("u"), F.col("id") % 5).alias("url"), (F.col("id") % 4 != 0).alias("ok"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
    )
    log.repartition(4).write.parquet(f"{folder}/log")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    for name, rows, mode in (
        ("seen_urls", stream_dedupe(stream, "url"), "append"), ("rates", live_metrics(stream), "complete"),
        ("seen_late", stream_dedupe(stream, "url", watermark=("ts", "1 hour")), "append"),
    ):
        q = rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("seen_urls").count() == 5 and spark.table("seen_late").count() == 5
    assert tuple(spark.table("rates").first()) == (40, 30, 10, 0.25)


def test_latest_attempts_over_batches_are_those_of_the_whole_log(spark):
    log = spark.range(50).select(F.col("id").alias("attempt_id"), F.timestamp_seconds(F.col("id") % 7).alias("ts"))
    kept = keep_latest(keep_latest(log.limit(0), log.where("attempt_id % 2 = 0"), 10), log.where("attempt_id % 2 = 1"), 10)
    whole = keep_latest(log.limit(0), log, 10)
    assert {r.attempt_id for r in kept.collect()} == {r.attempt_id for r in whole.collect()}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_stream_first_does_not_depend_on_the_order_of_files(spark, order):
    """Earlier arrivals that come later are corrections; nulls and repeated rows; a batch written again."""
    folder = work_dir(spark, "first")
    rows = [(i % 5 if i % 7 else None, i, f"v{i}") for i in range(60)] + [(1, 1, "v1")]
    schema = "k long, seq long, v string"
    for n, part in enumerate(order):
        spark.createDataFrame(rows[part::3], schema).coalesce(1).write.mode("append").parquet(f"{folder}/rows/part={n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/rows/*")
    write_corrections(stream_first(stream, F.col("k"), F.col("seq")), f"{folder}/first", f"{folder}/cp").awaitTermination()
    got = {(r.k, r.seq) for r in corrected(spark.read.parquet(f"{folder}/first")).collect()}
    want = {}
    for k, seq, _ in rows:
        want[k] = min(seq, want.get(k, seq))
    assert got == set(want.items())
