"""The stored entities, and how batches of parts come into them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrain.functions.text import strip
from sitegrain.operators import houses as H
from sitegrain.operators.merge import group_products
from sitegrain.operators.upsert import (
    default_winery_id, delete_cascade, merge_media, merge_products, prepare_media, resolve_parent, winery_ids,
)
from sitegrain.rules import SiteRules
from sitegrain.schemas import MEDIA, PRODUCT
from sitegrain.session import work_dir
from sitegrain.sources.tables import Table, exists

# Media rows remember the run that wrote them: within a run the first one stays.
STORED_MEDIA = T.StructType([*MEDIA.fields, T.StructField("run_id", T.StringType())])


class EntityStore:
    """The entity tables, houses with child tables, the list of pages a run has processed, and the batches taken.

    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, rules: SiteRules, buckets: int = 64) -> None:
        self.spark, self.rules, self.path = spark, rules, path
        pages = T.StructType().add("canon", "string").add("run_id", "string").add("page_id", "long").add("batch_id", "long")
        self.wineries = Table(f"{path}/wineries", H.HOUSE, "name", max(1, buckets // 8))
        self.milestones = Table(f"{path}/milestones", H.MILESTONE, "item", buckets)
        self.members = Table(f"{path}/members", H.MEMBER, "item", buckets)
        self.products = Table(f"{path}/products", PRODUCT, "product_url", buckets)
        self.media = Table(f"{path}/media", STORED_MEDIA, "url", buckets)
        self.pages = Table(f"{path}/pages", pages, "canon", buckets)

    def taken(self, table: Table, run_id: str, batch_id: int) -> bool:
        """Whether the table took this batch of the run, or a later one."""
        folder = f"{self.path}/batches"
        if not exists(self.spark, folder):
            return False
        rows = self.spark.read.schema("path string, run_id string, batch_id long").parquet(folder)
        mine = (F.col("path") == table.path) & (F.col("run_id") == run_id) & (F.col("batch_id") >= batch_id)
        return not rows.where(mine).isEmpty()

    def take(self, table: Table, run_id: str, batch_id: int) -> None:
        """Remember that the table took the batch."""
        row = self.spark.createDataFrame([(table.path, run_id, batch_id)], "path string, run_id string, batch_id long")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/batches")

    def _upsert(self, table: Table, run_id: str, batch_id: int, merge: Callable[[], tuple[DataFrame, list[int]]]) -> bool:
        """Merge a batch into the table; returns whether it was taken: one stored before is not.

        The merged buckets are written aside first. A run that ends while they are moved into place
        is completed from there when the batch comes again; its old rows are not needed any more.
        """
        if self.taken(table, run_id, batch_id):
            return False
        aside = f"{table.path}-merged/{run_id}-{batch_id}"
        if not exists(self.spark, f"{aside}/touched/_SUCCESS"):
            rows, touched = merge()
            rows.write.mode("overwrite").parquet(f"{aside}/rows")
            marks = self.spark.createDataFrame([(b,) for b in touched], "bucket int")
            marks.coalesce(1).write.mode("overwrite").parquet(f"{aside}/touched")
        else:
            touched = [r.bucket for r in self.spark.read.parquet(f"{aside}/touched").collect()]
        table.replace(self.spark.read.schema(table.schema).parquet(f"{aside}/rows"), touched)
        self.take(table, run_id, batch_id)
        return True

    def _stored(self, batch: DataFrame) -> DataFrame:
        """A batch is read twice: for the buckets it touches, and for the merge."""
        folder = work_dir(self.spark, "batch")
        batch.write.parquet(folder)
        return self.spark.read.schema(batch.schema).parquet(folder)

    def houses(self) -> DataFrame:
        """Whole houses, their lists and maps built for the reader."""
        return H.assembled(*(t.read(self.spark) for t in (self.wineries, self.milestones, self.members)))

    def _generation(self) -> int:
        """How many batches of houses were taken before: orders what they brought."""
        folder = f"{self.path}/batches"
        if not exists(self.spark, folder):
            return 0
        return self.spark.read.parquet(folder).where(F.col("path") == self.wineries.path).count()

    def upsert_wineries(self, parts: DataFrame, run_id: str, batch_id: int, now: Column | None = None) -> bool:
        """Milestones and members first: a house is seen once all of it is there."""
        if self.taken(self.wineries, run_id, batch_id):
            return False
        rows = H.keyed(parts)
        batch = self._stored(H.heads(rows))
        touched = self.wineries.touched(batch.select("name"), batch.select(strip(F.col("name")).alias("name")))
        known = self.wineries.read(self.spark, touched)
        names = self._stored(H.renamed(batch, known))
        none = names.isEmpty()

        def children(table: Table, new: DataFrame, moved: Callable, merge: Callable) -> Callable:
            def run() -> tuple[DataFrame, list[int]]:
                fresh = self._stored(new)
                whole = table.read(self.spark)
                along = whole.where("false") if none else self._stored(moved(names, whole))
                some = table.touched(fresh.select("item"), along.select("item"))
                return merge(fresh, along, table.read(self.spark, some)), some

            return run

        milestones = H.milestones(rows, batch, self._generation())
        self._upsert(self.milestones, run_id, batch_id, children(self.milestones, milestones, H.moved_milestones, H.merge_children))
        members = H.new_members(H.members(rows, batch), known)
        self._upsert(self.members, run_id, batch_id, children(self.members, members, H.moved_members, H.replace_children))
        return self._upsert(self.wineries, run_id, batch_id, lambda: (H.merge_heads(batch, known, _now(now)), touched))

    def upsert_products(self, parts: DataFrame, run_id: str, batch_id: int, now: Column | None = None) -> bool:
        def merge() -> tuple[DataFrame, list[int]]:
            default = default_winery_id(winery_ids(self.wineries.read(self.spark)), self.rules)
            batch = self._stored(resolve_parent(group_products(parts), default))
            touched = self.products.touched(batch.select("url_key"))
            return merge_products(batch, self.products.read(self.spark, touched), _now(now)), touched

        return self._upsert(self.products, run_id, batch_id, merge)

    def upsert_media(self, parts: DataFrame, run_id: str, batch_id: int, now: Column | None = None) -> bool:
        def merge() -> tuple[DataFrame, list[int]]:
            batch = self._stored(prepare_media(parts))
            touched = self.media.touched(batch.select("url"))
            return merge_media(batch, self.media.read(self.spark, touched), _now(now), run_id), touched

        return self._upsert(self.media, run_id, batch_id, merge)

    def note(self, name: str, rows: DataFrame, run_id: str, batch_id: int) -> None:
        """Keep what a batch reports (errors, overflows, links); a batch that has been kept whole is left alone."""
        folder = f"{self.path}/{name}/run_id={run_id}/batch_id={batch_id}"
        if not exists(self.spark, f"{folder}/_SUCCESS"):
            rows.write.mode("overwrite").parquet(folder)

    def notes(self, name: str) -> DataFrame:
        """All rows kept under a name, with run_id and batch_id."""
        return self.spark.read.parquet(f"{self.path}/{name}")

    def flushes(self) -> DataFrame:
        """Per run the batches written, and the records handed to the writer by entity."""
        return self.notes("flushes").groupBy("run_id").agg(
            F.count_distinct("batch_id").alias("batch_flushes"), *[F.sum(f"written_{n}").alias(f"written_{n}") for n in ("wineries", "products", "media")]
        )

    def delete_wineries(self, ids: DataFrame, run_id: str, batch_id: int = 0) -> None:
        """Remove houses and, with them, their products.

        Houses go last: if a run ends in between, the same call finishes the job.
        """
        def products() -> tuple[DataFrame, list[int]]:
            return delete_cascade(self.products.read(self.spark), ids), list(range(self.products.buckets))

        def of_houses(table: Table, key: str, gone: DataFrame) -> Callable[[], tuple[DataFrame, list[int]]]:
            return lambda: (table.read(self.spark).join(gone, key, "left_anti").select(*table.schema.fieldNames()), list(range(table.buckets)))

        gone = self._stored(self.wineries.read(self.spark).join(ids.select("id"), "id", "left_semi").select("name"))
        self._upsert(self.products, run_id, batch_id, products)
        for table in (self.milestones, self.members, self.wineries):
            self._upsert(table, run_id, batch_id, of_houses(table, "name", gone))


def _now(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now
