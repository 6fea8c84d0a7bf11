"""Following links over a page table, wave by wave."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sitegrain.functions.urls import canonical_page_url, in_scope, normalize_url
from sitegrain.rules import SiteRules
from sitegrain.session import work_dir

# Rows carry their wave; ``step`` is the part they were written in, which holds one wave or, under a budget, many.
FOUND = "key string, wave int"
DONE = "canon string, page_id long, seq long, key string, wave int"
FEW = 10_000  # so many URLs are ranked by sorting them


@dataclass(frozen=True)
class Closure:
    """``found``: every URL that was queued, with the wave that found it. ``done``: the pages processed.

    ``taken`` tells, under a budget, which wave took which URL.
    """

    found: DataFrame
    done: DataFrame
    links: DataFrame
    n_seeds: int
    taken: DataFrame | None = None


def new_urls(candidates: DataFrame, *known: DataFrame) -> DataFrame:
    """The distinct candidate keys that no known table holds."""
    out = candidates.select("key").distinct()
    for k in known:
        out = out.join(k.select("key"), "key", "left_anti")
    return out


def count_new(candidates: DataFrame, *known: DataFrame) -> DataFrame:
    """How many URLs a bulk add would queue."""
    return new_urls(candidates, *known).agg(F.count("*").alias("added"))


def page_index(pages: DataFrame, rules: SiteRules) -> DataFrame:
    """``key, page_id, seq, canon``: the first snapshot of each URL, narrow columns only."""
    first = F.min(F.struct("seq", "page_id", canonical_page_url(F.col("final_url"), rules.host).alias("canon")))
    grouped = pages.groupBy(normalize_url(F.col("url")).alias("key")).agg(first.alias("f"))
    return grouped.select("key", "f.page_id", "f.seq", "f.canon")


def join_pages(frontier: DataFrame, index: DataFrame) -> DataFrame:
    """The snapshots of the frontier's URLs; a URL without one is a failed fetch."""
    return frontier.join(index, "key")


class Buckets:
    """Tables of the catalog over files below ``state``, bucketed by the column they are joined on.

    Spark joins two of them on that column without an exchange, and deals only the other side of a
    join with anything else. Rows come in parts, one partition ``step`` for each.
    """

    def __init__(self, spark: SparkSession, state: str, buckets: int):
        self.spark, self.state, self.buckets, self.tag = spark, state, buckets, uuid.uuid4().hex[:12]
        self.names: set[str] = set()

    def write(self, name: str, rows: DataFrame, key: str, step: int | None = None) -> int:
        """Add rows and return their number."""
        counted = Observation()
        # Above the exchange: what lies below is left out of the plan when a step turns out empty.
        dealt = rows.repartition(self.buckets, key).observe(counted, F.count(F.lit(1)).alias("n"))
        self._append(name, dealt, key, step)
        return counted.get["n"]

    def create(self, name: str, schema: str, key: str) -> None:
        """An empty table with a first part that no step has."""
        self._append(name, self.spark.createDataFrame([], schema), key, -1)

    def _append(self, name: str, rows: DataFrame, key: str, step: int | None) -> None:
        writer = (rows if step is None else rows.withColumn("step", F.lit(step))).write.format("parquet")
        if step is not None:
            writer = writer.partitionBy("step")
        writer = writer.bucketBy(self.buckets, key).sortBy(key).option("path", f"{self.state}/{name}")
        writer.mode("append").saveAsTable(f"{name}_{self.tag}")
        self.names.add(name)

    def read(self, name: str, step: int | None = None) -> DataFrame:
        rows = self.spark.table(f"{name}_{self.tag}")
        return rows if step is None else rows.where(F.col("step") == step)

    def close(self) -> None:
        """Take the tables out of the catalog; their files stay."""
        for name in self.names:
            self.spark.sql(f"drop table if exists {name}_{self.tag}")


def first_in_line(waiting: DataFrame, budget: int) -> DataFrame:
    """The first ``budget`` of ``wave, key``, by wave, then by a hash of the key.

    The last one's place is found by counting: waves first, then ever longer prefixes of the hash in
    the wave that is cut, until few enough rows are left to sort. All others are told by a filter.
    """
    rows = waiting.withColumn("hash", F.md5("key"))

    def cut(counts: dict) -> tuple | None:
        nonlocal budget
        for place in sorted(counts):
            if counts[place] > budget:
                return place, counts[place]
            budget -= counts[place]
        return None

    def counted(some: DataFrame, place) -> dict:
        return {r["p"]: r["n"] for r in some.groupBy(place.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}

    split = cut(counted(rows, F.col("wave")))
    if split is None:
        return waiting
    (wave, left), prefix = split, ""
    rest = rows.where(F.col("wave") == wave)
    while left > FEW and len(prefix) < 32:
        under = rest.where(F.col("hash").startswith(prefix))
        prefix, left = cut(counted(under, F.substring("hash", 1, len(prefix) + 2)))
    whole = rows.where((F.col("wave") < wave) | ((F.col("wave") == wave) & (F.substring("hash", 1, len(prefix)) < prefix)))
    ranked = rest.where(F.col("hash").startswith(prefix)).withColumn(
        "rank", F.row_number().over(Window.partitionBy("wave").orderBy("hash", "key"))
    )
    return whole.select("wave", "key").unionByName(ranked.where(F.col("rank") <= budget).select("wave", "key"))


def in_waves(line: DataFrame, budget: int, first: int, folder: str, parts: int) -> DataFrame:
    """``key, wave``: the rows ``wave, key`` in line order, ``budget`` of them to a wave, counted from ``first``.

    Dealt by ranges of the order and written, so that places are counted range by range and only the
    sizes of the ranges reach the driver.
    """
    spark, order = line.sparkSession, ["wave", "hash", "key"]
    dealt = line.withColumn("hash", F.md5("key")).repartitionByRange(parts, *order)
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(folder)
    rows = spark.read.schema("wave int, key string, hash string, part int").parquet(folder)
    before, offsets = 0, []
    for part, n in sorted(tuple(r) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((part, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, before long"))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1).join(starts, "part")
    return placed.select("key", (F.floor((F.col("before") + F.col("place")) / budget) + first).cast("int").alias("wave"))


def expand_frontier(spark: SparkSession, pages: DataFrame, links: DataFrame, seeds: DataFrame,
                    rules: SiteRules, budget: int | None = None, state: str | None = None,
                    buckets: int | None = None) -> Closure:
    """All pages reached from the seeds over in-scope links.

    ``pages`` needs ``page_id, url, final_url, seq``; ``links`` holds ``page_id, url`` of all
    candidate pages, so HTML is read before, once. A URL enters once. Of pages with one
    canonical name only the first that is reached is processed; the others add no links.
    ``budget`` limits how many URLs one wave takes (see ``first_in_line``); the rest wait their turn.
    What a wave finds queues behind all that wait, so the waves that those waiting fill are known
    beforehand and are done in one step: steps grow with the depth of the links, not with the waves.

    The index of pages, the links, and what was found and done are bucketed by the column they are
    joined on, so a wave moves its own rows only. Each wave is written below ``state`` (the cluster's
    shared folder), which ends lineage. Hot link targets are reduced to one row before any join.
    Only row counts reach the driver.
    """
    state = state or work_dir(spark, "frontier")
    tables = Buckets(spark, state, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        return _expand(spark, tables, pages, links, seeds, rules, budget)
    finally:
        tables.close()


def _expand(spark: SparkSession, tables: Buckets, pages: DataFrame, links: DataFrame, seeds: DataFrame,
            rules: SiteRules, budget: int | None) -> Closure:
    tables.write("index", page_index(pages, rules), "key")
    scoped = links.where(in_scope(F.col("url"), rules.scope)).select("page_id", F.col("url").alias("key")).distinct()
    tables.write("links", scoped, "page_id")
    n_seeds = seeds.count()
    start = F.lit(0).alias("wave")
    waiting = tables.write("found", seeds.select("key").distinct().select("key", start), "key", 0)
    tables.create("done", DONE, "canon")
    tables.create("taken", FOUND, "key")
    step = wave = 0
    while waiting:
        waves = 1 if budget is None else max(1, waiting // budget)
        if budget is None:
            frontier = tables.read("found", step)
        else:
            left = tables.read("found").join(tables.read("taken").select("key"), "key", "left_anti").select("wave", "key")
            head = first_in_line(left, waves * budget)
            if waves == 1:
                numbered = head.select("key", F.lit(wave).alias("wave"))
            else:
                numbered = in_waves(head, budget, wave, f"{tables.state}/line-{step}", tables.buckets)
            waiting -= tables.write("taken", numbered, "key", step)
            frontier = tables.read("taken", step)
        first = F.min(F.struct("wave", "seq", "page_id", "key")).alias("f")
        reached = join_pages(frontier.select("key", "wave"), tables.read("index")).groupBy("canon").agg(first)
        fresh = reached.join(tables.read("done").select("canon"), "canon", "left_anti")
        tables.write("done", fresh.select("canon", "f.page_id", "f.seq", "f.key", "f.wave"), "canon", step)
        current = tables.read("done", step).select("page_id", "wave")
        targets = tables.read("links").join(current, "page_id").groupBy("key").agg((F.min("wave") + 1).alias("wave"))
        added = tables.write("found", targets.join(tables.read("found").select("key"), "key", "left_anti"), "key", step + 1)
        waiting = added if budget is None else waiting + added
        step, wave = step + 1, wave + waves

    def written(name: str, schema: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(f"{tables.state}/{name}")
        return rows.drop("step")

    return Closure(
        written("found", FOUND), written("done", DONE), written("links", "page_id long, key string"), n_seeds,
        None if budget is None else written("taken", FOUND),
    )


def frontier_accounting(closure: Closure) -> DataFrame:
    """``seen, unique_urls, duplicates``: every add counts, a known URL is a duplicate."""
    offered = closure.links.join(closure.done.select("page_id"), "page_id", "left_semi")
    seen = offered.agg((F.count("*") + F.lit(closure.n_seeds)).alias("seen"))
    unique = closure.found.agg(F.count("*").alias("unique_urls")).scalar()
    return seen.select("seen", unique.alias("unique_urls"), (F.col("seen") - unique).alias("duplicates"))
