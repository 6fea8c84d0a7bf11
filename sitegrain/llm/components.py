"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its smallest one, itself included."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
    return both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src <> dst").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    low = down.groupBy("src").agg(F.min("dst").alias("low"))
    tied = down.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return tied.unionByName(low.withColumnRenamed("low", "dst")).where("src <> dst").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component. ``edges``: src, dst (longs).

    A node's minimum is combined before the shuffle, so a star with a third of all edges sends one
    row for each task to it; the join back is on narrow rows, which Spark splits where they are
    skewed. Each round is written, which ends its lineage; rounds grow with the logarithm of a
    component's size.
    """
    now = stored(spark, edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "components")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")), F.lit(0))).first()
        if state == seen or not state[0]:
            return now.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        seen = state
        now = stored(spark, _small_star(_large_star(now)), "components")
