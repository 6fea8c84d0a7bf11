"""Helpers shared by the pipeline operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitegrain.session import work_dir

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared one and read it back: lineage ends here."""
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block, put back after it."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def prefix_digits(rows: int, per_bucket: int = 50_000) -> int:
    """Hex digits of a hash prefix that leave about ``per_bucket`` rows in a bucket, two at least."""
    digits = 2
    while rows > per_bucket * 16**digits:
        digits += 1
    return digits


def running_start(df: DataFrame, group: str, bucket: str, order: list[str], amount: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the earlier rows of the same ``group``.

    Rows are ordered by ``bucket`` and then ``order``. A group is summed bucket by bucket
    first, so that one with a third of all rows spreads over its buckets; only one row for
    each bucket meets in the group's own window.
    """
    inner = Window.partitionBy(group, bucket).orderBy(*order)
    outer = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__amount", amount)
    base = (
        rows.groupBy(group, bucket).agg(F.sum("__amount").alias("__sum"))
        .select(group, bucket, F.coalesce(F.sum("__sum").over(outer), F.lit(0)).cast("long").alias("__base"))
    )
    before = F.sum("__amount").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__amount")
    return (
        rows.withColumn("__before", before.cast("long"))
        .join(base, [group, bucket])
        .withColumn(out, F.col("__base") + F.col("__before"))
        .drop("__amount", "__before", "__base")
    )


HOT = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int, how: str = "left") -> DataFrame:
    """Join to each of ``total`` stored rows the row of its group, which holds the group's size in ``count``.

    Groups of more than a thousandth of all rows are broadcast: there are fewer than a thousand of
    them. So no task meets the rows of a hot group, and any other is small.
    """
    hot, cold = (groups.where(f"{count} {sign} {total // HOT}") for sign in (">", "<="))
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(cold, key, how))


def text_sha() -> Column:
    """The SHA-256 of the text's bytes."""
    return F.unhex(F.sha2(whole_text(), 256))


def keep_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """A row of ``docs`` for each pair of ``doc_id`` and digest of the text in ``wanted``'s two columns.

    ``wanted`` lists a pair as often as ``docs`` holds it. Only rows of repeated pairs are compared by
    their texts.
    """
    pairs = wanted.toDF("__id", "__sha").groupBy("__id", "__sha").count()
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))

    def rows(some: DataFrame) -> DataFrame:
        return docs.join(some, docs["doc_id"].eqNullSafe(some["__id"]) & (digest == some["__sha"]), "left_semi")

    name = "_" + max(docs.columns, key=len)  # no column of docs
    again = rows(pairs.where("count > 1")).withColumn(name, whole_text()).dropDuplicates(["doc_id", name]).drop(name)
    return rows(pairs.where("count = 1")).unionByName(again)
