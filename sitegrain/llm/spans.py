"""Positions of pattern matches as plain column expressions.

Spark's regular expression functions give the matches and, by ``split``, what lies between them;
their lengths add up to positions in code points. The sums are a window over the matches of one
document, so a text with very many matches costs in proportion to their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegrain.llm.common import whole_text

MATCH = "array<struct<kind:int,idx:int,value:string,gap:int,before:string,after:string>>"


def matches(kind: int, gate: Column, pattern: str, context: int = 0) -> Column:
    """The leftmost non-overlapping matches of ``pattern`` in the column ``text``.

    ``gate`` is a cheap test that every text with a match passes. ``gap`` counts the characters
    since the last match; ``before`` and ``after`` are up to ``context`` characters around.
    """
    text = F.col("text")
    pieces = F.split(text, pattern, -1)
    found = F.transform(
        F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
            pieces.alias("piece"),
            F.slice(pieces, F.lit(2), F.size(pieces)).alias("next"),
        ),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("idx"),
            m["value"].alias("value"),
            F.length(m["piece"]).alias("gap"),
            (F.right(m["piece"], F.lit(context)) if context else F.lit("")).alias("before"),
            (F.left(m["next"], F.lit(context)) if context else F.lit("")).alias("after"),
        ),
    )
    return F.when(gate & F.rlike(text, F.lit(pattern)), F.filter(found, lambda m: m["value"].isNotNull())).otherwise(
        F.array().cast(MATCH)
    )


def located(docs: DataFrame, kinds: list[Column]) -> DataFrame:
    """A row for each match with ``start`` and ``end``, and one with null ``kind`` for a document without any.

    Columns: uid (one per row of ``docs``), doc_id, kind, idx, value, before, after, start, end.
    Rows of one document lie together, by ``uid``.
    """
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.concat(*kinds).alias("found"))
        .select("uid", "doc_id", F.explode_outer("found").alias("m"))
        .select("uid", "doc_id", "m.*")
        .repartition("uid")
    )
    upto = Window.partitionBy("uid", "kind").orderBy("idx")
    size = F.length("value")
    end = F.sum(F.col("gap") + size).over(upto)
    return rows.select(
        "uid", "doc_id", "kind", "idx", "value", "before", "after",
        (end - size).alias("start"), end.alias("end"),
    )


def span_list(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end``, comma-joined, of sorted structs with kind, start and end."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def apart_from(rows: DataFrame, base: Column) -> DataFrame:
    """Add ``free``: whether a span overlaps no span for which ``base`` holds. Rows lie together by ``uid``."""
    forth = Window.partitionBy("uid").orderBy("start", F.when(base, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, -1)
    back = (
        Window.partitionBy("uid").orderBy(F.desc("start"), F.when(base, 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, -1)
    )
    ended = F.coalesce(F.max(F.when(base, F.col("end"))).over(forth), F.lit(0))
    begins = F.min(F.when(base, F.col("start"))).over(back)
    return rows.withColumn("__ended", ended).withColumn("__begins", begins).withColumn(
        "free", (F.col("__ended") <= F.col("start")) & (F.col("__begins").isNull() | (F.col("__begins") >= F.col("end")))
    ).drop("__ended", "__begins")


def report(rows: DataFrame, chosen: Column, kinds: tuple[str, ...], base_kinds: int, order: tuple[str, ...]) -> DataFrame:
    """One row per document: counts of the base kinds, base_sha256 and spans, sorted by ``order``.

    ``rows`` is what ``located`` gives; the first ``base_kinds`` kinds are the base.
    """
    span = F.struct(*order, *(n for n in ("kind", "start", "end") if n not in order))
    lists = rows.groupBy("uid", "doc_id").agg(F.array_sort(F.collect_list(F.when(chosen, span))).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] < base_kinds)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return lists.select(
        "doc_id",
        *(count(k).alias(f"n_{kinds[k]}") for k in range(base_kinds)),
        F.sha2(span_list(base, kinds), 256).alias("base_sha256"),
        span_list(F.col("spans"), kinds).alias("spans"),
    )


def hash_share(value: Column, wanted: int, total: int) -> Column:
    """A test that about ``wanted`` of ``total`` rows pass, by a hash of ``value``: the same ones each time.

    It needs no sort, unlike a limit in hash order, so no task meets the rows of all others.
    """
    share = 1.0 if total <= wanted else wanted / total
    return F.pmod(F.xxhash64(value, F.lit(11)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
