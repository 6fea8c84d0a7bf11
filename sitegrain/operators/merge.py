"""Folding partial records into whole ones.

All folds run over an explicit order, so a result never depends on how rows are spread.
Scalars fold by partial aggregation. Lists and maps are taken apart first and reduced per
item or key, so an entity with very many records costs one row per distinct item, not one
array of everything.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrain.functions.text import filled, is_empty, let, name_key, strip
from sitegrain.functions.urls import normalize_media_url, normalize_url
from sitegrain.schemas import PRODUCT, PRODUCT_DETAILS

TIMELINE_KEY = ("year", "event")
AWARD_KEY = ("title", "value")
ARRIVAL = ("seq", "page_id", "pos")
ORDER, DEAL = "__order", "__deal"


def arrival() -> Column:
    """The order of parts: page order, then place on the page."""
    return F.struct(*ARRIVAL)


# --- two values -----------------------------------------------------------------------

def merge_scalar(old: Column, new: Column, kind: T.DataType | None = None) -> Column:
    return F.when(is_empty(new, kind), old).otherwise(new)


def merge_map(old: Column, new: Column) -> Column:
    """Old keys stay, a shared key takes the new value unless empty, a new key needs a value."""
    nothing = F.create_map().cast("map<string,string>")

    def build(o: Column) -> Column:
        kept = F.map_filter(F.coalesce(new, nothing), lambda k, v: filled(v) | F.map_contains_key(o, k))
        return F.map_zip_with(o, kept, lambda k, a, b: merge_scalar(a, b))

    return let(F.coalesce(old, nothing), build)


def item_key(item: Column, fields: Sequence[str]) -> list[Column]:
    return [strip(F.coalesce(item[f].cast("string"), F.lit(""))) for f in fields]


def merge_list(old: Column, new: Column, fields: Sequence[str] = TIMELINE_KEY) -> Column:
    """Old then new items; of items with the same key fields the first stays. Sorts, never compares all pairs."""

    def keyed(items: Column) -> Column:
        return F.array_sort(
            F.transform(
                items,
                lambda x, i: F.struct(F.struct(*item_key(x, fields)).alias("key"), i.alias("place"), x.alias("item")),
            )
        )

    def firsts(s: Column) -> Column:
        kept = F.filter(s, lambda x, i: (i == 0) | (x.key != F.get(s, i - 1).key))
        return F.array_sort(F.transform(kept, lambda x: F.struct(x.place.alias("place"), x["item"].alias("item"))))

    both = F.concat(F.coalesce(old, F.array()), F.coalesce(new, F.array()))
    return F.transform(let(keyed(both), firsts), lambda x: x["item"])


def merge_awards(old: Column, new: Column) -> Column:
    return merge_list(old, new, AWARD_KEY)


def merge_value(old: Column, new: Column, kind: T.DataType, fields: Sequence[str] = TIMELINE_KEY) -> Column:
    """The merge that fits the column type."""
    if isinstance(kind, T.MapType):
        return merge_map(old, new)
    if isinstance(kind, T.ArrayType):
        return merge_list(old, new, fields)
    return merge_scalar(old, new, kind)


# --- many rows ------------------------------------------------------------------------

def last_non_empty(value: Column, order: Column, kind: T.DataType | None = None) -> Column:
    """Aggregate: the last value that is not empty; without any, the first record's value."""
    return F.coalesce(F.max_by(value, F.when(filled(value, kind), order)), F.min_by(value, order))


def union_lists(rows: DataFrame, key: str, items: str, order: Column, fields: Sequence[str]) -> DataFrame:
    """``key, items``: all lists of a key in order, the first item of each item key only."""
    single = rows.select(key, order.alias("o"), F.posexplode(items).alias("i", "item"))
    keys = [k.alias(f"k{n}") for n, k in enumerate(item_key(F.col("item"), fields))]
    firsts = (
        single.select(key, *keys, F.struct("o", "i", "item").alias("s"))
        .groupBy(key, *[f"k{n}" for n in range(len(fields))])
        .agg(F.min("s").alias("s"))
    )
    ordered = F.array_sort(F.collect_list("s"))
    return firsts.groupBy(key).agg(F.transform(ordered, lambda s: s["item"]).alias(items))


def union_maps(rows: DataFrame, key: str, entries: str, order: Column) -> DataFrame:
    """``key, entries``: per map key the last value that is not empty."""
    single = rows.select(key, order.alias("o"), F.explode(entries).alias("k", "v")).where(filled(F.col("v")))
    values = single.groupBy(key, "k").agg(F.max(F.struct("o", "v")).alias("s"))
    pairs = F.collect_list(F.struct("k", F.col("s.v").alias("v")))
    return values.groupBy(key).agg(F.map_from_entries(pairs).alias(entries))


def merge_records(rows: DataFrame, key: str, order: Column, scalars: Sequence[str],
                  first: Sequence[str] = (), lists: Mapping[str, Sequence[str]] | None = None,
                  maps: Sequence[str] = ()) -> DataFrame:
    """One record per key, plus ``n_records``.

    ``first`` columns keep the first record's value, ``scalars`` fold to the last value that
    is not empty, ``lists`` (with their key fields) and ``maps`` are united. A key with one
    record keeps its list untouched, repeats included.

    The input is read once: records are dealt by key while they are narrow, as a folded row keeps the
    order once for every scalar; Spark splits the rows of a key with very many records among tasks.
    There each record becomes a row of its scalars and a row for every list item and map entry, tagged
    by column. These are combined per key, tag and item before they are dealt, so a key with very many
    records costs a row per distinct item and task, and then meet once by key.
    """
    lists = lists or {}
    # By the key's hash: dealt by the key itself, the rows of one key would have to stay in one task.
    needed = dict.fromkeys([key, *first, *scalars, *lists, *maps])
    rows = rows.select(*needed, order.alias(ORDER), F.xxhash64(key).alias(DEAL)).hint("rebalance", DEAL)
    order = F.col(ORDER)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    structured = [*lists, *maps]
    width = max([len(f) for f in lists.values()] + [1])
    none = F.lit(None).cast("string")

    def tagged(tag: int, names: Sequence[Column], place: Column, **parts: Column) -> Column:
        keys = [*names, *[none] * (width - len(names))]
        values = [parts.get(n, F.lit(None).cast(t)).alias(n) for n, t in types.items()]
        return F.struct(F.lit(tag).alias("tag"), *[k.alias(f"k{n}") for n, k in enumerate(keys)], place.alias("place"), *values)

    record = F.struct(*first, *scalars, *structured)
    types = {"record": rows.select(record).schema[0].dataType}
    types |= {f"item_{c}": kinds[c].elementType for c in lists} | {f"value_{c}": kinds[c].valueType for c in maps}
    def listed(tag: int, c: str) -> Column:
        return F.transform(c, lambda x, i: tagged(tag, item_key(x, lists[c]), i, **{f"item_{c}": x}))

    def mapped(tag: int, c: str) -> Column:
        entries = F.filter(F.map_entries(c), lambda e: filled(e.value))
        return F.transform(entries, lambda e: tagged(tag, [e.key], F.lit(0), **{f"value_{c}": e.value}))

    offers = [F.array(tagged(0, [], F.lit(0), record=record))]
    offers += [(listed if c in lists else mapped)(tag, c) for tag, c in enumerate(structured, 1)]
    offers = [F.coalesce(o, F.array().cast(rows.select(offers[0]).schema[0].dataType)) for o in offers]
    spread = rows.select(key, order.alias("o"), F.explode(F.concat(*offers)).alias("t")).select(key, "o", "t.*")

    names = ["tag", *[f"k{n}" for n in range(width)]]
    folds = [F.min_by("record", "o").alias("head"), F.count("record").alias("n")]
    folds += [F.max_by(f"record.{c}", F.when(filled(F.col(f"record.{c}"), kinds[c]), F.col("o"))).alias(f"last_{c}") for c in scalars]
    folds += [F.min(F.when(F.col("tag") == 1 + n, F.struct("o", "place", f"item_{c}"))).alias(f"item_{c}") for n, c in enumerate(lists)]
    folds += [F.max(F.when(F.col("tag") == 1 + len(lists) + n, F.struct("o", f"value_{c}"))).alias(f"value_{c}") for n, c in enumerate(maps)]
    items = spread.groupBy(key, *names).agg(*folds)

    def only(c: str) -> Column:
        """The value of the one row of scalars."""
        return F.first(F.when(F.col("tag") == 0, F.col(c)), ignorenulls=True)

    met = items.groupBy(key).agg(
        only("head").alias("head"), F.sum("n").alias("n_records"), *[only(f"last_{c}").alias(c) for c in scalars],
        *[F.collect_list(f"item_{c}").alias(f"item_{c}") for c in lists],
        *[F.collect_list(F.when(F.col(f"value_{c}").isNotNull(), F.struct("k0", f"value_{c}.value_{c}"))).alias(f"value_{c}") for c in maps],
    )

    def united(c: str) -> Column:
        if c in lists:
            many = F.transform(F.array_sort(f"item_{c}"), lambda s: s[f"item_{c}"])
            single = F.coalesce(F.col(f"head.{c}"), F.array().cast(kinds[c]))
            return F.when(F.col("n_records") == 1, single).otherwise(many)
        base = F.coalesce(F.col(f"head.{c}"), F.create_map().cast(kinds[c]))
        return F.map_zip_with(base, F.map_from_entries(f"value_{c}"), lambda k, a, b: F.coalesce(b, a))

    return met.select(
        key, *(F.col(f"head.{c}").alias(c) for c in first), *(F.coalesce(c, f"head.{c}").alias(c) for c in scalars),
        "n_records", *(united(c).alias(c) for c in structured),
    )


def first_per_key(rows: DataFrame, key: Column, order: Column) -> DataFrame:
    """The first row of each key. Combined before the shuffle, so a hot key is cheap."""
    kept = rows.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*rows.columns), order).alias("_row"))
    return kept.select("_row.*")


# --- records of this domain -----------------------------------------------------------

def required(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows with a non-empty value in every named column."""
    for c in columns:
        rows = rows.where(filled(F.col(c)))
    return rows


def dedupe_wineries(parts: DataFrame) -> DataFrame:
    return first_per_key(parts, normalize_url(F.col("source_page_url")), arrival())


def dedupe_products(parts: DataFrame) -> DataFrame:
    key = F.concat(normalize_url(F.col("product_url")), F.lit("::"), normalize_url(F.col("source_page_url")))
    return first_per_key(parts, key, arrival())


def dedupe_media(parts: DataFrame) -> DataFrame:
    return first_per_key(parts, normalize_media_url(F.col("url")), arrival())


def group_wineries(parts: DataFrame, order: Column | None = None) -> DataFrame:
    """Whole houses by name, whatever its case and padding; the first spelling stays."""
    rows = required(parts, "name", "website_url", "source_page_url").withColumn("name_key", name_key(F.col("name")))
    return merge_records(
        rows, "name_key", arrival() if order is None else order,
        scalars=["website_url", "source_page_url", "description"], first=["name"],
        lists={"history_timeline": TIMELINE_KEY}, maps=["family_spirit"],
    )


def group_products(parts: DataFrame, order: Column | None = None) -> DataFrame:
    """Whole products by normalised URL. ``winery_id`` is optional."""
    rows = required(parts, "name", "product_url", "source_page_url")
    rows = rows.withColumn("url_key", normalize_url(F.col("product_url")))
    if "winery_id" not in rows.columns:
        rows = rows.withColumn("winery_id", F.lit(None).cast("string"))
    scalars = [c for c in ("winery_id", "name", "product_url", "source_page_url", *PRODUCT_DETAILS)
               if c != "awards_and_ratings"]
    return merge_records(
        rows, "url_key", arrival() if order is None else order, scalars=scalars,
        lists={"awards_and_ratings": AWARD_KEY},
    )


def completeness_score(columns: Sequence[str] = PRODUCT_DETAILS, kinds: Mapping[str, T.DataType] | None = None) -> Column:
    """How many of a product's detail fields hold a value."""
    kinds = kinds or {f.name: f.dataType for f in PRODUCT.fields}
    score = F.lit(0)
    for c in columns:
        score = score + filled(F.col(c), kinds.get(c)).cast("int")
    return score
