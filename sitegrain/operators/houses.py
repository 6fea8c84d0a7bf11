"""Houses with their milestones and members as child rows.

A list item or map entry is a row of its own, keyed by house and item, on the way into the store
and in it; lists and maps are built on reading only. So a house with very many milestones is many
small rows in many buckets, and no task writes them as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegrain.functions.text import filled, name_key, strip
from sitegrain.operators.merge import ARRIVAL, TIMELINE_KEY, arrival, item_key, merge_records, merge_scalar, required
from sitegrain.operators.upsert import stable_id, stamps
from sitegrain.schemas import WINERY

SCALARS = ("website_url", "source_page_url", "description")
CHILDREN = ("family_spirit", "history_timeline")
# ``single``: made by one record, so that its repeated milestones count.
HOUSE = T.StructType([f for f in WINERY.fields if f.name not in CHILDREN]).add("single", "boolean")
PLACE = {"generation": "long", "seq": "long", "page_id": "long", "pos": "integer", "i": "integer"}


def _schema(**fields: str) -> T.StructType:
    out = T.StructType()
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


MILESTONE = _schema(item="string", name="string", repeat="integer", **PLACE, year="string", event="string")
MEMBER = _schema(item="string", name="string", member="string", text="string")


def keyed(parts: DataFrame) -> DataFrame:
    """Complete house parts with their folded name."""
    return required(parts, "name", "website_url", "source_page_url").withColumn("name_key", name_key(F.col("name")))


def heads(rows: DataFrame) -> DataFrame:
    """A row per house of the batch, without lists and maps."""
    return merge_records(rows, "name_key", arrival(), scalars=SCALARS, first=["name"])


def _item(*parts: Column) -> Column:
    """The key of a child row."""
    return F.sha2(F.to_json(F.array(*parts)), 256).alias("item")


def _named(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """With the name under which the house is written."""
    return rows.join(batch.select("name_key", "name"), "name_key")


def milestones(rows: DataFrame, batch: DataFrame, generation: int) -> DataFrame:
    """The first occurrence of each milestone in the batch; ``repeat`` counts those within one record."""
    item = F.col("m")
    k0, k1 = item_key(item, TIMELINE_KEY)
    single = rows.select("name_key", *ARRIVAL, F.posexplode("history_timeline").alias("i", "m"))
    within = Window.partitionBy("name_key", *ARRIVAL, "k0", "k1").orderBy("i")
    counted = single.withColumn("k0", k0).withColumn("k1", k1).withColumn("repeat", F.row_number().over(within) - 1)
    firsts = counted.groupBy("name_key", "k0", "k1", "repeat").agg(F.min(F.struct(*ARRIVAL, "i", "m")).alias("s"))
    return _named(firsts, batch).select(
        _item(F.col("name"), F.col("k0"), F.col("k1"), F.col("repeat").cast("string")), "name", "repeat",
        F.lit(generation).cast("long").alias("generation"), *[F.col(f"s.{c}") for c in (*ARRIVAL, "i")], "s.m.year", "s.m.event",
    )


def members(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """The last filled text of each member; ``held`` is false where only the house's first record names it, without a text."""
    single = rows.select("name_key", F.struct(*ARRIVAL).alias("o"), F.explode("family_spirit").alias("member", "text"))
    first = rows.groupBy("name_key").agg(F.min_by("family_spirit", F.struct(*ARRIVAL)).alias("m"))
    bare = first.select("name_key", F.explode("m").alias("member", "text")).where(~filled(F.col("text")))
    last = single.where(filled(F.col("text"))).groupBy("name_key", "member").agg(F.max(F.struct("o", "text")).alias("s"))
    held = last.select("name_key", "member", "s.text", F.lit(True).alias("held"))
    both = held.unionByName(bare.join(held, ["name_key", "member"], "left_anti").withColumn("held", F.lit(False)))
    return _named(both, batch).select(_item(F.col("name"), F.col("member")), "name", "member", "text", "held")


def renamed(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Houses found under their trimmed name and written under the name they came with: old and new name."""
    return batch.select(strip(F.col("name")).alias("old"), F.col("name").alias("new")).where("old <> new").join(
        stored.select(F.col("name").alias("old")), "old", "left_semi"
    )


def merge_heads(batch: DataFrame, stored: DataFrame, now: Column) -> DataFrame:
    """All stored houses with those of the batch merged in."""
    b, e = batch.alias("b"), stored.alias("e")
    new = F.col("e.name").isNull()
    values = [F.when(new, F.col(f"b.{c}")).otherwise(merge_scalar(F.col(f"e.{c}"), F.col(f"b.{c}"))).alias(c) for c in SCALARS]
    found = b.join(e, strip(F.col("b.name")) == F.col("e.name"), "left").select(
        F.coalesce(F.when(F.col("b.name") == F.col("e.name"), F.col("e.id")), stable_id(F.col("b.name"))).alias("id"), "b.name", *values,
        *stamps("e", now, False), (new & (F.col("b.n_records") == 1)).alias("single"),
    )
    rest = stored.join(found.select("name"), "name", "left_anti")
    return found.unionByName(rest.select(*found.columns)).select(*HOUSE.fieldNames())


def moved_milestones(names: DataFrame, whole: DataFrame) -> DataFrame:
    """The milestones of renamed houses under their new name."""
    keys = [k.alias(n) for k, n in zip(item_key(F.struct("year", "event"), TIMELINE_KEY), ("k0", "k1"), strict=True)]
    moved = whole.where("repeat = 0").join(names, F.col("name") == F.col("old")).select("*", *keys).withColumn("name", F.col("new"))
    return moved.withColumn("item", _item(F.col("name"), F.col("k0"), F.col("k1"), F.col("repeat").cast("string"))).select(*MILESTONE.fieldNames())


def moved_members(names: DataFrame, whole: DataFrame) -> DataFrame:
    """The members of renamed houses under their new name."""
    moved = whole.join(names, F.col("name") == F.col("old")).withColumn("name", F.col("new"))
    return moved.withColumn("item", _item(F.col("name"), F.col("member"))).select(*MEMBER.fieldNames())


def new_members(batch: DataFrame, houses: DataFrame) -> DataFrame:
    """Of the batch's members those that count: an empty text counts for a house that is new only."""
    known = houses.select(F.col("name").alias("known"))
    bare = batch.where("not held").join(known, strip(F.col("name")) == F.col("known"), "left_anti")
    return batch.where("held").unionByName(bare).drop("held")


def merge_children(new: DataFrame, moved: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored rows stay in their place, those of renamed houses come along, then what is new."""
    old = stored.unionByName(moved.join(stored, "item", "left_anti"))
    return old.unionByName(new.join(old, "item", "left_anti").select(*old.columns))


def replace_children(new: DataFrame, moved: DataFrame, stored: DataFrame) -> DataFrame:
    """New rows take the place of stored ones."""
    old = stored.unionByName(moved.join(stored, "item", "left_anti"))
    return old.join(new, "item", "left_anti").unionByName(new.select(*old.columns))


def assembled(houses: DataFrame, milestone_rows: DataFrame, member_rows: DataFrame) -> DataFrame:
    """Whole houses with their lists and maps, for readers."""
    shown = milestone_rows.join(houses.select("name", "single"), "name").where("repeat = 0 or single")
    lists = shown.groupBy("name").agg(F.array_sort(F.collect_list(F.struct(*PLACE, F.struct("year", "event").alias("m")))).alias("ms"))
    maps = member_rows.groupBy("name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("member", "text")))).alias("map"))
    out = houses.join(lists, "name", "left").join(maps, "name", "left")
    timeline, family = WINERY["history_timeline"].dataType, WINERY["family_spirit"].dataType
    values = {
        "history_timeline": F.coalesce(F.transform("ms", lambda s: s.m), F.array().cast(timeline)),
        "family_spirit": F.coalesce("map", F.create_map().cast(family)),
    }
    return out.select(*[values.get(n, F.col(n)).alias(n) for n in WINERY.fieldNames()])
