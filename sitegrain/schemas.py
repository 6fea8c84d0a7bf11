"""Entity schemas. Lists and maps are typed; a missing list or map is stored empty."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

YEAR_EVENT = T.StructType().add("year", "string").add("event", "string")
TITLE_VALUE = T.StructType().add("title", "string").add("value", "string")

WINERY = (
    T.StructType()
    .add("id", "string", False)
    .add("name", "string", False)
    .add("website_url", "string", False)
    .add("source_page_url", "string", False)
    .add("description", "string")
    .add("family_spirit", T.MapType(T.StringType(), T.StringType()), False)
    .add("history_timeline", T.ArrayType(YEAR_EVENT), False)
    .add("created_at", "timestamp", False)
    .add("updated_at", "timestamp", False)
)

DOSAGE = T.DecimalType(6, 2)
PERCENT = T.DecimalType(5, 2)
PRODUCT = (
    T.StructType()
    .add("id", "string", False)
    .add("winery_id", "string")
    .add("name", "string", False)
    .add("product_url", "string", False)
    .add("source_page_url", "string", False)
    .add("description", "string")
    .add("dosage_g_per_l", DOSAGE)
    .add("aging", "string")
    .add("operating_temperature", "string")
    .add("crus_assembles", "string")
    .add("millennium", "string")
    .add("grape_chardonnay_percent", PERCENT)
    .add("grape_pinot_noir_percent", PERCENT)
    .add("grape_meunier_percent", PERCENT)
    .add("awards_and_ratings", T.ArrayType(TITLE_VALUE), False)
    .add("data_sheet_url", "string")
    .add("created_at", "timestamp", False)
    .add("updated_at", "timestamp", False)
)

MEDIA = (
    T.StructType()
    .add("id", "string", False)
    .add("media_type", "string", False)
    .add("url", "string", False)
    .add("source_page_url", "string", False)
    .add("created_at", "timestamp", False)
)

# Fields a product page fills, in schema order, with the types extraction gives them.
PRODUCT_TEXT = ("description", "aging", "operating_temperature", "crus_assembles", "millennium", "data_sheet_url")
PRODUCT_NUMBERS = {
    "dosage_g_per_l": DOSAGE,
    "grape_chardonnay_percent": PERCENT,
    "grape_pinot_noir_percent": PERCENT,
    "grape_meunier_percent": PERCENT,
}
PRODUCT_DETAILS = tuple(f.name for f in PRODUCT.fields[5:16])
PRODUCT_PART_TYPE = (
    "struct<name:string,product_url:string,source_page_url:string,description:string,"
    "dosage_g_per_l:double,aging:string,operating_temperature:string,crus_assembles:string,"
    "millennium:string,grape_chardonnay_percent:double,grape_pinot_noir_percent:double,"
    "grape_meunier_percent:double,awards_and_ratings:array<struct<title:string,value:string>>,"
    "data_sheet_url:string>"
)

# What a column holds where a row does not say.
DEFAULTS = {
    "family_spirit": "cast(map() as map<string,string>)", "history_timeline": "cast(array() as array<struct<year:string,event:string>>)",
    "awards_and_ratings": "cast(array() as array<struct<title:string,value:string>>)",
    "created_at": "current_timestamp()", "updated_at": "current_timestamp()",
}


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """A Parquet table of the catalog at ``path``, with the defaults above. Nothing happens if it is there."""
    columns = [
        f"`{f.name}` {f.dataType.simpleString()}" + (f" default {DEFAULTS[f.name]}" if f.name in DEFAULTS else "") for f in schema.fields
    ]
    spark.sql(f"create table if not exists {name} ({', '.join(columns)}) using parquet location '{path}'")
