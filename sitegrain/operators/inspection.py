"""Looking at stored products, and checking the stored tables against their constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain.functions.text import name_key
from sitegrain.schemas import PRODUCT_NUMBERS

# The columns that a listing and a product's view show, in their order.
LISTED = (
    "name", "product_url", "source_page_url", "description", "dosage_g_per_l", "aging",
    "operating_temperature", "crus_assembles", "millennium", "grape_chardonnay_percent",
    "grape_pinot_noir_percent", "grape_meunier_percent", "awards_and_ratings", "data_sheet_url",
)
SHOWN = ("name", "product_url", "dosage_g_per_l", "aging", "operating_temperature", "millennium", "data_sheet_url")
MEDIA_TYPES = ("image", "video")


def list_products(products: DataFrame, limit: int = 100, columns: tuple[str, ...] = LISTED) -> DataFrame:
    """The first products by URL."""
    if limit <= 0:
        raise ValueError("limit must be a positive integer")
    return products.select(*columns).orderBy("product_url").limit(limit)


def show_product(products: DataFrame, name: str) -> DataFrame:
    """Every column of the products with exactly this name."""
    return products.where(F.col("name") == name)


def _finding(rows: DataFrame, constraint: str, sample: Column) -> DataFrame:
    return rows.agg(
        F.lit(constraint).alias("constraint"), F.count("*").alias("violations"),
        F.min(sample.cast("string")).alias("sample"),
    )


def row_rules(table: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """Findings of rules on single rows: one pass and one aggregation for all of them.

    ``rules``: by the constraint's name what breaks it, and the column that names a row.
    """
    flags = [(F.coalesce(bad, F.lit(False)), F.col(sample).cast("string")) for bad, sample in rules.values()]
    counts = table.agg(
        *(F.count_if(bad).alias(f"n{i}") for i, (bad, _) in enumerate(flags)),
        *(F.min(F.when(bad, sample)).alias(f"s{i}") for i, (bad, sample) in enumerate(flags)),
    )
    rows = F.array(*(
        F.struct(F.lit(name).alias("constraint"), F.col(f"n{i}").alias("violations"), F.col(f"s{i}").alias("sample"))
        for i, name in enumerate(rules)
    ))
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def not_null(name: str, columns: tuple[str, ...], sample: str) -> dict[str, tuple[Column, str]]:
    return {f"{name}.{c} not null": (F.col(c).isNull(), sample) for c in columns}


def unique(table: DataFrame, name: str, *columns: str) -> DataFrame:
    """Values held by more than one row. SQL nulls never clash."""
    keyed = table.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")
    return _finding(keyed, f"{name}({', '.join(columns)}) unique", F.concat_ws("|", *columns))


def constraint_audit(wineries: DataFrame, products: DataFrame, media: DataFrame) -> DataFrame:
    """``constraint, violations, sample`` for every constraint of the three tables.

    A table is read once for all rules on its rows, and once for each key that must be unique.
    The last finding is no constraint: houses whose names differ in case or padding only.
    """
    orphans = products.where("winery_id is not null").join(
        wineries.select(F.col("id").alias("winery_id")), "winery_id", "left_anti"
    )
    known = {"media.media_type known": (~F.col("media_type").isin(*MEDIA_TYPES), "url")}
    twins = wineries.groupBy(name_key(F.col("name")).alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    findings = [
        row_rules(wineries, not_null("winery", ("name", "website_url", "source_page_url", "family_spirit", "history_timeline"), "id")),
        row_rules(products, not_null("product", ("name", "product_url", "source_page_url", "awards_and_ratings"), "id")),
        row_rules(media, not_null("media", ("media_type", "url", "source_page_url"), "id") | known),
        unique(wineries, "winery", "name"),
        unique(products, "product", "product_url"),
        unique(products, "product", "winery_id", "name"),
        unique(media, "media", "url"),
        _finding(orphans, "product.winery_id references winery", F.col("product_url")),
        _finding(twins, "winery names alike", F.col("k")),
    ]
    return reduce(DataFrame.unionByName, findings)


def overflowing_numbers(parts: DataFrame) -> DataFrame:
    """``product_url, field, value`` of extracted numbers their stored column cannot hold; stored as null."""
    fields = F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).alias("value"), F.col(c).try_cast(t).isNull().alias("lost"))
        for c, t in PRODUCT_NUMBERS.items() if c in parts.columns
    ])
    rows = parts.select("product_url", F.explode(fields).alias("f")).where("f.lost and f.value is not null")
    return rows.select("product_url", "f.field", "f.value")
