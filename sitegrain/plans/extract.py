"""Page snapshots to entity parts: one parse, then native projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain.functions.nodes import Page
from sitegrain.functions.text import let
from sitegrain.functions.urls import normalize_url
from sitegrain.operators import routing as T
from sitegrain.operators.html import page_nodes
from sitegrain.operators.links import catalog_links, page_links
from sitegrain.operators.media import media_items, unique_media
from sitegrain.operators.product import listing_cards, product_rules_of, product_struct
from sitegrain.operators.registry import (
    LINKS_TYPE, MEDIA_TYPE, AnyRule, Rule, calls, merge_rules, rule_columns, rule_failures, united,
)
from sitegrain.operators.winery import WINERY_RULES
from sitegrain.rules import SiteRules
from sitegrain.schemas import PRODUCT_PART_TYPE

WINERY_PART_TYPE = (
    "struct<name:string,website_url:string,source_page_url:string,description:string,"
    "family_spirit:map<string,string>,history_timeline:array<struct<year:string,event:string>>>"
)
MISSING_NAME = "product page without a name"


@dataclass(frozen=True)
class Parts:
    """What pages yield. ``seq, page_id, pos`` order the rows of each table."""

    winery: DataFrame
    product: DataFrame
    media: DataFrame
    links: DataFrame
    errors: DataFrame


def pages_to_parse(pages: DataFrame, rules: SiteRules) -> DataFrame:
    """Drop the pages that yield nothing whatever they hold: no class and not in the routed language."""
    cls = T.page_class(F.col("final_url"), rules)
    maybe = T.may_be_language_page(F.col("html"), F.col("final_url"), rules.routed_lang)
    return pages.withColumn("path_class", cls).where(cls.isNotNull() | maybe)


def media_rule(page: Page, url: Column) -> Column:
    """Every media element of a page, each URL once."""
    return F.struct(unique_media(media_items(page, url)).alias("media"))


MEDIA_RULE = Rule("media", (), media_rule, media=True)


@lru_cache(maxsize=16)
def page_rules(rules: SiteRules) -> tuple[Rule, ...]:
    """What product and house pages yield besides their fields."""

    def links(page: Page, url: Column) -> Column:
        return F.struct(page_links(page, url, rules).alias("links"))

    return MEDIA_RULE, Rule("page_links", (), links, links=True)


@lru_cache(maxsize=16)
def listing_rules(rules: SiteRules) -> tuple[Rule, ...]:
    """What listings yield: cards with their media, and links."""

    def cards(page: Page, url: Column) -> Column:
        def build(found: Column) -> Column:
            media = F.flatten(F.transform(found, lambda c: c.media))
            return F.struct(found.alias("cards"), media.alias("media"))

        return let(listing_cards(page, url, media_items(page, url), rules), build)

    def links(page: Page, url: Column) -> Column:
        return F.struct(catalog_links(page, url, rules).alias("links"))

    return (
        Rule("cards", ("cards",), cards, frozenset(["cards"]), media=True),
        Rule("listing_links", (), links, links=True),
    )


@lru_cache(maxsize=16)
def route_rule(rules: SiteRules) -> Rule:
    """A page in the routed language yields the link to its other version only."""

    def links(page: Page, url: Column) -> Column:
        return F.struct(T.routed_links(page, url, rules).alias("links"))

    return Rule("route", (), links, links=True)


@lru_cache(maxsize=16)
def _columns(rules: SiteRules, product_rules: tuple[AnyRule, ...], winery_rules: tuple[AnyRule, ...]):
    """The projections of ``extract_pages``, built once per rule set and process.

    They refer to columns by name only, so the same objects serve every page table.
    """
    page = Page()
    url, cls, routed = F.col("final_url"), F.col("page_class"), F.col("routed")
    is_product, is_catalog = cls == T.PRODUCT, cls == T.CATALOG
    is_winery = cls.isin(*T.WINERY_CLASSES)
    listing, route, common = listing_rules(rules), route_rule(rules), page_rules(rules)
    groups = [(is_product, product_rules), (is_winery, winery_rules), (is_product | is_winery, common), (is_catalog, listing), (routed, [route])]
    in_language = T.is_language_page(page, url, rules.routed_lang)
    read = [
        "page_id", "seq", "final_url", "page_class", "routed", "parse_error",
        *[column for on, some in groups for column in rule_columns(some, page, url, on=on)],
    ]

    fields, house = merge_rules(product_rules), merge_rules(winery_rules)
    name = fields.pop("name")
    failed = F.coalesce(is_product & name.isNull(), F.lit(False))
    fields["awards_and_ratings"] = F.coalesce(fields["awards_and_ratings"], F.array())
    known = {f: v for f, v in fields.items() if f in PRODUCT_PART_TYPE}
    product = product_struct(known, name, normalize_url(url), url)
    listed = F.transform(
        F.col("rule_cards.cards"),
        lambda c: product_struct({"description": c.description}, c["name"], c.product_url, url),
    )
    empty_map = F.create_map().cast("map<string,string>")
    timeline = F.coalesce(house["history_timeline"], F.array())
    winery = F.struct(
        F.lit(rules.entity_name).alias("name"),
        F.lit(rules.website_url).alias("website_url"),
        url.alias("source_page_url"),
        F.when(cls == T.HOME, house["description"]).alias("description"),
        F.when(cls == T.FAMILY, F.coalesce(house["family_spirit"], empty_map))
        .otherwise(empty_map).alias("family_spirit"),
        F.when(cls == T.HISTORY, timeline).otherwise(F.array()).alias("history_timeline"),
    ).cast(WINERY_PART_TYPE)
    # A column of a rule that is not for the page's class is null and adds nothing.
    every = [r for _, some in groups for r in some]
    media = unique_media(united(every, "media", MEDIA_TYPE))
    links = F.array_distinct(united(every, "links", LINKS_TYPE))
    none = F.array()
    parts = [
        "page_id", "seq", "final_url", "page_class", "routed",
        F.coalesce(F.col("parse_error"), F.when(failed, F.lit(MISSING_NAME))).alias("error"),
        F.when(is_winery, winery).alias("winery"),
        F.when(is_product & ~failed, F.array(product)).when(is_catalog, listed)
        .otherwise(none).cast(f"array<{PRODUCT_PART_TYPE}>").alias("products"),
        F.when(~failed, media).otherwise(none).cast(MEDIA_TYPE).alias("media"),
        F.when(~failed, links).otherwise(none).cast(LINKS_TYPE).alias("links"),
        rule_failures(every).alias("rule_errors"),
    ]
    return page, in_language, read, parts


def extract_pages(pages: DataFrame, rules: SiteRules,
                  product_rules: Sequence[AnyRule] | None = None,
                  winery_rules: Sequence[AnyRule] = WINERY_RULES) -> DataFrame:
    """One row per page that may yield something: its class, parts, links, media and errors.

    Write or persist the result when more than one of its parts is used: it is small, and
    everything up to here costs a pass over the page bodies.
    """
    todo = pages_to_parse(pages, rules).select("page_id", "final_url", "seq", "path_class", "html")
    product_rules = tuple(product_rules_of(rules) if product_rules is None else product_rules)
    page, in_language, read, parts = _columns(rules, product_rules, tuple(winery_rules))
    parsed = page_nodes(todo, page, calls([*product_rules, *winery_rules]))
    routed = parsed.withColumn("routed", in_language & F.col("parse_error").isNull())
    classed = routed.withColumn("page_class", F.when(~F.col("routed"), F.col("path_class")))
    return classed.select(*read).select(*parts)


def _errors() -> Column:
    """What went wrong with the page itself, and with single rules."""
    stage = F.coalesce("page_class", F.lit("page"))
    whole = F.when(F.col("error").isNotNull(), F.array(F.struct(stage.alias("stage"), F.col("error").alias("message"))))
    single = F.transform("rule_errors", lambda e: F.struct(F.concat(F.lit("rule "), e.rule).alias("stage"), e.message.alias("message")))
    return F.concat(F.coalesce(whole, F.array().cast("array<struct<stage:string,message:string>>")), single)


def listed(rows: DataFrame, keep: Sequence[Column | str], items: Column | str, name: str) -> DataFrame:
    """A row for each item of an array, as ``pos`` and ``name``, with the columns ``keep``.

    Unlike with ``explode`` alone, Spark puts no test for empty arrays in front, for which it would
    work out the array twice.
    """
    return rows.select(*keep, F.posexplode_outer(items).alias("pos", name)).where("pos is not null")


def split_parts(extracted: DataFrame) -> Parts:
    """The five narrow tables of ``extract_pages``."""
    order = ["page_id", "seq"]
    page_url = F.col("final_url")
    media = listed(extracted, [*order, page_url.alias("source_page_url")], "media", "m")
    return Parts(
        winery=extracted.where("winery is not null").select(*order, F.lit(0).alias("pos"), "winery.*"),
        product=listed(extracted, order, "products", "p").select(*order, "pos", "p.*"),
        media=media.select(*order, "pos", "m.media_type", "m.url", "source_page_url"),
        links=listed(extracted, [*order, page_url.alias("src_url")], "links", "url").drop("pos"),
        errors=listed(extracted, ["page_id", page_url.alias("url")], _errors(), "e").select("page_id", "url", "e.*"),
    )
