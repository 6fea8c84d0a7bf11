"""The registered queries. Each reads the given tables, or pages Spark renders from them, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import rendered as R
from checks.rendered import spread, table
from sitegrain import rules as SR
from sitegrain.functions import nodes as N
from sitegrain.functions import text as X
from sitegrain.functions import urls as U
from sitegrain.operators import frontier as FR
from sitegrain.operators import inspection as I
from sitegrain.operators import links as L
from sitegrain.operators import media as M
from sitegrain.operators import merge as G
from sitegrain.operators import metrics as MT
from sitegrain.operators import routing as RT
from sitegrain.operators import upsert as UP
from sitegrain.operators.html import Result, page_nodes
from sitegrain.operators.product import TASTING_RULE, product_rules_of
from sitegrain.operators.store import EntityStore
from sitegrain.operators.registry import PythonRule, extraction_report, rule_columns
from sitegrain.plans import ingest as P
from sitegrain.plans.extract import extract_pages, page_rules, split_parts
from sitegrain.rules import SiteRules
from sitegrain.schemas import PRODUCT, WINERY, create_table
from sitegrain.session import work_dir
from sitegrain.sources.pages import PAGE_SCHEMA, read_pages, seed_urls, stream_pages
from sitegrain.streaming.ingest import corrected, live_metrics, stream_first, stream_ingest, write_corrections

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
c = F.col

# Two hosts of the test pages stand for a site; its page types follow the test URLs.
PAGES_RULES = SiteRules(
    host="blog.tionsh.example.net", domain="thther.example.org",
    product_path=r"^/en/[0-9]+\.html$", catalog_path=r"^/de/[0-9]+/?$", winery_path=r"^/es/[0-9]+(?:\.html)?$",
    history_marker="/en/1", family_marker="/en/2", home_paths=("/fr/1", "/fr/2"),
)


def _now() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp")



def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


def _urls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url")


def _read(pages: DataFrame, *columns: Callable[[N.Page], Column]) -> DataFrame:
    """``page_id`` and what each of ``columns`` reads of a page."""
    page = N.Page()
    built = [f(page) for f in columns]
    return page_nodes(pages.select("page_id", "final_url", "html"), page).select("page_id", "final_url", *built)


# --- URLs -----------------------------------------------------------------------------

@query
def url_normalize(spark, sf):
    return _urls(spark, sf).select("page_id", U.normalize_url(c("url")).alias("key"))


@query
def url_media_normalize(spark, sf):
    return _urls(spark, sf).select("page_id", U.normalize_media_url(c("url")).alias("key"))


@query
def url_canonical(spark, sf):
    return _urls(spark, sf).select("page_id", U.canonical_page_url(c("url"), "www.example.com").alias("canon"))


@query
def url_parts(spark, sf):
    return _urls(spark, sf).select("page_id", U.netloc(c("url")).alias("host"), U.page_path(c("url")).alias("path"))


@query
def url_slug(spark, sf):
    return _urls(spark, sf).select("page_id", U.slug(c("url")).alias("slug"))


@query
def url_absolute(spark, sf):
    forms = F.array(
        F.concat(F.lit("/r/"), c("page_id")), F.lit("x.html"), F.lit("../up"), F.lit("?p=2"),
        F.lit("#frag"), F.lit("//cdn.example.com/a"), F.lit("HTTPS://cdn.example.com/b"), F.lit(""),
    )
    rows = _urls(spark, sf).select("page_id", "url", F.posexplode(forms).alias("n", "href"))
    return rows.select("page_id", "n", U.absolute_url(c("url"), c("href")).alias("target"))


@query
def url_internal(spark, sf):
    return _urls(spark, sf).where(U.is_internal(c("url"), PAGES_RULES.hosts)).select("page_id", "url")


@query
def url_in_scope(spark, sf):
    return _urls(spark, sf).where(U.in_scope(c("url"), ("/en", "/fr/1"))).select("page_id", "url")


# --- links ----------------------------------------------------------------------------

def _page_links(spark: SparkSession, sf: str) -> DataFrame:
    return L.link_table(_read(_pages(spark, sf), lambda p: L.page_links(p, c("final_url"), PAGES_RULES).alias("links")))


@query
def links_discovered(spark, sf):
    return _page_links(spark, sf).select("page_id", "url")


@query
def links_catalog_rule(spark, sf):
    found = _read(_pages(spark, sf), lambda p: L.catalog_links(p, c("final_url"), PAGES_RULES).alias("links"))
    return L.link_table(found).select("page_id", "url")


@query
def links_distinct(spark, sf):
    return L.distinct_urls(_page_links(spark, sf), _urls(spark, sf).select(U.normalize_url(c("url")).alias("url")))


@query
def link_dedupe_ratio(spark, sf):
    return L.dedupe_ratio(_page_links(spark, sf))


@query
def links_in_scope(spark, sf):
    return L.scoped(_page_links(spark, sf), PAGES_RULES).select("page_id", "url")


@query
def link_report(spark, sf):
    links = _page_links(spark, sf).withColumn("host", U.netloc(c("src_url")))
    seen, unique = F.count("*"), F.countDistinct("url")
    return links.groupBy("host").agg(
        F.countDistinct("page_id").alias("pages"), seen.alias("links"), unique.alias("distinct_links"),
        F.round(F.try_divide(seen - unique, seen), 6).alias("dedupe_ratio"),
    )


# --- routing --------------------------------------------------------------------------

@query
def page_language(spark, sf):
    u = c("final_url")
    return _read(
        _pages(spark, sf), lambda p: RT.page_language(p).alias("lang"),
        lambda p: RT.is_language_page(p, u, "fr").alias("is_fr"), lambda p: RT.is_language_page(p, u, "en").alias("is_en"),
    ).drop("final_url")


@query
def route_language(spark, sf):
    found = extract_pages(R.french_pages(spark, sf), R.RULES)
    return found.select("page_id", "routed", F.array_join("links", " ").alias("links"))


@query
def language_switch_german(spark, sf):
    found = _read(R.french_pages(spark, sf), lambda p: RT.language_switch_url(p, c("final_url"), "de").alias("target"))
    return found.select("page_id", "target")


@query
def page_classify(spark, sf):
    return _urls(spark, sf).select("page_id", RT.page_class(c("url"), PAGES_RULES).alias("page_class"))


@query
def page_type_rules(spark, sf):
    k = c("p_partkey")
    path = F.element_at(F.array(*[F.lit(p) for p in PATHS]), (k % len(PATHS) + 1).cast("int"))
    url = F.concat(F.lit(R.SITE), path)
    rules = SiteRules()
    return table(spark, sf, "part").select(
        "p_partkey", RT.is_product_page(url, rules).alias("is_product"), RT.is_catalog_page(url, rules).alias("is_catalog"),
        RT.is_winery_page(url, rules).alias("is_winery"), RT.winery_page_class(url, rules).alias("winery_class"),
        RT.page_class(url, rules).alias("page_class"),
    )


# Path and expected flags: product, catalog, house page, class.
PATHS = {
    "/": (0, 0, 0, None), "/en": (0, 0, 0, "winery"), "/fr/?x=1": (0, 0, 0, "winery"),
    "/en/champagnes-et-cuvees": (0, 0, 0, None), "/champagnes-et-cuvees/a/": (1, 0, 0, "product"),
    "/EN/Champagnes-Cuvees/b": (1, 0, 0, "product"), "/en/champagnes-cuvees/a/b": (0, 0, 0, None),
    "/en/champagnes/": (0, 1, 0, "catalog"), "/champagnes-cuvees#x": (0, 1, 0, "catalog"),
    "/en/maison": (0, 0, 1, "winery"), "/en/maison/anything": (0, 0, 1, "winery"), "/en/maisonx": (0, 0, 0, None),
    "/en/maison/histoire/x": (0, 0, 1, "history"), "/de/Maison/Famille": (0, 0, 0, "family_spirit"),
    "/engagements/x": (0, 0, 1, "winery"), "/en/engagementsx": (0, 0, 0, None),
}


@query
def dedupe_final_url(spark, sf):
    keys = _pages(spark, sf).select("page_id", "final_url", "seq")
    return RT.first_per_final_url(keys, PAGES_RULES).select("canon", "page_id")


# --- HTML -----------------------------------------------------------------------------

def _tag_text(spark: SparkSession, sf: str, tag: str, name: str) -> DataFrame:
    def text(page: N.Page) -> Column:
        return X.let(page.select_one(N.el(tag)), lambda n: N.node_text(page.nodes, n)).alias(name)

    return _read(_pages(spark, sf), text).select("page_id", name)


@query
def page_title(spark, sf):
    return _tag_text(spark, sf, "title", "title")


@query
def page_heading(spark, sf):
    return _tag_text(spark, sf, "h1", "heading")


@query
def page_paragraph_count(spark, sf):
    inside = N.el("p").inside(N.el("article"))
    found = _read(_pages(spark, sf), lambda p: F.size(p.select(inside)).cast("long").alias("paragraphs"))
    return found.select("page_id", "paragraphs")


@query
def page_element_counts(spark, sf):
    pages = page_nodes(_pages(spark, sf).select("html"))
    tags = pages.select(F.explode("nodes").alias("n")).select(c("n.tag").alias("tag"))
    return tags.where(~c("tag").startswith("#")).groupBy("tag").agg(F.count("*").alias("n"))


@query
def text_numbers(spark, sf):
    t = c("text")
    span = X.number_range(t)
    return table(spark, sf, "documents").select(
        "doc_id", X.first_number(t).alias("number"), X.first_year(t).alias("year"),
        X.vintage_year(t).alias("vintage"), span.low.alias("low"), span.high.alias("high"),
    )


# --- products, listings, houses, media -------------------------------------------------

def _products(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(R.product_pages(spark, sf), R.RULES)


@query
def product_roundtrip(spark, sf):
    p = split_parts(_products(spark, sf)).product
    return p.drop("seq", "pos", "awards_and_ratings").withColumnRenamed("page_id", "p_partkey")


@query
def product_grape_pairs(spark, sf):
    """Grapes from all pairs of the sheet, as without a limit: a later pair of the same label counts."""
    p = split_parts(extract_pages(R.product_pages(spark, sf), R.RULES.with_(grape_pairs=None))).product
    return p.select(c("page_id").alias("p_partkey"), "grape_chardonnay_percent")


@query
def awards_roundtrip(spark, sf):
    p = split_parts(_products(spark, sf)).product
    return p.select(c("page_id").alias("p_partkey"), F.posexplode("awards_and_ratings").alias("n", "a")).select(
        "p_partkey", "n", "a.title", "a.value"
    )


@query
def tasting_roundtrip(spark, sf):
    notes = _read(R.product_pages(spark, sf), lambda p: rule_columns([TASTING_RULE], p, c("final_url"))[0])
    rows = notes.select(c("page_id").alias("p_partkey"), F.explode(TASTING_RULE.value("tasting_notes")).alias("t"))
    return rows.select("p_partkey", "t.title", "t.content")


@query
def page_errors(spark, sf):
    return split_parts(_products(spark, sf)).errors


@query
def media_roundtrip(spark, sf):
    m = split_parts(_products(spark, sf)).media
    return m.select(c("page_id").alias("p_partkey"), "media_type", "url")


@query
def media_kinds(spark, sf):
    kinds = {"media_count": SR.MEDIA, "images": SR.IMAGES, "videos": SR.VIDEOS, "backgrounds": SR.BACKGROUNDS}

    def counted(name: str, kind: tuple[N.Sel, ...]) -> Callable[[N.Page], Column]:
        return lambda p: F.size(M.page_media(p, c("final_url"), kind)).cast("long").alias(name)

    return _read(R.product_pages(spark, sf), *[counted(n, k) for n, k in kinds.items()]).drop("final_url")


@query
def media_type_counts(spark, sf):
    return M.media_type_counts(split_parts(_products(spark, sf)).media)


@query
def links_roundtrip(spark, sf):
    return split_parts(_products(spark, sf)).links.select(c("page_id").alias("p_partkey"), "url")


@query
def srcset_best(spark, sf):
    k, size = c("p_partkey"), c("p_size")
    srcset = F.concat(
        F.lit("/a/"), k, F.lit(".jpg 320w, /b/"), k, F.lit(".jpg "), size * 20, F.lit("w,, /c/"), k,
        F.lit(".jpg 2x ,\n/d/"), k, F.lit(".jpg "), size * 20, F.lit("W , /e.jpg 9x9w"),
    )
    return table(spark, sf, "part").select("p_partkey", M.best_srcset(srcset).alias("best"))


@query
def listing_cards(spark, sf):
    p = split_parts(extract_pages(R.listing_pages(spark, sf), R.RULES)).product
    return p.select("name", "product_url", "source_page_url", "description")


@query
def listing_media(spark, sf):
    m = split_parts(extract_pages(R.listing_pages(spark, sf), R.RULES)).media
    return m.select("url", "source_page_url")


@query
def house_description(spark, sf):
    w = split_parts(extract_pages(R.house_pages(spark, sf), R.RULES)).winery
    return w.where("description is not null").select("source_page_url", "description")


@query
def house_history(spark, sf):
    w = split_parts(extract_pages(R.house_pages(spark, sf), R.RULES)).winery
    rows = w.select("source_page_url", F.posexplode("history_timeline").alias("n", "m"))
    return rows.select("source_page_url", "n", "m.year", "m.event")


@query
def house_family(spark, sf):
    w = split_parts(extract_pages(R.house_pages(spark, sf), R.RULES)).winery
    return w.select("source_page_url", F.explode("family_spirit").alias("member", "text"))


@query
def rule_report(spark, sf):
    rules = [*product_rules_of(R.RULES), TASTING_RULE, *page_rules(R.RULES)]
    return extraction_report(R.product_pages(spark, sf), rules)


def _sizes(url: str, paragraphs: list) -> Result:
    """A rule of a user: a field that overrides another rule's, a picture and a link by the size in the story."""
    size = int(paragraphs[1].text.split()[1])
    site = url.split("/en/")[0]
    return Result({"millennium": f"size {size}"}, [("image", f"{site}/plain/{size}.png")], [f"{site}/size/{size}"])


def _months(url: str, paragraphs: list) -> Result:
    """Divides by zero on every fifth size."""
    return Result({"aging": f"{100 // (int(paragraphs[1].text.split()[1]) % 5)} months"})


def _with_rule(spark: SparkSession, sf: str, name: str, field: str, read: Callable) -> DataFrame:
    """Pages read with one more rule, written: several parts of the result are used, the bodies are parsed once."""
    rule = PythonRule(name, {field: "string"}, ((SR.PRODUCT_DESCRIPTION,),), read)
    return P.materialize(extract_pages(R.product_pages(spark, sf), R.RULES, (*product_rules_of(R.RULES), rule)), "extracted")


def _kinds(*tables: tuple[DataFrame, Column, Column]) -> DataFrame:
    rows = [t.select(c("page_id").alias("p_partkey"), kind.alias("kind"), value.alias("value")) for t, kind, value in tables]
    return reduce(DataFrame.unionByName, rows)


@query
def custom_rule(spark, sf):
    """What a rule in Python adds to the fields, media and links of a page."""
    parts = split_parts(_with_rule(spark, sf, "sizes", "millennium", _sizes))
    return _kinds(
        (parts.product, F.lit("field"), c("millennium")), (parts.media.where("url like '%/plain/%'"), F.lit("media"), c("url")),
        (parts.links.where("url like '%/size/%'"), F.lit("link"), c("url")),
    )


@query
def rule_errors(spark, sf):
    """A rule that fails on some pages leaves the fields of the others and is reported."""
    parts = split_parts(_with_rule(spark, sf, "months", "aging", _months))
    failed = parts.errors.where("stage like 'rule %'")
    return _kinds((parts.product, F.lit("aging"), c("aging")), (failed, c("stage"), F.substring_index("message", ":", 1)))


# --- merging --------------------------------------------------------------------------

def _order_rows(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(c("o_orderstatus") == "P", "").otherwise(c("o_orderstatus"))
    return table(spark, sf, "orders").withColumn("status", status)


@query
def last_non_empty(spark, sf):
    order = F.struct("o_orderdate", "o_orderkey")
    return _order_rows(spark, sf).groupBy("o_custkey").agg(
        G.last_non_empty(c("status"), order).alias("status"),
        G.last_non_empty(c("o_orderpriority"), order).alias("priority"),
    )


LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")


def _line_lists(spark: SparkSession, sf: str, first: str, second: str) -> DataFrame:
    item = F.struct(c("l_returnflag").alias(first), c("l_linestatus").alias(second), c("l_quantity").cast("string").alias("q"))
    return table(spark, sf, "lineitem").select("l_orderkey", F.struct(*LINE_ORDER).alias("o"), F.array(item).alias("items"))


@query
def union_list_by_key(spark, sf):
    rows = G.union_lists(_line_lists(spark, sf, "year", "event"), "l_orderkey", "items", c("o"), G.TIMELINE_KEY)
    texts = F.transform("items", lambda x: F.concat_ws("-", x.year, x.event, x.q))
    return rows.select("l_orderkey", F.array_join(texts, " ").alias("items"))


@query
def merge_awards(spark, sf):
    rows = G.union_lists(_line_lists(spark, sf, "title", "value"), "l_orderkey", "items", c("o"), G.AWARD_KEY)
    return rows.select("l_orderkey", F.size("items").cast("long").alias("n_awards"), c("items")[0].title.alias("first_title"))


@query
def merge_map(spark, sf):
    rows = _order_rows(spark, sf).select(
        "o_custkey", F.struct("o_orderdate", "o_orderkey").alias("o"),
        F.create_map("o_orderpriority", "status").alias("m"),
    )
    merged = G.merge_records(rows, "o_custkey", c("o"), scalars=[], maps=["m"])
    return merged.select("o_custkey", F.explode("m").alias("priority", "status"))


@query
def merge_by_type(spark, sf):
    """One merge for each type of column: text, number, list and map."""
    k = c("p_partkey")

    def listed(a: Column, b: Column) -> Column:
        return F.array(F.struct(a.alias("year"), F.lit("e").alias("event")), F.struct(b.alias("year"), F.lit(" e").alias("event")))

    rows = table(spark, sf, "part").select(
        "p_partkey", c("p_brand").alias("old_text"), F.when(k % 2 == 0, "").otherwise(c("p_type")).alias("new_text"),
        c("p_size").cast("double").alias("old_number"), F.when(k % 3 == 0, 0.0).alias("new_number"),
        listed(F.lit("1"), c("p_size").cast("string")).alias("old_list"), listed(F.lit("1"), (k % 5).cast("string")).alias("new_list"),
        F.create_map(F.lit("a"), c("p_brand")).alias("old_map"), F.create_map(F.lit("a"), F.when(k % 2 == 0, "").otherwise("x"), F.lit("b"), F.lit("y")).alias("new_map"),
    )
    merged = {n: G.merge_value(c(f"old_{n}"), c(f"new_{n}"), rows.schema[f"old_{n}"].dataType) for n in ("text", "number", "list", "map")}
    years = F.array_join(F.transform(merged["list"], lambda x: x.year), ",")
    return rows.select(
        "p_partkey", merged["text"].alias("text"), merged["number"].alias("number"), years.alias("years"),
        merged["map"]["a"].alias("a"), merged["map"]["b"].alias("b"),
    )


@query
def merge_two_maps(spark, sf):
    orders = _order_rows(spark, sf)
    halves = []
    for n in (0, 1):
        rows = orders.where(c("o_orderkey") % 2 == n).groupBy("o_custkey", "o_orderpriority").agg(F.min("status").alias("s"))
        halves.append(rows.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "s"))).alias(f"m{n}")))
    both = halves[0].join(halves[1], "o_custkey", "full_outer")
    return both.select("o_custkey", F.explode(G.merge_map(c("m0"), c("m1"))).alias("priority", "status"))


@query
def group_wineries(spark, sf):
    name = F.concat(F.lit(" House "), F.when(c("s_suppkey") % 2 == 0, F.upper("n_name")).otherwise(F.lower("n_name")), F.lit(" "))
    parts = table(spark, sf, "supplier").join(table(spark, sf, "nation"), c("s_nationkey") == c("n_nationkey")).select(
        c("s_suppkey").alias("page_id"), c("s_suppkey").alias("seq"), F.lit(0).alias("pos"), name.alias("name"),
        F.lit("w").alias("website_url"), F.concat(F.lit("p"), c("s_suppkey")).alias("source_page_url"),
        F.when(c("s_acctbal") > 5000, c("s_name")).alias("description"),
        F.create_map(F.lit("last"), F.when(c("s_suppkey") % 3 == 0, "").otherwise(c("s_name"))).alias("family_spirit"),
        F.array(F.struct((c("s_suppkey") % 7).cast("string").alias("year"), F.lit(" e").alias("event"))).alias("history_timeline"),
    )
    return G.group_wineries(parts).select(
        "name_key", "name", "source_page_url", "description", c("family_spirit")["last"].alias("last_member"),
        F.array_join(F.transform("history_timeline", lambda m: m.year), ",").alias("years"), "n_records",
    )


def _line_products(spark: SparkSession, sf: str) -> DataFrame:
    """Partial product records: one per line item, of the part it orders."""
    def sparse(flag: str, value: Column) -> Column:
        return F.when(c("l_returnflag") == flag, value)

    order = F.struct("l_shipdate", "l_orderkey", *LINE_ORDER)
    return spread(table(spark, sf, "lineitem"), "l_orderkey").select(
        order.alias("o"), F.concat(F.lit("part "), c("l_partkey")).alias("name"),
        F.concat(F.lit("https://h.example.com/p/"), c("l_partkey"), F.when(c("l_linenumber") % 2 == 0, "/").otherwise("?x=1")).alias("product_url"),
        F.concat(F.lit("https://h.example.com/o/"), c("l_orderkey")).alias("source_page_url"),
        sparse("A", c("l_linestatus")).alias("description"), sparse("N", c("l_quantity")).alias("dosage_g_per_l"),
        sparse("R", c("l_suppkey").cast("string")).alias("aging"), F.lit("").alias("operating_temperature"),
        F.lit(None).cast("string").alias("crus_assembles"), F.lit(None).cast("string").alias("millennium"),
        c("l_discount").alias("grape_chardonnay_percent"), F.lit(None).cast("double").alias("grape_pinot_noir_percent"),
        F.lit(None).cast("double").alias("grape_meunier_percent"),
        F.array(F.struct(c("l_returnflag").alias("title"), c("l_linestatus").alias("value"))).alias("awards_and_ratings"),
        F.lit(None).cast("string").alias("data_sheet_url"),
    )


@query
def group_products(spark, sf):
    merged = G.group_products(_line_products(spark, sf), c("o"))
    awards = F.transform("awards_and_ratings", lambda a: F.concat(a.title, a.value))
    return merged.select(
        "url_key", "name", "source_page_url", "description", "dosage_g_per_l", "aging", "operating_temperature",
        "grape_chardonnay_percent", F.array_join(awards, " ").alias("awards"), "n_records",
    )


@query
def required_fields(spark, sf):
    rows = _order_rows(spark, sf)
    return G.required(rows, "status", "o_orderpriority").groupBy("status").agg(F.count("*").alias("n"))


@query
def dedupe_run_products(spark, sf):
    rows = spread(table(spark, sf, "lineitem"), "l_orderkey").select(
        F.struct("l_shipdate", *LINE_ORDER).alias("o"), "l_orderkey", "l_quantity",
        F.concat(F.lit("https://h.example.com/p/"), c("l_partkey") % 10, F.lit("/")).alias("product_url"),
        F.concat(F.lit("https://h.example.com/o/"), c("l_orderkey"), F.lit("#x")).alias("source_page_url"),
    )
    key = F.concat(U.normalize_url(c("product_url")), F.lit("::"), U.normalize_url(c("source_page_url")))
    return G.first_per_key(rows, key, c("o")).select("l_orderkey", "product_url", "l_quantity")


@query
def dedupe_run_media(spark, sf):
    m = split_parts(_products(spark, sf)).media
    return G.dedupe_media(m).select("url", "media_type", "source_page_url")


@query
def dedupe_run_wineries(spark, sf):
    pages = _pages(spark, sf).select("page_id", "seq", F.lit(0).alias("pos"), c("final_url").alias("source_page_url"))
    return G.dedupe_wineries(pages).select("page_id", "source_page_url")


@query
def completeness_score(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey", F.when(c("p_size") % 2 == 0, c("p_name")).otherwise("").alias("description"),
        F.when(c("p_size") % 3 == 0, c("p_retailprice")).alias("dosage_g_per_l"), c("p_brand").alias("aging"),
        F.when(c("p_size") % 5 == 0, F.array(F.struct(c("p_type").alias("title"), F.lit("").alias("value"))))
        .otherwise(F.array()).alias("awards_and_ratings"),
    )
    columns = ["description", "dosage_g_per_l", "aging", "awards_and_ratings"]
    return rows.select("p_partkey", G.completeness_score(columns).alias("score"))


# --- upsert ---------------------------------------------------------------------------

def _stored_products(spark: SparkSession, sf: str) -> DataFrame:
    """The parts as a stored product table."""
    k = c("p_partkey")
    url = F.concat(F.lit("https://h.example.com/p/"), k)
    values = {
        "id": UP.stable_id(url), "winery_id": F.lit("w1"), "name": c("p_name"), "product_url": url,
        "source_page_url": F.concat(url, F.lit("?old")), "description": c("p_type"), "dosage_g_per_l": c("p_size"),
        "aging": F.when(k % 5 == 0, c("p_brand")), "millennium": F.lit(""),
        "awards_and_ratings": F.array(F.struct(c("p_brand").alias("title"), F.lit("1").alias("value"))),
        "created_at": _now(), "updated_at": _now(),
    }
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PRODUCT.fields]
    return table(spark, sf, "part").select(*columns)


@query
def seeded_house(spark, sf):
    """The bare house record comes first; pages fill it in and never replace its name."""
    parts = UP.seed_winery(spark, R.RULES).unionByName(split_parts(extract_pages(R.house_pages(spark, sf), R.RULES)).winery)
    return G.group_wineries(parts).select("name", "website_url", "source_page_url", "description", "n_records")


@query
def table_defaults(spark, sf):
    """Rows written without lists, maps and times get the table's defaults."""
    name, rows = f"wineries_{uuid.uuid4().hex[:12]}", table(spark, sf, "nation")
    create_table(spark, name, WINERY, f"{work_dir(spark, 'tables')}/wineries")
    spark.sql(
        f"insert into {name} (id, name, website_url, source_page_url) "
        "select cast(n_nationkey as string), n_name, 'w', 's' from {rows}", rows=rows,
    )
    out = spark.table(name).select(
        "name", F.size("family_spirit").cast("long").alias("members"), F.size("history_timeline").cast("long").alias("milestones"),
        "description", (c("created_at") <= F.current_timestamp()).alias("created"), (c("updated_at") <= F.current_timestamp()).alias("fresh"),
    )
    out.write.parquet(folder := work_dir(spark, "defaults"))
    spark.sql(f"drop table {name}")
    return spark.read.parquet(folder)


@query
def upsert_merge(spark, sf):
    k = c("p_partkey")
    values = {
        "name": F.concat(c("p_name"), F.lit(" new")), "product_url": F.concat(F.lit("https://h.example.com/p/"), k, F.lit("/")),
        "source_page_url": F.lit("s"), "description": F.when(k % 2 == 0, F.lit("")).otherwise("fresh"),
        "dosage_g_per_l": F.when(k % 4 == 0, c("p_size") + 0.125), "aging": F.lit("2 years"),
        "awards_and_ratings": F.array(
            F.struct(c("p_brand").alias("title"), F.lit(" 1").alias("value")), F.struct(F.lit("G").alias("title"), F.lit("2").alias("value"))
        ),
    }
    blank = ("operating_temperature", "crus_assembles", "millennium", "data_sheet_url")
    grapes = ("grape_chardonnay_percent", "grape_pinot_noir_percent", "grape_meunier_percent")
    batch = table(spark, sf, "part").where(k % 3 != 1).select(
        F.lit("w2").alias("winery_id"), F.struct(k.alias("k")).alias("o"), *[v.alias(n) for n, v in values.items()],
        *[F.lit(None).cast("string").alias(n) for n in blank], *[F.lit(None).cast("double").alias(n) for n in grapes],
    )
    stored = _stored_products(spark, sf).where(F.substring_index("product_url", "/", -1).cast("long") % 3 != 0)
    merged = UP.merge_products(G.group_products(batch, c("o")), stored, _now())
    awards = F.transform("awards_and_ratings", lambda a: F.concat_ws("=", a.title, a.value))
    return merged.select(
        "id", "winery_id", "name", "product_url", "source_page_url", "description",
        c("dosage_g_per_l").cast("double").alias("dosage"), "aging", "millennium", F.array_join(awards, ";").alias("awards"),
    )


@query
def upsert_wineries(spark, sf):
    def houses(rows: DataFrame, name: Column, text: Column, year: Column) -> DataFrame:
        return rows.select(
            name.alias("name"), F.lit("w").alias("website_url"), F.lit("s").alias("source_page_url"), text.alias("description"),
            F.create_map(F.lit("k"), text, c("n_name"), F.lit("x")).alias("family_spirit"),
            F.array(F.struct(year.cast("string").alias("year"), F.lit("e").alias("event"))).alias("history_timeline"),
        )

    nation = table(spark, sf, "nation")
    key = c("n_nationkey")
    stored = houses(nation.where(key % 3 != 0), c("n_name"), F.lit("old"), key).select(
        UP.stable_id(c("name")).alias("id"), "*", _now().alias("created_at"), _now().alias("updated_at")
    ).select(*WINERY.fieldNames())
    parts = houses(nation.where(key % 3 != 1), c("n_name"), F.when(key % 2 == 0, "new").otherwise(""), key % 2)
    parts = parts.select(F.lit(0).alias("page_id"), F.lit(0).alias("seq"), F.lit(0).alias("pos"), "*")
    merged = UP.merge_wineries(G.group_wineries(parts), stored, _now())
    return merged.select(
        "id", "name", "description", c("family_spirit")["k"].alias("k"),
        F.array_join(F.transform("history_timeline", lambda m: m.year), ",").alias("years"),
    )


@query
def upsert_replace(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    # Even suppliers are replaced; odd ones come under a new key as well.
    key = F.when(c("s_suppkey") % 2 == 0, c("s_suppkey")).otherwise(c("s_suppkey") + 1_000_000)
    batch = supplier.select(
        key.alias("s_suppkey"), F.concat(c("s_name"), F.lit("*")).alias("s_name"), (c("s_nationkey") + 100).alias("s_nationkey"), F.lit(0.0).alias("s_acctbal")
    )
    return UP.replace_rows(batch, supplier, "s_suppkey", keep=("s_acctbal",))


@query
def resolve_parent(spark, sf):
    ids = table(spark, sf, "nation").select(G.name_key(c("n_name")).alias("name_key"), c("n_nationkey").cast("string").alias("id"))
    default = UP.default_winery_id(ids, SiteRules(entity_name=" Nation_7"))
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", F.when(c("s_suppkey") % 2 == 0, c("s_nationkey").cast("string")).when(c("s_suppkey") % 3 == 0, "").alias("winery_id")
    )
    return UP.resolve_parent(rows, default)


@query
def read_existing(spark, sf):
    keys = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(c("o_custkey").alias("c_custkey")).distinct()
    return UP.read_existing(table(spark, sf, "customer"), keys, "c_custkey").select("c_custkey", "c_name")


@query
def resolve_ids(spark, sf):
    return UP.product_ids(_stored_products(spark, sf))


@query
def list_products(spark, sf):
    return I.list_products(_stored_products(spark, sf), 10, I.SHOWN).select("name", "product_url", "aging")


@query
def show_product(spark, sf):
    rows = I.show_product(_stored_products(spark, sf), "red widget")
    return rows.select("name", "product_url", "description", c("dosage_g_per_l").cast("double").alias("dosage"))


@query
def constraint_audit(spark, sf):
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    wineries = nation.select(
        c("n_nationkey").cast("string").alias("id"), F.concat(F.lit("R"), c("n_regionkey")).alias("name"), F.lit("w").alias("website_url"),
        F.when(c("n_nationkey") > 3, "s").alias("source_page_url"), F.create_map().alias("family_spirit"), F.array().alias("history_timeline"),
    )
    products = supplier.select(
        c("s_suppkey").cast("string").alias("id"), (c("s_nationkey") * 2).cast("string").alias("winery_id"),
        F.when(c("s_suppkey") > 1, "n").alias("name"), c("s_name").alias("product_url"), F.lit("s").alias("source_page_url"), F.array().alias("awards_and_ratings"),
    )
    media = table(spark, sf, "part").select(
        c("p_partkey").cast("string").alias("id"), F.when(c("p_size") > 25, "image").when(c("p_size") > 5, "video").otherwise("audio").alias("media_type"),
        c("p_name").alias("url"), F.lit("s").alias("source_page_url"),
    )
    return I.constraint_audit(wineries, products, media)


@query
def number_overflow(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("product_url"),
        c("l_extendedprice").alias("dosage_g_per_l"), (c("l_quantity") * 25).alias("grape_meunier_percent"),
    )
    return I.overflowing_numbers(rows).groupBy("field").agg(F.count("*").alias("n"), F.min("value").alias("smallest"))


@query
def cascade_delete(spark, sf):
    gone = table(spark, sf, "nation").where("n_regionkey = 2").select(c("n_nationkey").cast("string").alias("id"))
    rows = table(spark, sf, "supplier").select("s_suppkey", F.when(c("s_suppkey") % 5 > 0, c("s_nationkey").cast("string")).alias("winery_id"))
    return UP.delete_cascade(rows, gone)


# --- frontier -------------------------------------------------------------------------

def _closure(spark: SparkSession, sf: str, budget: int | None = None) -> FR.Closure:
    seeds = seed_urls(spark, [f"{R.SITE}/fr/part-0"])
    pages = R.product_pages(spark, sf).unionByName(R.french_pages(spark, sf))
    return P.crawl(spark, pages, seeds, R.RULES, budget).closure


@query
def frontier_closure(spark, sf):
    return _closure(spark, sf).done.select("key", "wave")


@query
def frontier_accounting(spark, sf):
    return FR.frontier_accounting(_closure(spark, sf))


BUDGET = 200


@query
def frontier_budget(spark, sf):
    """Which wave takes which URL when a wave takes 200 of them."""
    return _closure(spark, sf, BUDGET).taken.select("key", "wave")


@query
def frontier_add_many(spark, sf):
    offered = _page_links(spark, sf).select(c("url").alias("key"))
    known = _urls(spark, sf).select(
        F.explode(F.array(U.normalize_url(c("url")), F.concat(F.substring_index("url", "/", 3), F.lit("/the")))).alias("key")
    )
    return FR.count_new(offered, known)


# --- metrics --------------------------------------------------------------------------

def _fetch_log(events: DataFrame) -> DataFrame:
    return events.select(
        c("event_id").alias("attempt_id"), F.concat(F.lit("https://h/at/"), c("event_id")).alias("url"),
        F.when(c("event_id") % 4 == 0, F.concat(F.lit("http://www.h/u/"), c("user_id"), F.lit("/")))
        .when(c("event_id") % 4 == 1, F.concat(F.lit("https://h/u/"), c("user_id"), F.lit("?from="), c("event_id")))
        .when(c("event_id") % 4 == 2, F.concat(F.lit("https://h/u/"), c("user_id"), F.lit("#top")))
        .otherwise(F.concat(F.lit("https://h/u/"), c("user_id"))).alias("final_url"), "ts",
        (c("event_type") != "error").alias("ok"), c("value").alias("latency_s"),
    )


@query
def ingest_metrics(spark, sf):
    """Pages are fetched under many spellings; those that only failed count as none."""
    m = MT.ingest_metrics(_fetch_log(table(spark, sf, "events")), "h")
    return m.select(*m.columns[:4], *[F.round(x, 6).alias(x) for x in m.columns[4:]])


@query
def ingest_metrics_last_n(spark, sf):
    m = MT.ingest_metrics(_fetch_log(table(spark, sf, "events")), "h", latencies=500)
    return m.select("crawled_pages", F.round("p95_latency_last_500_s", 6).alias("p95_latency_last_500_s"))


@query
def p95_latency_last_n(spark, sf):
    return MT.p95_latency(_fetch_log(table(spark, sf, "events"))).select(F.round("p95_latency_s", 6).alias("p95"))


@query
def latest_attempts(spark, sf):
    return MT.latest(_fetch_log(table(spark, sf, "events")), 50).select("attempt_id", "latency_s")


@query
def processed_pages(spark, sf):
    pages = R.product_pages(spark, sf)
    return MT.processed_pages(pages, split_parts(extract_pages(pages, R.RULES)).errors)


@query
def written_counts(spark, sf):
    return P.written_counts(P.process_pages(R.site_pages(spark, sf), R.RULES).parts)


# --- whole runs -----------------------------------------------------------------------

def _shown(store: EntityStore, spark: SparkSession) -> DataFrame:
    p = store.products.read(spark)
    return p.select(
        "name", "product_url", "source_page_url", "description", c("dosage_g_per_l").cast("double").alias("dosage"),
        "aging", F.size("awards_and_ratings").cast("long").alias("n_awards"), (c("winery_id") == UP.stable_id(F.lit(R.RULES.entity_name))).alias("has_house"),
    )


@query
def ingest_run(spark, sf):
    store = EntityStore(spark, work_dir(spark, "store"), R.RULES, buckets=8)
    P.ingest(spark, R.site_pages(spark, sf), store, R.RULES, run_id="r1", now=_now())
    return _shown(store, spark)


@query
def run_errors(spark, sf):
    """What a run could not read is kept in its store."""
    store = EntityStore(spark, work_dir(spark, "store"), R.RULES, buckets=8)
    P.ingest(spark, R.product_pages(spark, sf), store, R.RULES, run_id="r1", now=_now())
    return store.notes("errors").select("page_id", "url", "stage", "message")


@query
def media_upsert(spark, sf):
    """Media of two runs: the second replaces rows of the first, and in a run the first one stays."""
    k = c("p_partkey")
    store = EntityStore(spark, work_dir(spark, "store"), R.RULES, buckets=8)
    for run, batch, text in (("r1", 0, "a"), ("r2", 0, "b"), ("r2", 1, "c")):
        share = {"a": k % 3 != 0, "b": k % 3 != 1, "c": k % 2 == 0}[text]
        rows = table(spark, sf, "part").select(
            k.alias("page_id"), k.alias("seq"), F.lit(0).alias("pos"), F.lit("image").alias("media_type"),
            F.when(share, F.concat(F.lit("https://h/i/"), k, F.lit(".png"))).alias("url"), F.lit(text).alias("source_page_url"),
        )
        store.upsert_media(rows, run, batch, _now())
    return store.media.read(spark).select("id", "url", "source_page_url", "run_id")


@query
def batch_flushes(spark, sf):
    """Batches written by a run, and records handed to the writer after in-run dedupe."""
    k, none = c("p_partkey"), P.process_pages(R.house_pages(spark, sf).where("false"), R.RULES).parts
    store = EntityStore(spark, work_dir(spark, "store"), R.RULES, buckets=8)
    for batch in range(3):
        rows = table(spark, sf, "part").where(k % 3 >= batch).select(
            k.alias("page_id"), k.alias("seq"), F.lit(0).alias("pos"), F.lit("image").alias("media_type"),
            F.concat(F.lit("https://h/i/"), F.floor(k / 2), F.lit(".png")).alias("url"), F.lit("s").alias("source_page_url"),
        )
        P.store_parts(store, replace(none, media=rows), "r1", batch, _now())
    P.store_parts(store, replace(none, media=rows), "r1", batch, _now())  # comes again: counts once
    return store.flushes()


@query
def ingest_house(spark, sf):
    store = EntityStore(spark, work_dir(spark, "store"), R.RULES, buckets=8)
    P.ingest(spark, R.house_pages(spark, sf), store, R.RULES, run_id="r1", now=_now())
    w = store.houses()
    return w.select(
        "name", "website_url", F.size("history_timeline").cast("long").alias("milestones"), F.size("family_spirit").cast("long").alias("members"),
        "description", "source_page_url",
    )


@query
def stream_ingest_run(spark, sf):
    """The run of ``ingest_run`` as a stream of page files: the store must end up the same."""
    folder = work_dir(spark, "arriving")
    R.site_pages(spark, sf).repartition(16, "page_id").write.parquet(f"{folder}/pages")
    store = EntityStore(spark, f"{folder}/store", R.RULES, buckets=8)
    pages = stream_pages(spark, f"{folder}/pages", PAGE_SCHEMA, files_per_batch=8)
    stream_ingest(pages, store, f"{folder}/checkpoint", "r1", R.RULES, _now()).awaitTermination()
    return _shown(store, spark).select("product_url", "has_house")


@query
def stream_run_errors(spark, sf):
    """The errors of all micro-batches are those of one run."""
    folder = work_dir(spark, "arriving")
    R.product_pages(spark, sf).repartition(4, "page_id").write.parquet(f"{folder}/pages")
    store = EntityStore(spark, f"{folder}/store", R.RULES, buckets=8)
    pages = stream_pages(spark, f"{folder}/pages", PAGE_SCHEMA, files_per_batch=2)
    stream_ingest(pages, store, f"{folder}/checkpoint", "r1", R.RULES, _now()).awaitTermination()
    return store.notes("errors").select("page_id", "url", "stage", "message")


@query
def stream_dedupe_first(spark, sf):
    """Media as a stream of files in any order: the first arrival of each URL stays, as in a batch."""
    folder = work_dir(spark, "arriving")
    media = split_parts(_products(spark, sf)).media
    media.repartition(6, F.xxhash64("page_id", "pos")).write.parquet(f"{folder}/media")
    rows = spark.readStream.schema(media.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/media")
    first = stream_first(rows, U.normalize_media_url(c("url")), G.arrival())
    write_corrections(first, f"{folder}/first", f"{folder}/checkpoint").awaitTermination()
    return corrected(spark.read.parquet(f"{folder}/first")).select("url", "media_type", "source_page_url")


@query
def stream_live_metrics(spark, sf):
    folder = work_dir(spark, "log")
    events = table(spark, sf, "events")
    events.repartition(4, "event_id").write.parquet(f"{folder}/log")
    log = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    rates = live_metrics(_fetch_log(log))

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rates")

    stream = rates.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/cp")
    stream.trigger(availableNow=True).start().awaitTermination()
    rates = spark.read.parquet(f"{folder}/rates")
    return rates.withColumn("error_rate", F.round("error_rate", 6))
