"""Language routing, page classes and one-page-per-name filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain import rules as R
from sitegrain.functions import nodes as N
from sitegrain.functions.nodes import Page
from sitegrain.functions.text import empty_to_null, let
from sitegrain.functions.urls import absolute_url, below, canonical_page_url, normalized, page_path, split_url_once
from sitegrain.rules import SiteRules

PRODUCT, CATALOG, HISTORY, FAMILY, HOME = "product", "catalog", "history", "family_spirit", "winery"
WINERY_CLASSES = (HISTORY, FAMILY, HOME)


def _path_like(path: Column, pattern: str) -> Column:
    return path.rlike(f"(?iu){pattern}")


def is_product_page(url: Column, rules: SiteRules) -> Column:
    return _path_like(page_path(url), rules.product_path)


def is_catalog_page(url: Column, rules: SiteRules) -> Column:
    return _path_like(page_path(url), rules.catalog_path)


def is_winery_page(url: Column, rules: SiteRules) -> Column:
    return _path_like(page_path(url), rules.winery_path)


def winery_page_class(url: Column, rules: SiteRules) -> Column:
    """The class of a page already known to describe the house."""
    low = F.lower(page_path(url))
    return (
        F.when(low.contains(rules.history_marker), HISTORY)
        .when(low.contains(rules.family_marker), FAMILY)
        .otherwise(HOME)
    )


def page_class(url: Column, rules: SiteRules) -> Column:
    """The first class whose rule fits the path; null for a page that yields nothing.

    The bare path of a site's root is ``''``, so ``/`` among the home paths never fits
    unless ``root_is_home`` is set.
    """
    path = page_path(url)
    low = F.lower(path)
    homes = (*rules.home_paths, "") if rules.root_is_home else rules.home_paths
    return (
        F.when(_path_like(path, rules.product_path), PRODUCT)
        .when(_path_like(path, rules.catalog_path), CATALOG)
        .when(low.contains(rules.history_marker), HISTORY)
        .when(low.contains(rules.family_marker), FAMILY)
        .when(_path_like(path, rules.winery_path) | low.isin(*homes), HOME)
    )


def page_language(page: Page) -> Column:
    return F.lower(N.attr(page.select_one(N.el("html")), "lang"))


def is_language_page(page: Page, final_url: Column, lang: str) -> Column:
    """The page says so in ``<html lang>``, or its path lies below ``/{lang}``."""
    return page_language(page).startswith(lang) | below(page_path(final_url), f"/{lang}")


def may_be_language_page(html: Column, final_url: Column, lang: str) -> Column:
    """Every page of a language and perhaps others, told from the raw text before parsing."""
    said = html.rlike(rf"(?i)\blang\s*=\s*[\"']?[^\"'<>a-z&]*(?:{lang}|&)")
    return said | below(page_path(final_url), f"/{lang}")


def language_switch_url(page: Page, url: Column, lang: str = "en") -> Column:
    """Where the page's menu leads for another language; null when it does not say.

    Tried in order: the menu entry of the language, any language entry with ``/{lang}/``
    in its link and, for English, a link named or spelled so elsewhere in the menu.
    """

    def hrefs(*sels: N.Sel) -> Column:
        return F.transform(page.select(*sels), lambda a: N.attr(a, "href"))

    entry = F.get(hrefs(R.menu_links(lang)), F.lit(0))
    listed = F.get(F.filter(hrefs(R.MENU_LANGUAGE_LINKS), lambda h: h.contains(f"/{lang}/")), F.lit(0))
    tries = [entry, listed]
    if lang == "en":
        tries.append(F.get(hrefs(*R.MENU_ENGLISH_LINKS), F.lit(0)))
    chosen = F.coalesce(*[empty_to_null(t) for t in tries])
    return let(chosen, lambda h: F.when(h.isNotNull(), absolute_url(url, h)))


def routed_links(page: Page, final_url: Column, rules: SiteRules) -> Column:
    """The only links of a page in the routed language: its other version, unless that is itself."""

    def key(u: Column) -> Column:
        return let(split_url_once(u), normalized)

    other = let(language_switch_url(page, final_url, rules.target_lang), key)
    return F.filter(F.array(other), lambda u: u.isNotNull() & (u != "") & (u != key(final_url)))


def first_per_final_url(keys: DataFrame, rules: SiteRules) -> DataFrame:
    """``canon, page_id, seq`` of the first page of each canonical name.

    Give it the narrow columns ``page_id, final_url, seq`` only: the minimum is combined
    before the shuffle, so a name held by a third of all pages is one row per task.
    """
    canon = canonical_page_url(F.col("final_url"), rules.host)
    first = F.min(F.struct("seq", "page_id")).alias("first")
    return keys.groupBy(canon.alias("canon")).agg(first).select("canon", "first.page_id", "first.seq")
