"""Links of parsed pages and the two rules that keep them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain import rules as R
from sitegrain.functions import nodes as N
from sitegrain.functions.nodes import Page
from sitegrain.functions.text import let
from sitegrain.functions.urls import WEB_URL, in_scope, is_plain_path, normalized, plain_path_url, resolve_parts, split_url_once
from sitegrain.rules import SiteRules


def hrefs(page: Page) -> Column:
    """Every non-empty link target of the page, as written and once each."""
    found = F.transform(page.select(R.LINKS), lambda a: N.attr(a, "href"))
    return F.array_distinct(F.filter(found, lambda h: h != ""))


def is_navigable(href: Column) -> Column:
    out = F.lit(True)
    for prefix in R.SKIPPED_LINK_PREFIXES:
        out = out & ~href.startswith(prefix)
    return out


def passes_page_rule(href: Column, rules: SiteRules) -> Column:
    """The rule of product and house pages looks at the written link only.

    ``//other.host/x`` and foreign links that mention the domain pass, ``page.html`` does not.
    """
    return href.startswith("/") | href.contains(rules.domain)


def _resolved(base: Column, found: Column, hosts: tuple[str, ...], by_host: Column) -> Column:
    """Normalised absolute forms, each once; where ``by_host`` holds, only those on these hosts."""

    def keep(host: Column, value: Column) -> Column:
        return F.when(~by_host | host.isin("", *hosts), value)

    def target(href: Column) -> Column:
        general = let(resolve_parts(base, href), lambda p: keep(p.netloc, normalized(p)))
        # Most links of most pages: no need to take them apart and put them together again.
        own = keep(base.netloc, plain_path_url(base, href))
        web = F.regexp_replace(href, WEB_URL, "$1")
        return F.when(is_plain_path(base, href), own).when(~by_host & href.rlike(WEB_URL), web).otherwise(general)

    return F.array_distinct(F.filter(F.transform(found, target), lambda u: u.isNotNull()))


def links_by_class(page: Page, url: Column, rules: SiteRules, is_catalog: Column) -> Column:
    """The links of a page under the rule of its class.

    Listing pages resolve a link first and keep it by host; product and house pages keep
    it as written and then resolve it.
    """

    def build(s: Column) -> Column:
        found = F.filter(
            hrefs(page),
            lambda h: F.when(s.catalog, is_navigable(h)).otherwise(passes_page_rule(h, rules)),
        )
        return _resolved(s.base, found, rules.hosts, s.catalog | F.lit(rules.strict_hosts))

    return let(F.struct(split_url_once(url).alias("base"), is_catalog.alias("catalog")), build)


def catalog_links(page: Page, url: Column, rules: SiteRules) -> Column:
    return links_by_class(page, url, rules, F.lit(True))


def page_links(page: Page, url: Column, rules: SiteRules) -> Column:
    return links_by_class(page, url, rules, F.lit(False))


def link_table(pages: DataFrame, links: str = "links") -> DataFrame:
    """One row per page and link: ``page_id, src_url, url``."""
    return pages.select("page_id", F.col("final_url").alias("src_url"), F.explode(links).alias("url"))


def scoped(links: DataFrame, rules: SiteRules) -> DataFrame:
    return links.where(in_scope(F.col("url"), rules.scope))


def distinct_urls(*tables: DataFrame) -> DataFrame:
    """The set of link targets over several tables."""
    out = tables[0].select("url")
    for t in tables[1:]:
        out = out.unionByName(t.select("url"))
    return out.distinct()


def dedupe_ratio(links: DataFrame) -> DataFrame:
    """``seen, unique_urls, duplicates, ratio`` of a link table."""
    seen, unique = F.count("url"), F.countDistinct("url")
    return links.agg(
        seen.alias("seen"),
        unique.alias("unique_urls"),
        (seen - unique).alias("duplicates"),
        F.try_divide(seen - unique, seen).alias("dedupe_ratio"),
    )
