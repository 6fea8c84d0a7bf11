"""Product pages and product listings."""

from __future__ import annotations

from functools import lru_cache, partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain import rules as R
from sitegrain.functions import nodes as N
from sitegrain.functions.nodes import Page
from sitegrain.functions.text import first_number, let
from sitegrain.functions.urls import normalized, page_path, resolve_page_url, resolve_parts, split_url_once
from sitegrain.operators.media import unique_media
from sitegrain.operators.registry import Rule, on_found
from sitegrain.rules import SiteRules
from sitegrain.schemas import PRODUCT_PART_TYPE


def product_name(page: Page, url: Column) -> Column:
    """The last filled main heading and the first filled paragraph heading of the product block."""

    def of_tag(headings: Column, tag: str) -> Column:
        return F.filter(headings, lambda h: h.node.tag == tag)

    def build(root: Column) -> Column:
        both = F.zip_with(
            page.select(R.PRODUCT_HEADINGS), page.texts(R.PRODUCT_HEADINGS), lambda n, t: F.struct(n.alias("node"), t.alias("text"))
        )
        return let(
            F.filter(both, lambda h: h.text.isNotNull() & N.within(h.node, root)),
            lambda hs: F.concat_ws(" ", N.last(of_tag(hs, "h1")).text, F.get(of_tag(hs, "p"), F.lit(0)).text),
        )

    roots = page.select(R.PRODUCT_ROOT)
    return on_found(roots, lambda s: F.struct(let(F.get(s, F.lit(0)), build).alias("name")))


def product_description(page: Page, url: Column) -> Column:
    return on_found(page.texts(R.PRODUCT_DESCRIPTION), lambda ts: F.struct(F.array_join(ts, " ").alias("description")))


def _grapes(kv: Column) -> list[Column]:
    """Percentages of the three grapes, from labels ``k`` with numbers ``n``; later labels win."""

    def share(test) -> Column:
        return N.last(F.filter(kv, lambda p: test(p.k) & p.n.isNotNull())).n

    def chardonnay(k):
        return k.contains("chardonnay")

    def pinot(k):
        return ~chardonnay(k) & k.contains("pinot") & k.contains("noir")

    def meunier(k):
        return ~chardonnay(k) & ~(k.contains("pinot") & k.contains("noir")) & k.contains("meunier")

    return [share(t).alias(name) for name, t in zip(GRAPES, (chardonnay, pinot, meunier))]


def left_sheet(page: Page, url: Column, grape_pairs: int | None = None) -> Column:
    """Grapes and temperature from the left-hand sheet; ``grape_pairs`` limits where grapes are looked for."""

    def temperature(values: Column) -> Column:
        complete = F.filter(N.pairs(values), lambda p: p.k.isNotNull() & p.v.isNotNull())
        folded = F.transform(complete, lambda p: F.struct(F.lower(p.k).alias("k"), p.v.alias("v")))
        return N.find_by_patterns(folded, *R.TEMPERATURE_KEYS)

    def build(values: Column) -> Column:
        kv = N.key_values(N.pairs(values if grape_pairs is None else F.slice(values, 1, 2 * grape_pairs)))
        numbers = F.transform(kv, lambda p: F.struct(p.k.alias("k"), first_number(p.v).alias("n")))
        return let(numbers, lambda ps: F.struct(*_grapes(ps), temperature(values).alias("operating_temperature")))

    return on_found(page.texts(R.TECH_LEFT), build)


def right_sheet(page: Page, url: Column) -> Column:
    def build(kv: Column) -> Column:
        return F.struct(
            first_number(N.find_by_patterns(kv, *R.DOSAGE_KEYS)).alias("dosage_g_per_l"),
            N.find_by_patterns(kv, *R.AGING_KEYS).alias("aging"),
            N.find_by_patterns(kv, *R.BLEND_KEYS).alias("crus_assembles"),
            N.find_by_patterns(kv, *R.VINTAGE_KEYS).alias("millennium"),
        )

    return on_found(page.texts(*R.TECH_RIGHT), lambda ts: let(N.key_values(N.pairs(ts)), build))


def data_sheet(page: Page, url: Column) -> Column:
    def target(href: Column) -> Column:
        return F.when(href != "", let(split_url_once(url), lambda base: resolve_page_url(base, href)))

    buttons = page.select(R.DATA_SHEET)
    return on_found(
        buttons, lambda s: F.struct(let(N.attr(F.get(s, F.lit(0)), "href"), target).alias("data_sheet_url"))
    )


def awards(page: Page, url: Column) -> Column:
    def build(s: Column) -> Column:
        return F.struct(N.titled_pairs(s, "title", "value").alias("awards_and_ratings"))

    return on_found(page.texts(R.AWARDS), build)


def tasting_notes(page: Page, url: Column) -> Column:
    def build(s: Column) -> Column:
        return F.struct(N.titled_pairs(s, "title", "content").alias("tasting_notes"))

    return on_found(page.texts(R.TASTING), build)


GRAPES = ("grape_chardonnay_percent", "grape_pinot_noir_percent", "grape_meunier_percent")
SHEET = ("dosage_g_per_l", "aging", "crus_assembles", "millennium")


@lru_cache(maxsize=16)
def product_rules_of(rules: SiteRules) -> tuple[Rule, ...]:
    """The rules of a product page; the same objects for the same site."""
    sheet = partial(left_sheet, grape_pairs=rules.grape_pairs)
    return (
        Rule("product_name", ("name",), product_name),
        Rule("product_description", ("description",), product_description),
        Rule("left_sheet", (*GRAPES, "operating_temperature"), sheet, frozenset(GRAPES)),
        Rule("right_sheet", SHEET, right_sheet, frozenset(["dosage_g_per_l"])),
        Rule("data_sheet", ("data_sheet_url",), data_sheet),
        Rule("awards", ("awards_and_ratings",), awards, frozenset(["awards_and_ratings"])),
    )


# Not part of a product record; offered for reports and other rule lists.
TASTING_RULE = Rule("tasting", ("tasting_notes",), tasting_notes, frozenset(["tasting_notes"]))


def product_struct(values: dict[str, Column], name: Column, product_url: Column, page_url: Column) -> Column:
    """A product part in the order of ``PRODUCT_PART_TYPE``; absent fields are null."""
    known = {"name": name, "product_url": product_url, "source_page_url": page_url, **values}
    known.setdefault("awards_and_ratings", F.array())
    fields = [f.split(":")[0] for f in PRODUCT_PART_TYPE[7:-1].replace("title:string,value:string", "").split(",")]
    return F.struct(*[known.get(f, F.lit(None)).alias(f) for f in fields]).cast(PRODUCT_PART_TYPE)


def listing_cards(page: Page, url: Column, media: Column, rules: SiteRules) -> Column:
    """``struct(product_url, name, description, media)`` of each complete card.

    A card needs a title and an internal link to a product page. ``media`` are the page's media
    items in step with ``R.MEDIA``; every kind of element is given to the cards by position.
    """

    def product_link(base: Column, node: Column) -> Column:
        def check(p: Column) -> Column:
            key = normalized(p)
            fits = p.netloc.isin("", *rules.hosts) & let(key, lambda k: page_path(k).rlike(f"(?iu){rules.product_path}"))
            return F.when(fits, key)

        return let(N.attr(node, "href"), lambda h: F.when(h != "", let(resolve_parts(base, h), check)))

    def first_text(sel: N.Sel) -> Column:
        return F.transform(page.inside(cards, (sel,), page.texts(sel)), lambda ts: F.get(ts, F.lit(0)))

    cards = (R.LISTING_CARD,)
    links = let(split_url_once(url), lambda base: F.transform(page.select(R.LINKS), lambda n: product_link(base, n)))
    parts = F.arrays_zip(
        F.transform(page.inside(cards, (R.LINKS,), links), lambda us: F.get(F.filter(us, lambda u: u.isNotNull()), F.lit(0))).alias("product_url"),
        first_text(R.LISTING_TITLE).alias("name"),
        first_text(R.LISTING_SUMMARY).alias("description"),
        F.transform(page.inside(cards, R.MEDIA, media), unique_media).alias("media"),
    )
    return F.filter(parts, lambda c: c.product_url.isNotNull() & c["name"].isNotNull())
