"""Images and videos of parsed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain import rules as R
from sitegrain.functions import nodes as N
from sitegrain.functions.nodes import Page
from sitegrain.functions.text import BLANK, empty_to_null, let, strip
from sitegrain.functions.urls import resolve_media_url, split_url_once

IMAGE, VIDEO = "image", "video"
# Where lazily loaded pictures keep their sources, in order of preference.
SRCSET_ATTRS = ("srcset", "data-srcset", "data-lazy-srcset")
SRC_ATTRS = ("src", "data-src", "data-lazy-src", "data-original")
# A stripped candidate: its URL, and the width in its second word. A text without blanks and commas is one URL.
FIRST_WORD, WIDTH = rf"(?U)^[^{BLANK[1:-1]}]*", rf"(?U)^[^{BLANK[1:-1]}]+{BLANK}+([+-]?[0-9]+)[wW](?={BLANK}|\z)"
SEVERAL = rf"(?U)[,{BLANK[1:-1]}]"
STYLE_URL = r"""url\(["']?([^\n]*?)["']?\)"""


def best_srcset(srcset: Column) -> Column:
    """The candidate with the largest ``w`` width; the first one on a tie or without widths."""

    def candidate(chunk: Column, i: Column) -> Column:
        # Spark compiles the pattern of a split anew for each row, that of an extraction once.
        width = F.regexp_extract(chunk, WIDTH, 1).try_cast("bigint")
        url = F.regexp_extract(chunk, FIRST_WORD, 0)
        return F.struct(F.coalesce(width, F.lit(0)).alias("width"), (-i).alias("place"), url.alias("url"))

    def best(s: Column) -> Column:
        listed = F.transform(F.transform(F.split(s, ",", -1), strip), candidate)
        return F.when(s.rlike(SEVERAL), F.array_max(F.filter(listed, lambda c: c.url != "")).url).when(s != "", s)

    return let(srcset, best)


def _first_of(node: Column, names: tuple[str, ...]) -> Column:
    """The first non-empty attribute."""
    return F.coalesce(*[F.when(N.raw_attr(node, n) != "", N.raw_attr(node, n)) for n in names])


def best_image_url(img: Column) -> Column:
    listed = best_srcset(strip(_first_of(img, SRCSET_ATTRS)))
    return F.coalesce(listed, *[let(_first_of(img, (n,)), lambda v: F.when(strip(v) != "", strip(v))) for n in SRC_ATTRS])


def media_items(page: Page, url: Column, kind: tuple[N.Sel, ...] = R.MEDIA) -> Column:
    """``struct(media_type, url)`` of every media element of the kind, in step with its elements; without a URL, null."""
    nodes = page.nodes

    def in_video(video: Column) -> Column:
        sources = F.filter(
            F.slice(nodes, video.idx + 2, video.end - video.idx),
            lambda n: (n.tag == "source")
            & (N.raw_attr(n, "src").isNotNull() | N.raw_attr(n, "srcset").isNotNull()),
        )
        raw = _first_of(F.get(sources, F.lit(0)), ("src", "srcset"))
        return best_srcset(strip(raw))

    def source_url(node: Column, names: tuple[str, str]) -> Column:
        # A source list without a single URL resolves to the page itself.
        raw = _first_of(node, names)
        return let(raw, lambda r: F.when(r.isNotNull(), F.coalesce(best_srcset(r), url)))

    def styled(node: Column) -> Column:
        style = N.attr(node, "style")
        hit = empty_to_null(strip(F.regexp_extract(style, STYLE_URL, 1)))
        return F.when(style.contains(R.BACKGROUND_STYLE), hit)

    def item(base: Column, node: Column) -> Column:
        above = F.get(nodes, node.parent).tag
        background = N.raw_attr(node, R.BACKGROUND_ATTR)
        raw = (
            F.when(node.tag == "img", best_image_url(node))
            .when(node.tag == "video", F.coalesce(_first_of(node, ("src",)), in_video(node)))
            .when((node.tag == "source") & (above == "video"), source_url(node, ("src", "srcset")))
            .when((node.tag == "source") & (above == "picture"), source_url(node, ("srcset", "src")))
            .when(node.tag == "source", F.lit(None))
            .when(background.isNotNull(), empty_to_null(strip(background)))
            .otherwise(styled(node))
        )
        video = (node.tag == "video") | ((node.tag == "source") & (above == "video"))
        target = let(raw, lambda h: F.when(h.isNotNull(), resolve_media_url(base, h)))
        kinds = F.when(video, VIDEO).otherwise(IMAGE).alias("media_type")
        return let(target, lambda t: F.when(t.isNotNull(), F.struct(kinds, t.alias("url"))))

    return let(split_url_once(url), lambda base: F.transform(page.select(*kind), lambda n: item(base, n)))


def unique_media(items: Column) -> Column:
    """Each media URL once, at its first place."""
    return N.first_per_key(F.filter(items, lambda m: m.isNotNull()), lambda m: m.url)


def page_media(page: Page, url: Column, kind: tuple[N.Sel, ...] = R.MEDIA) -> Column:
    """Each media URL of the page once, at its first place."""
    return unique_media(media_items(page, url, kind))


def media_type_counts(media: DataFrame) -> DataFrame:
    return media.groupBy("media_type").agg(F.count("*").alias("n"))
