"""Pages rendered from the test tables by Spark expressions, so that what is extracted can be
compared with the rows it came from. Which rows lack a part is a rule on the key, so the pages
hold the odd cases in known places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.rules import SiteRules
from sitegrain.sources.pages import page_table

# The rendered sheets name a grape again in a later pair; this site reads the first three only.
RULES = SiteRules(catalog_path=r"^/en/list/[0-9]+/?$", grape_pairs=3)
SITE = f"https://{RULES.host}"
FRENCH_IDS = 1_000_000_000
LIST_IDS = 2_000_000_000
HOUSE_IDS = 3_000_000_000
CARDS_PER_LIST = 10


def spread(df: DataFrame, key: str) -> DataFrame:
    """The test tables are single files: deal their rows to all cores."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _html(*pieces) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces])


def _if(test: Column, value: Column | str, other: Column | str = "") -> Column:
    a = F.lit(value) if isinstance(value, str) else value
    b = F.lit(other) if isinstance(other, str) else other
    return F.when(test, a).otherwise(b)


def _pages(rows: DataFrame, page_id: Column, url: Column, html: Column) -> DataFrame:
    return page_table(rows.select(page_id.cast("long").alias("page_id"), url.alias("url"), html.alias("html")))


def _heading(*text) -> Column:
    return _html('<p class="elementor-heading-title">', *text, "</p>")


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One product page per part; every part k links to parts 2k+1 and 2k+2."""
    part = spread(table(spark, sf, "part"), "p_partkey")
    k, size = F.col("p_partkey"), F.col("p_size")
    nameless = k % 17 == 5
    title = _html(
        '<div data-elementor-type="product"><h1 class="elementor-heading-title">',
        _if(nameless, " ", F.col("p_name")), "</h1>",
        _if((k % 13 == 0) & ~nameless, _html('<h1 class="elementor-heading-title">Reserve ', F.col("p_name"), "</h1>")),
        _if((k % 11 != 0) & ~nameless, _heading(F.col("p_brand"))), "</div>",
    )
    story = _html('<div id="section-start"><p> ', F.col("p_type"), "\n</p><p>size&nbsp;", size, "<br>cm</p><p> </p></div>")
    sheet = _html(
        '<div id="section-fiche-technique">',
        _heading("Chardonnay"), _heading(size, " %"),
        _heading("Pinot  <b>Noir</b>"), _heading(size + 1, ",5 %"),
        _heading("Pinot Meunier"), _heading(_if(k % 3 == 0, "n/a", _html(size + 2, "%"))),
        _heading("Operating\nTemperature"), _heading("8-", size % 5 + 9, " C"),
        _heading("Chardonnay"), _heading("99 %"),
        "<h5>Dosage</h5><h6>", size, ",5 g/l</h6><h5>Ageing</h5><h6>", k % 7 + 1, " years</h6>",
        "<h5>Crus assembl&eacute;s</h5><h6>", F.col("p_type"), "</h6><h5>Mill&eacute;sime</h5><h6>", k % 20 + 2000, "</h6>",
        _if(k % 4 == 0, "<h5>DOSAGE</h5><h6>1 g/l</h6>"),
        _if(k % 9 != 0, _html('<a class="elementor-button" href="/docs/part-', k, '.pdf?v=2">sheet</a>')), "</div>",
    )
    notes = _html(
        '<div id="section-note"><p>', F.col("p_brand"), "</p><p>", F.col("p_retailprice"),
        "</p><p>Guide</p><p></p><p>odd</p></div><div><p>Nose</p><p>", F.col("p_type"), "</p></div>",
    )
    brand = F.regexp_replace("p_brand", "#", "-")
    media = _html(
        '<img srcset="/img/', k, "-s.jpg?q=1 320w, /img/", k, "-l.jpg ", size * 100, 'w" src="/img/none.jpg">',
        '<img data-src=" /img/', brand, '.png?b=1#x ">', '<video><source src="/video/', size, '.mp4"></video>',
        "<div style=\"color:red; background-image: url('/bg/", k % 10, ".jpg')\"></div>",
        '<img srcset="/img/', k, "-s.jpg?q=1 320w, /img/", k, "-l.jpg ", size * 100, 'w">',
    )
    links = _html(
        '<ul><li><a href="/en/champagnes-et-cuvees/part-', k * 2 + 1, "/?from=", k, '">a</a><li><a href="',
        SITE, "/en/champagnes-et-cuvees/part-", k * 2 + 2, '#top">b</a><li><a href="/en">home</a>',
        '<li><a href="/legal/terms">c</a><li><a href="page.html">d</a><li><a href="mailto:x@y.org">e</a></ul>',
    )
    html = _html(
        '<!DOCTYPE html><html lang="en"><head><title>p</title><script>var a="</p>";</script></head><body>',
        title, story, sheet, notes, media, links, "</body></html>",
    )
    return _pages(part, k, _html(SITE, "/en/champagnes-et-cuvees/part-", k), html)


def french_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One French page per part, with the five kinds of language menu in turn."""
    part = spread(table(spark, sf, "part"), "p_partkey")
    k = F.col("p_partkey")
    own = _html(SITE, "/fr/part-", k)

    def entry(cls: str, href: Column) -> Column:
        return _html('<ul><li class="weglot-language', cls, '"><a href="', href, '">x</a></ul>')

    menu = (
        F.when(k % 5 == 0, entry(" weglot-en", _html("/en/champagnes-et-cuvees/part-", k, "/?x=1")))
        .when(k % 5 == 1, entry("", _html(SITE, "/en/part-", k)))
        .when(k % 5 == 2, _html('<a href="/english/', k, '" title="English">English</a>'))
        .when(k % 5 == 3, entry(" weglot-de", _html("/de/part-", k)))
        .otherwise(entry(" weglot-en", _html(own, "#x")))
    )
    html = _html(
        "<html", _if(k % 2 == 0, ' lang=" FR-fr"'), '><body><nav aria-label="Menu">', menu,
        '</nav><a href="/en/maison">outside</a></body></html>',
    )
    return _pages(part, k + FRENCH_IDS, own, html)


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Listings of ten parts each; some cards lack a title or a product link."""
    k = F.col("p_partkey")
    part = spread(table(spark, sf, "part").withColumn("n", F.floor(k / CARDS_PER_LIST)), "n")
    href = _if(k % 6 == 1, _html("/other/", k), _html("/en/champagnes-et-cuvees/part-", k, "?from=list"))
    card = _html(
        '<div data-elementor-type="loop-item"><p class="elementor-heading-title"><a href="', href, '">',
        _if(k % 7 == 0, " ", F.col("p_name")), '</a></p><div class="elementor-widget-text-editor"><p>listed ',
        F.col("p_type"), '</p></div><img src="/img/', k, '-card.jpg"><img src="/img/', k, '-card.jpg"></div>',
    )
    lists = part.groupBy("n").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), card.alias("c")))), lambda s: s.c), "\n").alias("cards")
    )
    html = _html('<html lang="en"><body>', F.col("cards"), '<a href="/en/">home</a><a href="https://elsewhere.org/">x</a></body></html>')
    return _pages(lists, F.col("n") + LIST_IDS, _html(SITE, "/en/list/", F.col("n")), html)


def house_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier one page about commitments, one about history and one about the family."""
    supplier = spread(table(spark, sf, "supplier"), "s_suppkey")
    s, name = F.col("s_suppkey"), F.col("s_name")
    about = _html(
        '<div id="passion_familiale"><p class="elementor-heading-title"><b>Lead in</b><br>"House of ', name,
        '" <i>since ', s % 200 + 1800, "</i></p></div>",
    )
    item = '<div class="item"><h3 class="timeline-item__card-title">'
    history = _html(
        "<section><div>", item, s % 200 + 1800, " - Start</h3>",
        '<div class="timeline-item__card-desc"><p>"', name, '"</p><p>opens</p></div></div>',
        _if(s % 2 == 0, _html(item, s % 200 + 1810, " - Cellar</h3></div>")),
        _if(s % 3 == 0, _html(item, s % 200 + 1820, ' - Award</h3><div class="timeline-item__card-desc">Medal ', s, "</div></div>")),
        "</div></section>",
    )
    text = '<div class="elementor-widget-text-editor"><div class="elementor-widget-container">'
    family = _html(
        '<div class="elementor-widget-n-carousel"><span class="elementor-heading-title">t</span>',
        "<h3>jean-claude ", F.upper(name), "</h3><h3>Anne</h3><h3>ANNE</h3><h3>spare</h3>",
        text, "<p>“first”</p><p>", name, "</p></div></div>", text, "early</div></div>", text, "late ", s, "</div></div></div>",
    )
    kinds = F.explode(
        F.array(
            F.struct(F.lit(0).alias("n"), F.lit("/en/engagements/").alias("path"), about.alias("body")),
            F.struct(F.lit(1).alias("n"), F.lit("/en/maison/histoire/").alias("path"), history.alias("body")),
            F.struct(F.lit(2).alias("n"), F.lit("/en/maison/famille/").alias("path"), family.alias("body")),
        )
    )
    rows = supplier.select("s_suppkey", kinds.alias("p"))
    html = _html('<html lang="en"><body>', F.col("p.body"), '<a href="/en/maison/">m</a></body></html>')
    return _pages(rows, F.lit(HOUSE_IDS) + s * 3 + F.col("p.n"), _html(SITE, F.col("p.path"), s), html)


def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The whole rendered site: listings, then products, houses and French pages."""
    order = {LIST_IDS: listing_pages, 0: product_pages, HOUSE_IDS: house_pages, FRENCH_IDS: french_pages}
    out = None
    for n, pages in enumerate(order.values()):
        part = pages(spark, sf).withColumn("seq", F.lit(n).cast("long"))
        out = part if out is None else out.unionByName(part)
    return out
