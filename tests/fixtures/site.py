"""A small site by hand: every page class, both link rules and the traps of each extraction rule."""

HOST = "https://www.example.com"
MENU = '<nav aria-label="Menu"><ul>{}</ul></nav>'

PRODUCT = """<html lang="en"><body>
<div data-elementor-type="product"><h1 class="elementor-heading-title"> </h1>
<h1 class="x elementor-heading-title">Cuvee A</h1><p class="elementor-heading-title">Brut</p>
<p class="elementor-heading-title">ignored</p></div>
<div id="section-start"><p>one</p><p> </p><p>two <b>bold</b></p></div>
<div id="section-fiche-technique">
<p class="elementor-heading-title">Chardonnay</p><p class="elementor-heading-title">35 %</p>
<p class="elementor-heading-title">Pinot  Noir</p><p class="elementor-heading-title">44,5</p>
<p class="elementor-heading-title">Pinot Meunier</p><p class="elementor-heading-title">20%</p>
<p class="elementor-heading-title">Chardonnay</p><p class="elementor-heading-title">99%</p>
<p class="elementor-heading-title">Serving temperature</p><p class="elementor-heading-title">8-10</p>
<p class="elementor-heading-title">odd</p>
<h5>Dosage</h5><h6>6,5 g/l</h6><h5>Maturation</h5><h6>3 years</h6><h5>Blend of</h5><h6>10 crus</h6>
<h5>Millésime</h5><h6>2012</h6><h5> DOSAGE </h5><h6>7 g/l</h6><h5>odd</h5>
<span><a class="elementor-button" href="/f/sheet.pdf?x=1#y">s</a></span></div>
<div id="section-note"><p>Guide</p><p>92</p><p></p><p>no title</p><p>Bare</p><p></p><p>odd</p></div>
<div><p>Nose</p><p>fine</p></div><div><p>other</p><p>block</p></div></body></html>"""

MEDIA = """<div data-elementor-type="product"><h1 class="elementor-heading-title">M</h1></div>
<img srcset="/a.jpg 2x, /b.jpg 640w, /c.jpg 640w, /d.jpg badw" src="/no.jpg">
<img data-lazy-srcset="/e.jpg" data-src="/no.jpg"><img data-src=" f.png?v=1#z "><img alt="none" style="background-image:url(/no.jpg)">
<video><source src="v1.mp4, v1b.mp4 2w"><source srcset="/v2.mp4"></video><video src="/v3.mp4"></video>
<picture><source srcset="/p.webp 100w, /q.webp 200w" src="/no.webp"><img src="/b.jpg"></picture>
<audio><source src="/no.mp3"></audio>
<div data-dce-background-image-url=" /bg1.jpg "></div><div data-dce-background-image-url="" style="background-image:url(/no.jpg)"></div>
<div style="background-image: url('../bg2.jpg'); x: url(/no.jpg)"></div>
<img src="/f.png?v=1"><img src="/en/champagnes-et-cuvees/f.png?v=1">"""

LINKS = """<div data-elementor-type="product"><h1 class="elementor-heading-title">L</h1></div>
<a href="mailto:a@b.org">1</a><a href="tel:1">2</a><a href="#x">3</a><a href="javascript:void(0)">4</a><a href="">5</a>
<a href="//other.org/en/x">6</a><a href="page.html">7</a><a href="https://elsewhere.org/?r=example.com">8</a>
<a href="/en/a/../b/?q#f">9</a><a href=" /en/b ">10</a><a href="mailto:me@example.com">11</a><a name="n">12</a>"""

CATALOG_PATH = "/en/champagnes/"
CARD = '<div data-elementor-type="loop-item">{}</div>'
CATALOG = "<body>" + CARD.format(
    '<a href="/en/maison">m</a><p class="elementor-heading-title"><a href="/en/champagnes-cuvees/z/?u">Zed</a></p>'
    '<div class="elementor-widget-text-editor"><p>sum</p></div><img src="/z.jpg"><img src="/z.jpg">'
) + CARD.format('<p class="elementor-heading-title"><a href="/en/maison">No product</a></p><img src="/no.jpg">') + CARD.format(
    '<a href="/en/champagnes-cuvees/untitled">x</a><img src="/no.jpg">'
) + '<a href="page.html">r</a><a href="mailto:x@example.com">s</a><a href="//other.org/x">t</a></body>'

TITLE, TEXT = '<h3 class="timeline-item__card-title">{}</h3>', '<div class="timeline-item__card-desc">{}</div>'
HISTORY = (
    "<section><div>" + TITLE.format("1825 - Start") + TEXT.format('<p>"Began"</p><p> </p><p>small</p>') + "</div>"
    "<div>" + TITLE.format("1900 - Silent") + "</div><div>" + TITLE.format(" ") + "</div>"
    "<div>" + TITLE.format("“2000”") + TEXT.format("plain") + "</div></section>"
)
HISTORY_EMPTY_TEXT = "<div>" + TITLE.format("1850 - Label here - more") + TEXT.format("<p> </p>") + "</div>"
BLOCK = '<div class="elementor-widget-text-editor"><div class="elementor-widget-container">{}</div></div>'
FAMILY = (
    '<div class="w elementor-widget-n-carousel"><b class="elementor-heading-title">t</b><h3>jean-claude FOO</h3><h3>B</h3><h3>b</h3><h3>extra</h3>'
    + BLOCK.format("<p>“a”</p><p>b</p>") + BLOCK.format("first") + BLOCK.format("last")
    + '</div><div class="elementor-widget-n-carousel"><h3>not a member</h3>' + BLOCK.format("x") + "</div>"
)
HOME = (
    '<div id="passion_familiale"><p class="elementor-heading-title"><b>Lead</b><br>"Some text"<!-- note --> <i>and more</i>'
    '</p><p class="elementor-heading-title">second</p></div>'
)

PAGES = [
    # page_id, url, final_url, html
    (1, HOST + "/", None, '<html lang=" FR-fr">' + MENU.format('<li class="weglot-language weglot-en"><a href="/en/?x=1">E</a></li>')),
    (2, HOST + "/fr/x", None, "<p>no menu</p>"),
    (3, HOST + "/fr/self", None, MENU.format('<li class="weglot-language weglot-en"><a href="/fr/self/#top">E</a></li>')),
    (4, HOST + "/fr/list", None, MENU.format('<li class="weglot-language"><a href="/de/a">D</a><a href="/en/a">E</a></li>')),
    (5, HOST + "/fr/title", None, MENU.format('<li><a title="English" href="/uk">E</a></li>')),
    (10, HOST + "/en", None, HOME),
    (11, HOST + "/en/?v=1", None, HOME),
    (12, "http://example.com/old", "http://example.com/en", HOME),
    (20, HOST + "/en/maison/histoire", None, HISTORY),
    (21, HOST + "/en/maison/histoire/leer", None, HISTORY_EMPTY_TEXT),
    (22, HOST + "/en/maison/famille", None, FAMILY),
    (30, HOST + CATALOG_PATH, None, CATALOG),
    (31, HOST + "/en/champagnes-et-cuvees", None, CATALOG),
    (40, HOST + "/en/champagnes-et-cuvees/a/?u=1", None, PRODUCT),
    (41, HOST + "/en/champagnes-et-cuvees/nameless", None, '<p>x</p><img src="/x.jpg"><a href="/en/x">x</a>'),
    (42, HOST + "/en/champagnes-et-cuvees/media", None, MEDIA),
    (43, HOST + "/en/champagnes-et-cuvees/links", None, LINKS),
]


def page_snapshot(spark):
    from sitegrain.sources.pages import page_table

    return page_table(spark.createDataFrame(PAGES, "page_id long, url string, final_url string, html string"))
