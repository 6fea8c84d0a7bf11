import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitegrain import rules as R
from sitegrain.functions import nodes as N
from sitegrain.operators import html as H
from sitegrain.operators.html import page_nodes


def _texts(spark, html, *sels):
    page = N.Page()
    texts = N.texts(page.nodes, page.select(*sels)).alias("t")
    return page_nodes(spark.createDataFrame([(1, html)], "page_id long, html string"), page).select(texts).first().t


def test_malformed_markup(spark):
    html = '<p><b>one<br></br>two<p>three</i></b>four<script>var a = "</p>";</script><style>p{}</style><!-- c -->five'
    assert _texts(spark, html, N.el("p")) == ["one two three four five", "three"]  # </b> closes the inner paragraph, too
    assert _texts(spark, html, N.el("br")) == [None]


def test_entities_and_hidden_text(spark):
    html = "<p>a&amp;b &eacute;&unknown; &#150;&#x41; x&amp</p><template><p>t</p></template><p>&nbsp;z <![CDATA[q]]></p>"
    assert _texts(spark, html, N.el("p")) == ["a&b é&unknown –A x&", None, "z q"]


def test_broken_or_missing_page_gives_no_nodes(spark):
    rows = page_nodes(spark.createDataFrame([(1, None), (2, ""), (3, "<p>x")], "page_id long, html string"))
    assert [(r.page_id, len(r.nodes), r.parse_error) for r in rows.orderBy("page_id").collect()] == [(1, 0, None), (2, 0, None), (3, 2, None)]


def test_selector_forms(spark):
    html = (
        '<div id="a"><p class="x y">1</p><p class="y">2</p></div><div class="k"><p>3</p><a href="/en/1">4</a><a>5</a></div>'
        '<div class="k"><span><a href="/z" title="English">6</a></span></div>'
    )
    a, k = N.el(id="a"), N.el("div", "k")
    cases = {
        (N.el("p", "x", "y"),): ["1"],
        (N.el("p").inside(a),): ["1", "2"],
        (N.el("p").inside(N.el("div").after(a)),): ["3"],
        (N.el("a", has=("href",)).inside(k),): ["4", "6"],
        (N.el("a", contain={"href": "/en/"}), N.el(None, "x")): ["1", "4"],
        (N.el("a", equal={"title": "English"}),): ["6"],
        (N.el("a", first_of_type=True),): ["4", "6"],
        (N.el("div", having=N.el("span")),): ["6"],
    }
    for sels, expected in cases.items():
        assert _texts(spark, html, *sels) == expected, sels


def test_pairs_and_keys(spark):
    values = F.array(*[F.lit(v) for v in ["K", "1", "b", None, "k", "2", "odd"]])
    got = spark.range(1).select(
        N.pairs(values).alias("p"), N.key_values(N.pairs(values)).alias("kv"), N.titled_pairs(values, "t", "c").alias("tc")
    ).first()
    assert [tuple(x) for x in got.p] == [("K", "1"), ("b", None), ("k", "2")]
    assert [tuple(x) for x in got.kv] == [("k", "2")]
    assert [tuple(x) for x in got.tc] == [("K", "1"), ("b", ""), ("k", "2")]


def plain_hits(nodes, sel):
    """A selector by its definition: every node is looked at, and everything around it."""

    def alone(i, s):
        n = nodes[i]
        attrs, classes = dict(n["attrs"] or []), dict(n["attrs"] or []).get("class", "").split()
        same = [j for j, m in enumerate(nodes[:i + 1]) if m["parent"] == n["parent"] and m["tag"] == n["tag"]]
        before = [j for j, m in enumerate(nodes[:i]) if m["parent"] == n["parent"] and not m["tag"].startswith("#")]
        return (
            not n["tag"].startswith("#") and (not s.tag or n["tag"] == s.tag) and (not s.id or attrs.get("id") == s.id)
            and all(c in classes for c in s.classes) and (not s.first_of_type or same == [i])
            and all(k in attrs and (t == "has" or (t == "=" and attrs[k] == v) or (t == "*=" and v in attrs[k])) for k, t, v in s.attrs)
            and (not s.previous or (before and alone(before[-1], s.previous)))
            and (not s.having or any(alone(j, s.having) for j in range(i + 1, n["end"] + 1)))
        )

    scopes = plain_hits(nodes, sel.scope) if sel.scope else None
    return [
        i for i in range(len(nodes)) if alone(i, sel) and (scopes is None or any(s < i <= nodes[s]["end"] for s in scopes))
    ]


def random_html(rng):
    out, open_ = [], []
    for _ in range(rng.randint(5, 60)):
        if open_ and rng.random() < 0.35:
            out.append(f"</{rng.choice([open_.pop(), 'p'])}>")
            continue
        tag = rng.choice(["div", "p", "a", "h3", "span", "li", "br"])
        attrs = "".join(
            f' {k}="{v}"' for k, v in [("class", rng.choice(["x", "x y", "y x x", "elementor-heading-title", ""])), ("id", rng.choice(["a", "b"])), ("href", rng.choice(["/en/1", "/z"]))]
            if rng.random() < 0.4
        )
        out.append(f"<{tag}{attrs}>" + rng.choice(["", "text", "<!-- c -->"]))
        open_ += [tag] if tag != "br" else []
    return "".join(out)


def test_matcher_as_by_definition():
    """Selectors, spans and nearest items on random pages, several pages through one matcher."""
    el = N.el
    sels = [
        el("p"), el(None, "x"), el(None, "x", "y"), el(id="a"), el(), el("a", has=("href",)), el("a", contain={"href": "/en/"}), el("a", equal={"href": "/z"}),
        el("p", first_of_type=True), el("div", having=el("p")), el("p").inside(el("div")), el("p").inside(el("div", "x").inside(el("span"))),
        el("p").inside(el("div", having=el(None, "elementor-heading-title"))), el("p").inside(el("div").after(el(id="a"))), el(None, "y").after(el("p", having=el("a"))),
    ]
    spans = [N.Spans((a,), (b,)) for a in (el("div"), el("p")) for b in (el("a"), el("p"), el())]
    near = [N.Nearest((el("h3"),), (el("p"),)), N.Nearest((el("p"),), (el("a"), el(None, "x")))]
    requests = (*[N.Hits((s,)) for s in sels], N.Hits((sels[0], sels[1], sels[5])), *spans, *near)
    rng = random.Random(7)
    pages = [random_html(rng) for _ in range(150)]
    nodes, found, _, errors = H._parsed(pa.array(pages), pa.nulls(len(pages), pa.string()), requests, ())
    for page, answers, error in zip(nodes.to_pylist(), found.to_pylist(), errors.to_pylist(), strict=True):
        assert error is None
        got = dict(zip(requests, answers, strict=True))

        def hits(group):
            return sorted({i for s in group for i in plain_hits(page, s)})

        for request, answer in got.items():
            if isinstance(request, N.Hits):
                assert answer == hits(request.of), request
            elif isinstance(request, N.Spans):
                items = hits(request.items)
                inside = [[i for i in items if b < i <= page[b]["end"]] for b in hits(request.blocks)]
                assert [items[at:at + n] for at, n in zip(answer[::2], answer[1::2], strict=True)] == inside
            else:
                items, want = hits(request.items), []
                for i in hits(request.of):
                    around = [a for a in range(i) if a < i <= page[a]["end"] and any(a < j <= page[a]["end"] for j in items)]
                    want.append(next(n for n, j in enumerate(items) if a_in(page, around, j)) if around else 0)
                assert answer == want


def a_in(page, around, j):
    return around[-1] < j <= page[around[-1]]["end"]


def test_pages_of_many_bytes_are_cut():
    sizes = [H.BYTES_PER_BATCH * 2, 10, 10, H.BYTES_PER_BATCH, *[1] * 300]
    cuts = list(H._cuts(sizes))
    assert [i for a, b in cuts for i in range(a, b)] == list(range(len(sizes)))
    assert all(b - a <= H.ROWS_PER_BATCH and (b - a == 1 or sum(sizes[a:b]) <= H.BYTES_PER_BATCH) for a, b in cuts)


def test_large_pages_cost_in_proportion(spark):
    """16,000 cards, and 50,000 images of which half repeat, in seconds."""
    import time

    from sitegrain.plans.extract import extract_pages

    rules = R.SiteRules()
    card = '<div data-elementor-type="loop-item"><p class="elementor-heading-title"><a href="/en/champagnes-cuvees/{0}">n{0}</a></p><img src="/i{0}.jpg"></div>'
    rows = [
        (1, "https://www.example.com/en/champagnes", "".join(card.format(i) for i in range(16_000))),
        (2, "https://www.example.com/en/maison", "".join(f'<img src="/{i % 25_000}.jpg">' for i in range(50_000))),
    ]
    pages = spark.createDataFrame([(i, u, u, i, h) for i, u, h in rows], "page_id long, url string, final_url string, seq long, html string")
    start = time.time()
    got = {r.page_id: r for r in extract_pages(pages, rules).collect()}
    assert (len(got[1].products), len(got[1].media), len(got[2].media)) == (16_000, 16_000, 25_000)
    assert got[1].products[77].name == "n77" and got[1].products[77].product_url.endswith("/77")
    assert time.time() - start < 200  # minutes or hours if anything were compared in pairs


def test_usual_markup_is_read_as_by_the_standard_parser(monkeypatch):
    """Pages of common and odd pieces give the same nodes and hits with and without the short way."""
    import random

    import pyarrow as pa

    from sitegrain.operators import html as H

    pieces = [
        "<p>", "</p>", '<div class="a b" id=x>', "<P class='a'>", "</div>", "<br>", "<br/>", "</br>", '<img src="a?b=1&amp;c">', "<script>", "</script >",
        "var a='</p>'", "&amp;", "&nbsp", "&#65;", "&#x41", "& ", "&T ", "&foo-", "<", "< p", "<!", "<!-- c -->", "<!--->", "<!-- a --->", "<!DOCTYPE html>",
        "<![CDATA[x]]>", "<?php x ?>", "</>", "</p x>", '<a href="x"b>', "<a href=x/>", "<a b />", "<li", '">', "text ", "<svg:x a:b='1'>", "<p a = 1>", "<p\x0b>",
    ]
    pick = random.Random(1)
    pages = ["".join(pick.choice(pieces) for _ in range(pick.randint(1, 12))) for _ in range(3000)]
    requests = tuple(N.Hits((s,)) for s in (N.el("p", first_of_type=True), N.el(None, "a"), N.el("div", id="x"), N.el("a", has=("href",))))

    def read():
        return [c.to_pylist() for c in H._parsed(pa.array(pages), pa.nulls(len(pages), pa.string()), requests, ())]

    short = read()
    page = '<html><body><p class="a">x &amp; y</p><!-- c --><br></body></html>'
    assert H._NodeLists(H.Matcher(requests)).page(page) is None
    with monkeypatch.context() as m:
        m.setattr(H._NodeLists, "feed", lambda *_: pytest.fail("usual markup needs no standard parser"))
        assert H._NodeLists(H.Matcher(requests)).page(page) is None
    monkeypatch.setattr(H._NodeLists, "_usual", lambda self, source: 0)
    assert short == read()
