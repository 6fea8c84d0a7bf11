"""What keeps rule_report cheap on each page gives the same as the long way."""

import random

from pyspark.sql import functions as F

from checks import rendered as R
from checks.queries import QUERIES
from sitegrain.functions import nodes as N
from sitegrain.functions import urls as U
from sitegrain.functions.text import first_number, let
from sitegrain.operators.html import page_nodes
from sitegrain.operators.links import page_links
from sitegrain.operators.media import best_srcset
from sitegrain.rules import SiteRules

PIECES = [
    "<p>", "</p>", "<p class='y'>", "<div id='a'>", "</div>", "<br>", "</br>", "<br/>", "<b/>", "x", " y ", "&amp;", "&nbsp;", "<!-- c -->", "<script>v</script>",
    "<style/>", "<script/>", "<template>", "</template>", "<img src=a>", "<", "</i>", "<h6>", "</h6>", "<video><source src='s'></video>", "\n", "<textarea>t</textarea>",
]


def test_the_plan_of_the_report_gathers_no_texts(spark):
    plan = QUERIES["rule_report"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "rule_page_links" in plan
    assert N.TEXT not in plan and "array_sort" not in plan


def test_texts_read_by_the_parser(spark):
    rng = random.Random(7)
    pages = [(i, "".join(rng.choices(PIECES, k=rng.randrange(40)))) for i in range(300)] + [(300, None), (301, "")]
    page = N.Page()
    some = [(N.el("p"),), (N.el("p").inside(N.el("div", id="a")), N.el("h6")), (N.el("br"),), (N.el("p"),), (N.el(None, "y"),)]
    pairs = [F.struct(page.texts(*s).alias("read"), N.texts(page.nodes, page.select(*s)).alias("gathered")) for s in some]
    df = spark.createDataFrame(pages, "page_id long, html string")
    rows = page_nodes(df, page).select(F.array(*pairs).alias("both")).collect()
    assert len(rows) == len(pages) and any(b.read for r in rows for b in r.both)
    assert all(b.read == b.gathered for r in rows for b in r.both)


def test_usual_urls_resolve_as_when_taken_apart(spark):
    rng = random.Random(3)
    parts = ["/", "//", "a", "b.html", ".", "..", "/en", "?", "q=1", "#", "f", ";p", " ", "\t", "\n", "é", "%20", "http:", "https://", "HTTP://", "h.org", "mailto:x", "'", "$"]
    hrefs = ["/a", "/a/", "/a//?x#y", "/a?", "/a??x", "/a#b?c", "/a?x\ty", "/a?x#\n", "/a;p?x", "/.a/b", "/a/../b", "/a//b", "https://h.org/x/?y#z", "https://h.org?x", "http://h.org/a/../b"]
    hrefs += ["".join(rng.choices(parts, k=rng.randrange(1, 7))) for _ in range(1500)]
    bases = ["https://www.example.com/en/x/y", "http://h.org", "ftp://h.org/z", "//h.org/z", "/rel/path", "", None]
    rows = spark.createDataFrame([(b, h) for b in bases for h in (hrefs if b else hrefs[:200])], "base string, href string")

    def both(quick, long):
        def pair(b):
            return F.struct(quick(b, F.col("href")).alias("quick"), let(U.resolve_parts(b, F.col("href")), long).alias("long"))
        return let(U.split_url_once(F.col("base")), pair)

    got = rows.select("base", "href", both(U.resolve_page_url, U.normalized).alias("p"), both(U.resolve_media_url, U.media_normalized).alias("m")).collect()
    assert [(r.base, r.href, r.p, r.m) for r in got if r.p.quick != r.p.long or r.m.quick != r.m.long] == []


def test_links_with_queries_and_of_other_hosts(spark):
    html = '<a href="/a/?x=1">1</a><a href="/a">1</a><a href="https://example.com/b/#c">2</a><a href="https://elsewhere.org/example.com?q">3</a><a href="//o.org/z">4</a>'
    df = spark.createDataFrame([(1, "https://www.example.com/en/p", html)], "page_id long, final_url string, html string")
    for strict, own in ((False, ["https://elsewhere.org/example.com", "https://o.org/z"]), (True, [])):
        page = N.Page()
        links = page_links(page, F.col("final_url"), SiteRules(strict_hosts=strict)).alias("links")
        assert page_nodes(df, page).select(links).first().links == ["https://www.example.com/a", "https://example.com/b", *own]


def test_srcset_and_numbers(spark):
    cases = {
        "/a.jpg": "/a.jpg", "": None, " ": None, ",": None, "/a 320w, /b 640w": "/b", "/a 320W,/b\x1f+640W x": "/b", "/a 2x, /b 3x": "/a",
        "/a 1.5w, /b 5ww, /c -3w": "/a", "/a, , /b 1w": "/b", "\xa0/a\xa0": "/a", "/a 99999999999999999999w,/b 1w": "/b", None: None,
    }
    rows = spark.createDataFrame([(s,) for s in cases], "s string").select("s", best_srcset(F.col("s")).alias("best")).collect()
    assert {r.s: r.best for r in rows} == cases
    numbers = {"": None, "no": None, "a 3,5 g": 3.5, "12": 12.0, "1.5.2": 1.5, None: None}
    rows = spark.createDataFrame([(s,) for s in numbers], "s string").select("s", first_number(F.col("s")).alias("n")).collect()
    assert {r.s: r.n for r in rows} == numbers
