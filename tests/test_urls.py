from urllib.parse import urljoin, urlparse, urlunparse

from pyspark.sql import functions as F

from sitegrain.functions import urls as U

BASES = ["https://www.example.com/en/a/b.html?x=1", "https://www.example.com", "http://h/a/", "http://h/a/b;p?q#f", "https://h//x//y", ""]
HREFS = [
    "", "/", "/x", "//o/x", "x", "../x", "../../../x", "./", "..", ".", "?q=1", "#f", "a//b/", "/a/../b/./c/", "HTTP://A.com/X?",
    "mailto:a@b;c", "tel:1", "javascript:void(0)", "http:foo", "https:foo/bar", " /pad", "a;b/c;d", "/x/;p", "x;y?z", "ftp://f/a",
    "data:image/png;base64,AA=", "a_b:c", "/x;p/", "x/..", "//", "///x", "?", "#", "a\nb", ";p", "http:///x", "https://h", "https://h/?",
    "https://h/a/b///?x=1#y", "https://h/a;p/b;q/", "https://h/a?#", "http://h?x", "https://h/é b/c%20", "HTTPS://www.A.com:80//x//",
]


def _strip(u, query=False):
    if not u:
        return ""
    p = urlparse(u)
    return urlunparse((p.scheme, p.netloc, p.path.rstrip("/"), "", p.query if query else "", ""))


def _canon(u):
    return urlunparse(("https", "www.example.com", urlparse(u).path.rstrip("/"), "", "", "")) if u else ""


def test_url_functions_agree_with_the_standard_library(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    h = F.col("h")
    out = spark.createDataFrame(rows, "b string, h string").select(
        "b", "h", U.absolute_url(F.col("b"), h).alias("target"), U.normalize_url(h).alias("key"), U.normalize_media_url(h).alias("media"),
        U.canonical_page_url(h, "www.example.com").alias("canon"), U.page_path(h).alias("path"), U.netloc(h).alias("host"), U.slug(h).alias("slug"),
    )
    for r in out.collect():
        path = urlparse(r.h).path.rstrip("/")
        expected = (
            urljoin(r.b, r.h) if r.h else "", _strip(r.h), _strip(r.h, True), _canon(r.h), path,
            urlparse(r.h).netloc, path.split("/")[-1] or None,
        )
        assert (r.target, r.key, r.media, r.canon, r.path, r.host, r.slug) == expected, (r.b, r.h)


def test_scope_and_hosts(spark):
    rows = ["/en", "/en/", "/en/x", "/enx", "/fr", "https://other.org/en/x", "https://www.example.com/EN", "/en;p/", ""]
    df = spark.createDataFrame([(u,) for u in rows], "u string")
    got = df.select(U.in_scope(F.col("u"), ("/en", "/en/maison")).alias("s"), U.is_internal(F.col("u"), ("www.example.com",)).alias("i")).collect()
    assert [r.s for r in got] == [True, True, True, False, False, True, False, True, False]
    assert [r.i for r in got] == [True, True, True, True, True, False, True, True, True]
