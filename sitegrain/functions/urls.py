"""URL expressions: split, join, normalise, resolve and scope. No UDF, no ``parse_url``.

``parse_url`` raises or yields null for links as they occur on real pages and keeps
``;params`` in the path, so the split is one regular expression (RFC 3986, appendix B,
with the scheme limited to its legal characters).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain.functions.text import let

URL_PATTERN = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Root-relative links as nearly all are written, nothing in them to resolve: their path (1) and query (2).
PLAIN_PATH = (
    r"^((?:/[A-Za-z0-9_~%,+@=!$&'()*\-][A-Za-z0-9_~%,+@=!$&'()*.\-]*)+)/*"
    r"(\?[^#\t\r\n]+)?\??(?:#[^\t\r\n]*)?\z"
)

# Web URLs as nearly all are written: one match gives their stem (1), path (2) and query (3).
# Anything odd (other schemes, capitals, params, control characters, blanks in front) takes the long way.
WEB_URL = (
    r"^(https?://[^/?#\x00-\x20]+((?:/[^?#;\t\r\n]*[^/?#;\t\r\n])?))/*"
    r"(\?[^#\t\r\n]+)?\??(?:#[^\t\r\n]*)?\z"
)

# Schemes whose URLs have an authority, resolve relatively, or carry ;params
# (the registry behind Python's urllib.parse).
AUTHORITY_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
    "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp",
    "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)
RELATIVE_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip",
    "sips", "mms", "sftp", "tel",
)
# A parsed scheme is lower-case letters, digits and "+.-", so one pattern tests a whole list.
_AUTHORITY, _RELATIVE, _PARAMS = (
    "^(?:" + "|".join(s.replace("+", "[+]") for s in names) + r")\z"
    for names in (AUTHORITY_SCHEMES, RELATIVE_SCHEMES, PARAM_SCHEMES)
)
_CONTROLS = "".join(chr(i) for i in range(0x21))


def _clean(u: Column) -> Column:
    """What every URL parser drops first: line breaks and tabs, leading controls and spaces."""
    for mark in "\t\r\n":
        u = F.replace(u, F.lit(mark), F.lit(""))
    return F.ltrim(u, F.lit(_CONTROLS))


def _parts(scheme: Column, netloc: Column, path: Column, query: Column, fragment: Column) -> Column:
    with_params = path.contains(";") & scheme.rlike(_PARAMS)
    params = F.regexp_extract(path, r";([^/]*)\z", 1)
    return F.struct(
        scheme.alias("scheme"),
        netloc.alias("netloc"),
        F.when(with_params, F.regexp_replace(path, r";[^/]*\z", "")).otherwise(path).alias("path"),
        F.when(with_params, params).otherwise("").alias("params"),
        query.alias("query"),
        fragment.alias("fragment"),
    )


def split_url(u: Column) -> Column:
    """``struct(scheme, netloc, path, params, query, fragment)``; absent parts are ``''``."""
    s = _clean(u)
    scheme, *rest = [F.regexp_extract(s, URL_PATTERN, i) for i in range(1, 6)]
    return _parts(F.lower(scheme), *rest)


def split_url_once(u: Column) -> Column:
    """``split_url`` for use in lambdas, where Spark does not share the five matches: one match, one split."""
    marked = F.regexp_replace(_clean(u), URL_PATTERN, "$1\x01$2\x01$3\x01$4\x01$5")

    def build(a: Column) -> Column:
        scheme, *rest = [F.get(a, F.lit(i)) for i in range(5)]
        return let(F.lower(scheme), lambda low: _parts(low, *rest))

    return let(F.split(marked, "\x01", -1), build)


def _marked(mark: str, part: Column) -> Column:
    return F.when(part != "", F.concat(F.lit(mark), part)).otherwise("")


def _unsplit(scheme: Column, netloc: Column, path: Column, *tail: Column) -> Column:
    """Join the parts; ``tail`` holds marked params, query or fragment."""
    rooted = path.startswith("/")
    no_authority = (
        F.when(path.startswith("//"), "//")
        .when((scheme != "") & scheme.rlike(_AUTHORITY) & ((path == "") | rooted), "//")
        .otherwise("")
    )
    slash = F.when((path == "") | rooted, "").otherwise("/")
    authority = F.when(netloc != "", F.concat(F.lit("//"), netloc, slash)).otherwise(no_authority)
    lead = F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise("")
    return F.concat(lead, authority, path, *tail)


def _bare(path: Column) -> Column:
    return F.regexp_replace(path, r"/+\z", "")


def _given(u: Column, value: Column) -> Column:
    """An absent or empty URL stays the empty string."""
    return F.when(F.coalesce(u, F.lit("")) == "", F.lit("")).otherwise(value)


def normalized(p: Column) -> Column:
    return _unsplit(p.scheme, p.netloc, _bare(p.path))


def media_normalized(p: Column) -> Column:
    return _unsplit(p.scheme, p.netloc, _bare(p.path), _marked("?", p["query"]))


# Most URLs are plain web URLs, which one match settles. The long way binds the split once and is
# evaluated only for the others; spelled out for generated code it would exceed a method's size.


def _quick(u: Column, short: str, long: Column) -> Column:
    """``short``, a replacement for a plain web URL, else the long way."""
    return F.when(u.rlike(WEB_URL), F.regexp_replace(u, WEB_URL, short)).otherwise(_given(u, long))


def normalize_url(u: Column) -> Column:
    """Scheme, authority and path without trailing slashes, params, query or fragment."""
    return _quick(u, "$1", let(split_url_once(u), normalized))


def normalize_media_url(u: Column) -> Column:
    """As ``normalize_url`` but the query names a different file, so it stays."""
    return _quick(u, "$1$3", let(split_url_once(u), media_normalized))


def canonical_page_url(u: Column, host: str) -> Column:
    """One name per page of the site: https, the main host and the bare path."""
    path = page_path(u)
    rooted = F.when((path != "") & ~path.startswith("/"), "/").otherwise("")
    return _given(u, F.concat(F.lit(f"https://{host}"), rooted, path))


def page_path(u: Column) -> Column:
    return F.when(u.rlike(WEB_URL), F.regexp_replace(u, WEB_URL, "$2")).otherwise(let(split_url_once(u), lambda p: _bare(p.path)))


def slug(u: Column) -> Column:
    last = F.substring_index(page_path(u), "/", -1)
    return F.when(last != "", last)


def netloc(u: Column) -> Column:
    return split_url(u).netloc


def _remove_dot_segments(path: Column) -> Column:
    def step(kept: Column, segment: Column) -> Column:
        shorter = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return (
            F.when(segment == "..", shorter)
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    kept = F.aggregate(F.split(path, "/", -1), F.array().cast("array<string>"), step)
    closed = F.when(path.rlike(r"(?:^|/)\.\.?\z"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(closed, "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def resolve_parts(base: Column, href: Column) -> Column:
    """The split form of ``href`` seen from an already split base URL (RFC 3986 section 5.2).

    Made for lambdas: every shared step is bound once.
    """

    def target(h: Column) -> Column:
        folder = F.regexp_replace(base.path, r"[^/]+\z", "")
        folder = F.when((folder == "") & (base.netloc != ""), "/").otherwise(folder)
        merged = F.when(h.path.startswith("/"), h.path).otherwise(
            F.regexp_replace(F.concat(folder, h.path), "/{2,}", "/")
        )
        return let(
            merged,
            lambda m: F.when(m.rlike(r"(?:^|/)\.\.?(?:/|\z)"), _remove_dot_segments(m)).otherwise(m),
        )

    def join(h: Column) -> Column:
        same_scheme = ((h.scheme == "") | (h.scheme == base.scheme)) & base.scheme.rlike(_RELATIVE)
        relative = same_scheme & (h.netloc == "")
        here = relative & (h.path == "") & (h.params == "")
        return F.struct(
            F.when(h.scheme == "", base.scheme).otherwise(h.scheme).alias("scheme"),
            F.when(relative, base.netloc).otherwise(h.netloc).alias("netloc"),
            F.when(here, base.path).when(relative, target(h)).otherwise(h.path).alias("path"),
            F.when(here, base.params).otherwise(h.params).alias("params"),
            F.when(here & (h["query"] == ""), base["query"]).otherwise(h["query"]).alias("query"),
            h.fragment.alias("fragment"),
            same_scheme.alias("joined"),
        )

    return let(split_url_once(href), join)


def resolve(base: Column, href: Column) -> Column:
    """The absolute form of ``href``; a link with a scheme of its own stays as written."""

    def whole(p: Column) -> Column:
        first = F.when((p.path == "") & (p.params != ""), "/").otherwise(p.path)
        tail = (_marked(";", p.params), _marked("?", p["query"]), _marked("#", p.fragment))
        return F.when(p.joined, let(first, lambda path: _unsplit(p.scheme, p.netloc, path, *tail))).otherwise(href)

    return _given(href, let(resolve_parts(base, href), whole))


def is_plain_path(base: Column, href: Column) -> Column:
    """On a web page, a root-relative link with nothing to resolve."""
    return (base.netloc != "") & base.scheme.isin("http", "https") & href.rlike(PLAIN_PATH)


def plain_path_url(base: Column, href: Column, kept: str = "$1") -> Column:
    """The absolute form of a link that ``is_plain_path``, with the parts ``kept`` of it."""
    return F.concat(base.scheme, F.lit("://"), base.netloc, F.regexp_replace(href, PLAIN_PATH, kept))


def _resolve_quick(base: Column, href: Column, plain: str, web: str, long: Callable[[Column], Column]) -> Column:
    """Root-relative links and web URLs as nearly all are written are settled by one match, only others taken apart."""
    return (
        F.when(is_plain_path(base, href), plain_path_url(base, href, plain))
        .when(href.rlike(WEB_URL), F.regexp_replace(href, WEB_URL, web))
        .otherwise(let(resolve_parts(base, href), long))
    )


def resolve_page_url(base: Column, href: Column) -> Column:
    """``href`` seen from an already split base URL, normalised."""
    return _resolve_quick(base, href, "$1", "$1", normalized)


def resolve_media_url(base: Column, href: Column) -> Column:
    """As ``resolve_page_url`` but the query stays."""
    return _resolve_quick(base, href, "$1$2", "$1$3", media_normalized)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base``; an empty href stays empty, an empty base changes nothing."""
    return F.when(base == "", F.coalesce(href, F.lit(""))).otherwise(
        let(split_url_once(base), lambda b: resolve(b, href))
    )


def is_internal(u: Column, hosts: Sequence[str]) -> Column:
    """The authority is one of the site's hosts or absent. Exact and case-sensitive."""
    return netloc(u).isin("", *hosts)


def below(path: Column, prefix: str) -> Column:
    return (path == prefix) | path.startswith(prefix + "/")


def in_scope(u: Column, prefixes: Sequence[str]) -> Column:
    """The path equals an allowed prefix or lies below one. The host is not looked at."""
    # Normalising twice matters for ``/x;p/``: the slash goes first, then the params.
    path = _bare(F.regexp_replace(page_path(u), r";[^/]*\z", ""))
    # One pattern, so that the path is computed once.
    return path.rlike("^(?:" + "|".join(rf"\Q{prefix}\E" for prefix in prefixes) + r")(?:/|\z)") if prefixes else F.lit(False)


def may_be_in_scope(u: Column, prefixes: Sequence[str]) -> Column:
    """Every URL in scope and perhaps others, told from the raw text: cheap enough to test page bodies with."""
    text = F.translate(u, "\t\r\n", "")
    hit = F.lit(False)
    for prefix in prefixes:
        if not any(prefix != other and other in prefix for other in prefixes):
            hit = hit | text.contains(prefix)
    return hit
