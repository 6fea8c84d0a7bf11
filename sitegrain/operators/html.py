"""HTML pages to node arrays: the one step that needs Python, an Arrow-batched map.

While a page is parsed each new element is tested against the element patterns that ask for its
tag, id, class or attribute. What a pattern wants around or below an element is then settled over
the short lists of hits, by their intervals: a page costs in proportion to its size and its hits.
"""

from __future__ import annotations

import html
import json
import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import partial
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sitegrain.functions import nodes as N
from sitegrain.functions.nodes import COMMENT, FOUND_TYPE, NODE_TYPE, TEXT, TEXTS_TYPE, Hits, Nearest, Page, Sel, Spans

# Send the parser along with the task, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(N)

# Elements without content, and elements whose text is not page text.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
NOT_TEXT = frozenset(["script", "style", "template", "rt", "rp"])
ROWS_PER_BATCH, BYTES_PER_BATCH = 128, 1 << 24
# Markup as nearly all of it is written: text (1), end tags (2), start tags (3) with attributes (4) that are quoted or
# have no value, closed at once (5), references (6, 7) and a lone "&" (8), comments (9), the document type (10).
# The standard parser reads these the same way and takes over where anything else begins.
_BLANK, _ATTR = r"[ \t\n\r\f]", r"[a-zA-Z_][a-zA-Z0-9_:-]*+"
TOKEN = re.compile(
    r"([^<&]++)|</([a-zA-Z][a-zA-Z0-9._:-]*+)>"
    rf"|<([a-zA-Z][a-zA-Z0-9-]*+)((?:{_BLANK}++{_ATTR}(?:=\"[^\"]*+\"|='[^']*+')?+)*+){_BLANK}*+(/?)>"
    r"|&([a-zA-Z][a-zA-Z0-9]*+)(?:;|(?=[^a-zA-Z0-9.;-]))|&#([0-9]++|[xX][0-9a-fA-F]++);|(&)(?![a-zA-Z#])"
    r"|<!--((?:[^-]|-(?!-))*+)-->|<!([dD][oO][cC][tT][yY][pP][eE])[^>]*+>"
)
ATTRIBUTE = re.compile(rf"({_ATTR})(?:=\"([^\"]*+)\"|='([^']*+)')?+")
RAW_END = {tag: re.compile(rf"</\s*{tag}\s*>", re.I) for tag in HTMLParser.CDATA_CONTENT_ELEMENTS}
REMEMBERED, LONG = 4096, 200  # start tags a parser remembers, and characters of attributes from which it does not


# Selection


def _pattern(sel: Sel) -> Sel:
    """What of a selector can be told from the element alone."""
    return replace(sel, having=None, scope=None, previous=None)


class Matcher:
    """Answers the requests of a page's expressions.

    ``start`` a page, add the positions of its elements to ``hits`` of the patterns they are ``fitting``, in document
    order, then ask for ``answers``.
    """

    def __init__(self, requests: Sequence[Hits | Spans | Nearest]):
        self.patterns: list[Sel] = []
        # Selectors by number: their pattern, and the numbers of their scope, previous sibling and inner element.
        self.numbers: dict[Sel, int] = {}
        self.sels: list[tuple[int, int | None, int | None, int | None]] = []
        # The patterns to test on an element, under the rarest thing they ask for.
        self.by_tag: dict[str | None, list[int]] = {}
        self.by_id: dict[str, list[int]] = {}
        self.by_class: dict[str, list[int]] = {}
        self.by_attr: dict[str, list[int]] = {}
        self.requests = [(type(r), *[tuple(self._add(s) for s in group) for group in r.groups()]) for r in requests]
        self.start()

    def _add(self, sel: Sel | None) -> int | None:
        if sel is None or sel in self.numbers:
            return None if sel is None else self.numbers[sel]
        around = [self._add(other) for other in (sel.scope, sel.previous, sel.having)]
        pattern = _pattern(sel)
        if pattern not in self.patterns:
            self.patterns.append(pattern)
            if sel.id:
                kind, key = self.by_id, sel.id
            elif sel.classes:
                kind, key = self.by_class, sel.classes[0]
            elif sel.attrs:
                kind, key = self.by_attr, sel.attrs[0][0]
            else:
                kind, key = self.by_tag, sel.tag
            kind.setdefault(key, []).append(len(self.patterns) - 1)
        self.numbers[sel] = len(self.sels)
        self.sels.append((self.patterns.index(pattern), *around))
        return self.numbers[sel]

    def start(self) -> None:
        self.hits: list[list[int]] = [[] for _ in self.patterns]

    def fitting(self, tag: str, attrs: dict[str, str]) -> tuple[list[int], list[int]]:
        """The patterns an element fits, and those it fits if it is the first of its tag among its siblings."""
        candidates = {*self.by_tag.get(tag, ()), *self.by_tag.get(None, ())}
        if attrs:
            classes = attrs.get("class", "").split()
            candidates.update(self.by_id.get(attrs.get("id", ""), ()))
            for name in classes:
                candidates.update(self.by_class.get(name, ()))
            for name in attrs:
                candidates.update(self.by_attr.get(name, ()))
            candidates = {n for n in candidates if self._fits(self.patterns[n], tag, attrs, classes)}
        else:
            candidates = {n for n in candidates if self._fits(self.patterns[n], tag, attrs, [])}
        firsts = [n for n in candidates if self.patterns[n].first_of_type]
        return [n for n in candidates if not self.patterns[n].first_of_type], firsts

    @staticmethod
    def _fits(p: Sel, tag: str, attrs: dict[str, str], classes: list[str]) -> bool:
        if (p.tag and p.tag != tag) or (p.id and attrs.get("id") != p.id):
            return False
        if any(name not in classes for name in p.classes):
            return False
        for name, test, value in p.attrs:
            found = attrs.get(name)
            if found is None or (test == "=" and found != value) or (test == "*=" and value not in found):
                return False
        return True

    def answers(self, parent: list[int], end: list[int], prev_sib: list[int]) -> list[list[int]]:
        """A list of positions for each request, given the page's node columns."""
        known: dict[int, list[int]] = {}

        def alone(sel: int) -> list[int]:
            """The elements that fit without regard to what is around them."""
            pattern, _, previous, having = self.sels[sel]
            out = self.hits[pattern]
            if out and previous is not None:
                before = set(alone(previous))
                out = [i for i in out if prev_sib[i] in before]
            if out and having is not None:
                below = alone(having)
                out = [i for i in out if holds(below, i) is not None]
            return out

        def holds(items: list[int], block: int) -> int | None:
            """The number of the first item inside a block."""
            at = bisect_right(items, block)
            return at if at < len(items) and items[at] <= end[block] else None

        def one(sel: int) -> list[int]:
            if sel not in known:
                out, scope = alone(sel), self.sels[sel][1]
                if out and scope is not None:
                    blocks, at, reach, kept = one(scope), 0, -1, []
                    for i in out:
                        while at < len(blocks) and blocks[at] < i:
                            reach = max(reach, end[blocks[at]])
                            at += 1
                        if i <= reach:
                            kept.append(i)
                    out = kept
                known[sel] = out
            return known[sel]

        def union(sels: tuple[int, ...]) -> list[int]:
            return one(sels[0]) if len(sels) == 1 else sorted({i for s in sels for i in one(s)})

        out = []
        for kind, first, *rest in self.requests:
            of = union(first)
            if kind is Hits:
                out.append(of)
                continue
            items = union(rest[0])
            if kind is Spans:
                starts = [bisect_right(items, block) for block in of]
                out.append([n for block, at in zip(of, starts, strict=True) for n in (at, bisect_right(items, end[block]) - at)])
                continue
            near, numbers = {-1: 0}, []
            for i in of:
                at, way = parent[i], []
                while at not in near:
                    number = holds(items, at)
                    if number is not None:
                        near[at] = number
                    else:
                        way.append(at)
                        at = parent[at]
                near.update(dict.fromkeys(way, near[at]))
                numbers.append(near[at])
            out.append(numbers)
        return out


class _NodeLists(HTMLParser):
    """Appends the nodes of one page after another to flat column lists.

    A void element closes itself, an end tag closes up to the nearest open element of
    that name, an unmatched end tag is ignored and nothing is closed implicitly.
    """

    def __init__(self, matcher: Matcher) -> None:
        super().__init__(convert_charrefs=False)
        self.matcher = matcher
        self.parent: list[int] = []
        self.end: list[int] = []
        self.prev_sib: list[int] = []
        self.tag: list[str] = []
        self.text: list[str | None] = []
        self.attr_offsets: list[int] = [0]
        self.attr_names: list[str] = []
        self.attr_values: list[str] = []

        # Start tags as written, and what was read from them.
        self.known: dict[tuple[str, str], tuple] = {}

    def page(self, source: str | None) -> str | None:
        """Add one page. A page that cannot be read adds no nodes; returns its error."""
        start = len(self.tag)
        self.reset()
        self.matcher.start()
        self.start = start
        self.open: list[int] = []
        self.open_names: dict[str, int] = {}
        # Per open element (document first): last child element, and the tags of its children.
        self.last: list[int] = [-1]
        self.seen: list[set[str] | None] = [None]
        self.hidden = 0
        self.run: list[str] = []
        self.void_closed: list[str] = []
        try:
            source = source or ""
            at = self._usual(source)
            if at < len(source):
                self.feed(source[at:])
            self.close()
            self._flush()
            self._close_down_to(0)
            return None
        except Exception as e:  # a broken page must not fail the job
            self.matcher.start()
            for column in (self.parent, self.end, self.prev_sib, self.tag, self.text):
                del column[start:]
            del self.attr_offsets[start + 1:]
            del self.attr_names[self.attr_offsets[-1]:]
            del self.attr_values[self.attr_offsets[-1]:]
            return f"{type(e).__name__}: {e}"

    def _usual(self, source: str) -> int:
        """Read a page up to the first thing not written as usual; returns where that begins.

        Does what the methods below do, with ``_open`` and the usual case of ``_shut`` written out: nearly all the time
        of a page is spent here. An element that is closed at once need not be opened.
        """
        at, known, hits, start = 0, self.known, self.matcher.hits, self.start
        run, opened, names_open, last, seen = self.run, self.open, self.open_names, self.last, self.seen
        parents, ends, before, tags, texts = self.parent, self.end, self.prev_sib, self.tag, self.text
        all_names, all_values, offsets = self.attr_names, self.attr_values, self.attr_offsets
        while True:
            m = None
            for m in iter(TOKEN.scanner(source, at).match, None):
                kind = m.lastindex
                if kind == 1:
                    run.append(m[1])
                elif kind == 2:
                    tag = m[2].lower()
                    if tag in VOID:
                        self.handle_endtag(tag)
                        continue
                    if run:
                        self._flush()
                    if opened and tags[start + opened[-1]] == tag:
                        ends[start + opened.pop()] = len(tags) - start - 1
                        last.pop()
                        seen.pop()
                        names_open[tag] -= 1
                        if tag in NOT_TEXT:
                            self.hidden -= 1
                    else:
                        self._shut(tag)
                elif kind == 5:
                    name, raw, closed = m.group(3, 4, 5)
                    element = known.get((name, raw))
                    if element is None:
                        pairs = ATTRIBUTE.findall(raw) if raw else ()
                        attrs = {k.lower(): html.unescape(v or w) for k, v, w in pairs}
                        element = self._element(name.lower(), attrs)
                        if len(raw) < LONG:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[name, raw] = element
                    tag, names, values, fits, firsts = element
                    end = None
                    if tag in RAW_END and not closed:
                        end = RAW_END[tag].search(source, m.end())
                        if end is None:
                            return m.start()
                    if run:
                        self._flush()
                    idx = len(tags) - start
                    parents.append(opened[-1] if opened else -1)
                    ends.append(idx)
                    tags.append(tag)
                    texts.append(None)
                    before.append(last[-1])
                    last[-1] = idx
                    for number in fits:
                        hits[number].append(idx)
                    siblings = seen[-1]
                    if siblings is None:
                        siblings = seen[-1] = set()
                    if tag not in siblings:
                        siblings.add(tag)
                        for number in firsts:
                            hits[number].append(idx)
                    if names:
                        all_names += names
                        all_values += values
                    offsets.append(len(all_names))
                    if end is not None:  # what lies between is no page text
                        at = end.end()
                        break
                    if closed:
                        continue
                    if tag in VOID:
                        self.void_closed.append(tag)
                        continue
                    opened.append(idx)
                    names_open[tag] = names_open.get(tag, 0) + 1
                    last.append(-1)
                    seen.append(None)
                    if tag in NOT_TEXT:
                        self.hidden += 1
                elif kind == 6:
                    self.handle_entityref(m[6])
                elif kind == 7:
                    self.handle_charref(m[7])
                elif kind == 8:
                    run.append("&")
                elif kind == 9:
                    self.handle_comment(m[9])
                else:
                    self._flush()
            else:
                return at if m is None else m.end()

    def _element(self, tag: str, attrs: dict[str, str]) -> tuple:
        return (tag, list(attrs), list(attrs.values()), *self.matcher.fitting(tag, attrs))

    def _text(self, tag: str, text: str) -> None:
        self.parent.append(self.open[-1] if self.open else -1)
        self.end.append(len(self.tag) - self.start)
        self.tag.append(tag)
        self.text.append(text)
        self.prev_sib.append(-1)
        self.attr_offsets.append(len(self.attr_names))

    def _flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            self.run.clear()
            if text and not self.hidden:
                self._text(TEXT, text)

    def _close_down_to(self, depth: int) -> None:
        end = len(self.tag) - self.start - 1
        while len(self.open) > depth:
            idx = self.open.pop()
            self.last.pop()
            self.seen.pop()
            name = self.tag[self.start + idx]
            self.open_names[name] -= 1
            self.hidden -= name in NOT_TEXT
            self.end[self.start + idx] = end

    def _open(self, element: tuple) -> None:
        if self.run:
            self._flush()
        tag, names, values, fits, firsts = element
        idx = len(self.tag) - self.start
        self.parent.append(self.open[-1] if self.open else -1)
        self.end.append(idx)
        self.tag.append(tag)
        self.text.append(None)
        self.prev_sib.append(self.last[-1])
        self.last[-1] = idx
        hits = self.matcher.hits
        for number in fits:
            hits[number].append(idx)
        seen = self.seen[-1]
        if seen is None:
            seen = self.seen[-1] = set()
        if tag not in seen:
            seen.add(tag)
            for number in firsts:
                hits[number].append(idx)
        if names:
            self.attr_names += names
            self.attr_values += values
        self.attr_offsets.append(len(self.attr_names))
        self.open.append(idx)
        self.open_names[tag] = self.open_names.get(tag, 0) + 1
        self.last.append(-1)
        self.seen.append(None)
        if tag in NOT_TEXT:
            self.hidden += 1

    def _shut(self, tag: str) -> None:
        if self.run:
            self._flush()
        if self.open_names.get(tag):
            depth = len(self.open) - 1
            while self.tag[self.start + self.open[depth]] != tag:
                depth -= 1
            self._close_down_to(depth)

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_starttag(self, tag, attrs):
        self._open(self._element(tag, {k: v or "" for k, v in attrs}))
        if tag in VOID:
            self._shut(tag)
            self.void_closed.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._open(self._element(tag, {k: v or "" for k, v in attrs}))
        self._shut(tag)

    def handle_endtag(self, tag):
        if tag in VOID and tag in self.void_closed:  # ``<br></br>`` is one element
            self.void_closed.remove(tag)
        else:
            self._shut(tag)

    def handle_data(self, data):
        self.run.append(data)

    def handle_charref(self, name):
        self.run.append(html.unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.run.append(html5.get(f"{name};", f"&{name}"))

    def handle_comment(self, data):
        self._flush()
        text = " ".join(data.split())
        if text:
            self._text(COMMENT, text)

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self.run.append(data[6:])
            self._flush()


    def text_of(self, i: int) -> str:
        """The text runs below an element of the page added last, joined by one space."""
        at, end = self.start + i, self.start + self.end[self.start + i] + 1
        return " ".join([text for tag, text in zip(self.tag[at:end], self.text[at:end], strict=True) if tag == TEXT])

    def answers(self) -> list[list[int]]:
        """The matcher's answers for the page added last."""
        return self.matcher.answers(self.parent[self.start:], self.end[self.start:], self.prev_sib[self.start:])


# Rules in Python


@dataclass(frozen=True)
class Element:
    """An element as a rule in Python sees it; ``text`` are the text runs below it, joined by one space."""

    tag: str
    attrs: dict[str, str]
    text: str


@dataclass(frozen=True)
class Result:
    """What a rule in Python may return: data by field, media as (type, url), links."""

    data: dict = None
    media: Sequence[tuple[str, str]] = ()
    links: Sequence[str] = ()


@dataclass(frozen=True)
class Call:
    """A rule in Python: ``read(url, *elements)`` gets a list of elements for each of ``needs`` if none is empty."""

    name: str
    needs: tuple[tuple[Sel, ...], ...]
    read: Callable[..., Result]


USER_TYPE = "array<struct<rule:string,applies:boolean,data:string,media:array<struct<media_type:string,url:string>>,links:array<string>,error:string>>"


def _run(call: Call, places: list[int], lists: _NodeLists, answers: list[list[int]], url: str | None) -> dict:
    """One rule on one page. Whatever it raises becomes its error."""
    out = {"rule": call.name, "applies": False, "data": None, "media": None, "links": None, "error": None}
    try:
        if not all(answers[at] for at in places):
            return out
        out["applies"] = True
        base = lists.start

        def element(i: int) -> Element:
            a, z = lists.attr_offsets[base + i:base + i + 2]
            return Element(lists.tag[base + i], dict(zip(lists.attr_names[a:z], lists.attr_values[a:z], strict=True)), lists.text_of(i))

        got = call.read(url, *[[element(i) for i in answers[at]] for at in places])
        out["data"] = json.dumps(got.data or {})
        out["media"] = [{"media_type": str(kind), "url": str(to)} for kind, to in got.media]
        out["links"] = [str(to) for to in got.links]
    except Exception as e:  # a rule that fails must not take the others along
        out |= {"data": None, "media": None, "links": None, "error": f"{type(e).__name__}: {e}"}
    return out


# Batches


def _parsed(pages: pa.Array, urls: pa.Array, requests: tuple, calls: tuple[Call, ...], read: tuple[Hits, ...] = ()) -> list[pa.Array]:
    matcher = Matcher(requests)
    places = [[requests.index(Hits(need)) for need in call.needs] for call in calls]
    reads = [requests.index(hits) for hits in read]
    lists = _NodeLists(matcher)
    errors, offsets, idx, found, texts, users = [], [0], [], [], [], []
    for page, url in zip(pages, urls, strict=True):
        errors.append(lists.page(page.as_py()))
        size = len(lists.tag) - offsets[-1]
        idx.extend(range(size))
        offsets.append(len(lists.tag))
        answers = lists.answers()
        found.append(answers)
        texts.append([[lists.text_of(i) or None for i in answers[at]] for at in reads])
        users.append([_run(call, at, lists, answers, url.as_py()) for call, at in zip(calls, places, strict=True)])
    strings, starts = pa.string(), pa.array(lists.attr_offsets, pa.int32())
    fields = {
        "idx": pa.array(idx, pa.int32()),
        "parent": pa.array(lists.parent, pa.int32()),
        "end": pa.array(lists.end, pa.int32()),
        "tag": pa.array(lists.tag, strings),
        "attrs": pa.MapArray.from_arrays(
            starts,
            pa.array(lists.attr_names, strings),
            pa.array(lists.attr_values, strings),
            mask=pc.equal(starts[1:], starts[:-1]),  # most nodes have none, and an empty map costs Spark more than a null
        ),
        "text": pa.array(lists.text, strings),
    }
    structs = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
    nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)
    user = pa.list_(pa.struct([
        ("rule", strings), ("applies", pa.bool_()), ("data", strings),
        ("media", pa.list_(pa.struct([("media_type", strings), ("url", strings)]))), ("links", pa.list_(strings)), ("error", strings),
    ]))
    out = [nodes, pa.array(found, pa.list_(pa.list_(pa.int32()))), pa.array(users, user), pa.array(errors, strings)]
    return [*out, pa.array(texts, pa.list_(pa.list_(strings)))] if read else out


def _cuts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of limited number and bytes; a larger page comes alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= ROWS_PER_BATCH or held + size > BYTES_PER_BATCH):
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _parse(
    batches: Iterator[pa.RecordBatch], requests: tuple, calls: tuple[Call, ...], read: tuple[Hits, ...], kept: list[str], added: list[str]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("html")), 0).to_pylist()
        for start, stop in _cuts(sizes):
            part = batch.slice(start, stop - start)
            urls = part.column("final_url") if "final_url" in part.schema.names else pa.nulls(part.num_rows, pa.string())
            columns = _parsed(part.column("html"), urls, requests, calls, read)
            yield pa.RecordBatch.from_arrays([part.column(n) for n in kept] + columns, names=[*kept, *added])


def page_nodes(pages: DataFrame, page: Page | None = None, calls: Sequence[Call] = ()) -> DataFrame:
    """Replace ``html`` by ``nodes`` (document order), ``found``, ``user``, ``parse_error`` and, if any are asked for, ``texts``.

    ``found`` and ``texts`` answer the requests made to ``page`` so far, so build the expressions first. ``user``
    holds what each of ``calls`` gave or how it failed. Column pruning does not reach through a
    Python step: select only the columns later steps need before calling this.
    """
    page = page or Page()
    for call in calls:
        for need in call.needs:
            page.ask(Hits(need))
    kept = [f for f in pages.schema.fields if f.name != "html"]
    added = {"nodes": NODE_TYPE, "found": FOUND_TYPE, "user": USER_TYPE, "parse_error": "string"}
    if page.read:
        added["texts"] = TEXTS_TYPE
    schema = T.StructType(kept + [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in added.items()])
    parse = partial(
        _parse, requests=tuple(page.requests), calls=tuple(calls), read=tuple(page.read), kept=[f.name for f in kept], added=list(added)
    )
    return pages.mapInArrow(parse, schema)
