"""Element selection and text over a parsed page.

``nodes`` lists a page in document order; the array position of a node is its ``idx`` and its
subtree is the slice ``idx..end``. Which nodes a selector finds, what lies inside what and what is
nearest is looked up by the parser in its one pass over the page (see ``operators.html``): a
``Page`` collects these requests while expressions are built, and the column ``found`` holds an
array of positions for each, ``texts`` an array of texts where these are asked for. No expression
searches the nodes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain.functions.text import empty_to_null, let, strip

NODE_TYPE = "array<struct<idx:int,parent:int,end:int,tag:string,attrs:map<string,string>,text:string>>"
FOUND_TYPE = "array<array<int>>"
TEXTS_TYPE = "array<array<string>>"
TEXT = "#text"
COMMENT = "#comment"


@dataclass(frozen=True)
class Sel:
    """One element pattern. ``attrs`` holds ``(name, test, value)`` with test ``has``, ``=`` or ``*=``."""

    tag: str | None = None
    id: str | None = None
    classes: tuple[str, ...] = ()
    attrs: tuple[tuple[str, str, str], ...] = ()
    first_of_type: bool = False
    having: Sel | None = None
    scope: Sel | None = None
    previous: Sel | None = None

    def inside(self, scope: Sel) -> Sel:
        """Only elements below an element matching ``scope``."""
        return replace(self, scope=scope)

    def after(self, previous: Sel) -> Sel:
        """Only elements whose preceding sibling element matches ``previous``."""
        return replace(self, previous=previous)


def el(tag: str | None = None, *classes: str, id: str | None = None, has: tuple[str, ...] = (),
       equal: dict[str, str] | None = None, contain: dict[str, str] | None = None,
       first_of_type: bool = False, having: Sel | None = None) -> Sel:
    tests = [(name, "has", "") for name in has]
    tests += [(name, "=", value) for name, value in (equal or {}).items()]
    tests += [(name, "*=", value) for name, value in (contain or {}).items()]
    return Sel(tag, id, tuple(classes), tuple(tests), first_of_type, having)


def raw_attr(node: Column, name: str) -> Column:
    return F.try_element_at(node.attrs, F.lit(name))


def attr(node: Column, name: str) -> Column:
    """The trimmed attribute, or ``''``."""
    return strip(F.coalesce(raw_attr(node, name), F.lit("")))


def subtree(nodes: Column, node: Column) -> Column:
    """The node and everything below it."""
    return F.slice(nodes, node.idx + 1, node.end - node.idx + 1)


def within(node: Column, root: Column) -> Column:
    """The node is a proper descendant of ``root``."""
    return (root.idx < node.idx) & (node.idx <= root.end)


Alternatives = tuple[Sel, ...]


@dataclass(frozen=True)
class Hits:
    """The positions of the elements matching any alternative, in document order."""

    of: Alternatives

    def groups(self) -> tuple[Alternatives, ...]:
        return (self.of,)


@dataclass(frozen=True)
class Spans:
    """For each block in turn: how many items come before the first one inside it, and how many lie inside."""

    blocks: Alternatives
    items: Alternatives

    def groups(self) -> tuple[Alternatives, ...]:
        return self.blocks, self.items


@dataclass(frozen=True)
class Nearest:
    """For each element the number of the first item in the smallest element around it that holds one, else 0."""

    of: Alternatives
    items: Alternatives

    def groups(self) -> tuple[Alternatives, ...]:
        return self.of, self.items


@dataclass
class Page:
    """The columns of a parsed page, and the requests that its expressions make to the parser.

    Build expressions first, then parse with ``page_nodes(pages, page)``.
    """

    nodes: Column = field(default_factory=lambda: F.col("nodes"))
    found: Column = field(default_factory=lambda: F.col("found"))
    listed: Column = field(default_factory=lambda: F.col("texts"))
    requests: dict[Hits | Spans | Nearest, int] = field(default_factory=dict)
    read: dict[Hits, int] = field(default_factory=dict)

    def ask(self, request: Hits | Spans | Nearest) -> Column:
        """The positions that answer a request."""
        return F.get(self.found, F.lit(self.requests.setdefault(request, len(self.requests))))

    def select(self, *alternatives: Sel) -> Column:
        """The elements matching any alternative, in document order."""
        return F.transform(self.ask(Hits(alternatives)), lambda i: F.get(self.nodes, i))

    def select_one(self, *alternatives: Sel) -> Column:
        return F.get(self.nodes, F.get(self.ask(Hits(alternatives)), F.lit(0)))

    def texts(self, *alternatives: Sel) -> Column:
        """``node_text`` of each element that ``select`` gives, read by the parser; blank ones are nulls, so positions hold."""
        hits = Hits(alternatives)
        self.ask(hits)
        return F.get(self.listed, F.lit(self.read.setdefault(hits, len(self.read))))

    def has(self, *alternatives: Sel) -> Column:
        """At least one element matches."""
        return F.size(self.ask(Hits(alternatives))) > 0

    def inside(self, blocks: Alternatives, items: Alternatives, of_items: Column) -> Column:
        """For each block the part of ``of_items``, an array in step with the items, that lies inside it."""
        def cut(both: Column) -> Column:
            starts = F.filter(both.spans, lambda x, i: i % 2 == 0)
            return F.transform(starts, lambda at, n: F.slice(both["items"], at + 1, F.get(both.spans, 2 * n + 1)))

        return let(F.struct(self.ask(Spans(blocks, items)).alias("spans"), of_items.alias("items")), cut)


def node_text(nodes: Column, node: Column) -> Column:
    """All text runs below a node, joined by one space; null when there are none."""
    runs = F.filter(subtree(nodes, node), lambda x: x.tag == TEXT)
    return empty_to_null(F.array_join(F.transform(runs, lambda x: x.text), " "))


def texts(nodes: Column, selected: Column) -> Column:
    """``node_text`` of each selected node; blank ones stay as nulls so positions hold."""
    return F.transform(selected, lambda n: node_text(nodes, n))


def last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def pairs(values: Column) -> Column:
    """Values (0,1), (2,3), … as ``struct(k, v)``; an odd last value is dropped."""

    def build(vs: Column) -> Column:
        keys = F.filter(vs, lambda v, i: (i % 2 == 0) & (i + 1 < F.size(vs)))
        return F.transform(keys, lambda k, i: F.struct(k.alias("k"), F.get(vs, i * 2 + 1).alias("v")))

    return let(values, build)


def key_values(paired: Column) -> Column:
    """Complete pairs with folded keys; a repeated key keeps its first place and last value."""

    def build(s: Column) -> Column:
        # Sorted by key and place: the first of a run has the place, the last one the value.
        firsts = F.filter(s, lambda x, i: (i == 0) | (x.k != F.get(s, i - 1).k))
        lasts = F.filter(s, lambda x, i: (i + 1 == F.size(s)) | (x.k != F.get(s, i + 1).k))
        kept = F.zip_with(firsts, lasts, lambda a, z: F.struct(a.place.alias("place"), a.k.alias("k"), z.v.alias("v")))
        return F.transform(F.sort_array(kept), lambda x: F.struct(x.k.alias("k"), x.v.alias("v")))

    complete = F.filter(paired, lambda p: p.k.isNotNull() & p.v.isNotNull())
    keyed = F.transform(complete, lambda p, i: F.struct(F.lower(p.k).alias("k"), i.alias("place"), p.v.alias("v")))
    return let(F.sort_array(keyed), build)


def find_by_patterns(kv: Column, *patterns: str) -> Column:
    """The value of the first key that contains any of the patterns."""

    def hit(p: Column) -> Column:
        out = F.lit(False)
        for pattern in patterns:
            out = out | p.k.contains(pattern)
        return out

    return F.get(F.filter(kv, hit), F.lit(0)).v


def titled_pairs(values: Column, title: str, content: str) -> Column:
    """Pairs that have a first half, as ``struct(title, content)``; the second may be ``''``."""
    kept = F.filter(pairs(values), lambda p: p.k.isNotNull())
    return F.transform(
        kept, lambda p: F.struct(p.k.alias(title), F.coalesce(p.v, F.lit("")).alias(content))
    )


def first_per_key(items: Column, key: Callable[[Column], Column]) -> Column:
    """Keep the first item of each key, order kept. Sorts, never compares all pairs."""

    def build(s: Column) -> Column:
        firsts = F.filter(s, lambda x, i: (i == 0) | ~x.key.eqNullSafe(F.get(s, i - 1).key))
        kept = F.sort_array(F.transform(firsts, lambda x: F.struct(x.place.alias("place"), x["item"].alias("item"))))
        return F.transform(kept, lambda x: x["item"])

    keyed = F.transform(items, lambda x, i: F.struct(key(x).alias("key"), i.alias("place"), x.alias("item")))
    return let(F.sort_array(keyed), build)
