"""House pages: description, history and family."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain import rules as R
from sitegrain.functions import nodes as N
from sitegrain.functions.nodes import Page
from sitegrain.functions.text import after_dash, capitalize_words, empty_to_null, let, unquote
from sitegrain.operators.registry import Rule, on_found

SKIPPED_CHILDREN = ("b", "br")


def _filled(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def _paragraphs(page: Page, blocks: tuple[N.Sel, ...], glue: str) -> Column:
    """For each block its unquoted paragraphs, or its whole text when it has none."""
    inner = (N.el("p"),)

    def text(block: Column, ps: Column) -> Column:
        parts = _filled(F.transform(ps, lambda p: unquote(N.node_text(page.nodes, p))))
        joined = F.when(F.size(ps) > 0, F.array_join(parts, glue)).otherwise(unquote(N.node_text(page.nodes, block)))
        return empty_to_null(joined)

    return F.zip_with(page.select(*blocks), page.inside(blocks, inner, page.select(*inner)), text)


def house_description(page: Page, url: Column) -> Column:
    """The direct parts of the first story paragraph, without its bold lead-in."""
    nodes = page.nodes

    def child_text(child: Column) -> Column:
        return unquote(F.when(child.tag.startswith("#"), child.text).otherwise(N.node_text(nodes, child)))

    def build(parent: Column) -> Column:
        children = F.filter(
            N.subtree(nodes, parent), lambda n: (n.parent == parent.idx) & ~n.tag.isin(*SKIPPED_CHILDREN)
        )
        joined = F.array_join(_filled(F.transform(children, child_text)), " ")
        return F.coalesce(empty_to_null(joined), N.node_text(nodes, parent))

    stories = page.select(R.STORY)
    return on_found(stories, lambda s: F.struct(let(F.get(s, F.lit(0)), build).alias("description")))


def history_timeline(page: Page, url: Column) -> Column:
    """Title and text of each milestone.

    The text is the first one in the smallest block around the title that holds a text at
    all, so a milestone without its own text takes the first of the larger block.
    """
    titles, texts = (R.TIMELINE_TITLE,), (R.TIMELINE_TEXT,)

    def milestone(title: Column, text: Column) -> Column:
        return let(
            unquote(N.node_text(page.nodes, title)),
            lambda label: F.struct(label.alias("year"), F.coalesce(text, after_dash(label)).alias("event")),
        )

    def build(events: Column) -> Column:
        rows = F.zip_with(
            page.select(*titles), page.ask(N.Nearest(titles, texts)), lambda t, n: milestone(t, F.get(events, n))
        )
        return F.struct(F.filter(rows, lambda m: m.year != "").alias("history_timeline"))

    both = page.has(*titles) & page.has(*texts)
    return F.when(both, let(_paragraphs(page, texts, " "), build))


def family_spirit(page: Page, url: Column) -> Column:
    """Names and texts paired by position; the shorter list ends it, a repeated name keeps its last text."""

    def entry(name: Column, text: Column) -> Column:
        return F.struct(
            capitalize_words(unquote(N.node_text(page.nodes, name))).alias("name"), F.coalesce(text, F.lit("")).alias("text")
        )

    def build(blocks: Column) -> Column:
        names = page.select(R.FAMILY_NAME)
        both = F.slice(names, F.lit(1), F.least(F.size(names), F.size(blocks)))
        named = F.filter(
            F.transform(both, lambda n, i: entry(n, F.get(blocks, i))), lambda e: e["name"].isNotNull() & (e["name"] != "")
        )
        return F.struct(let(F.reverse(named), lambda es: F.map_from_entries(N.first_per_key(es, lambda e: e["name"]))).alias("family_spirit"))

    found = page.has(R.FAMILY_NAME) & page.has(R.FAMILY_TEXT)
    return F.when(found, let(_paragraphs(page, (R.FAMILY_TEXT,), "\n"), build))


WINERY_RULES = (
    Rule("winery_description", ("description",), house_description),
    Rule("history_timeline", ("history_timeline",), history_timeline, frozenset(["history_timeline"])),
    Rule("family_spirit", ("family_spirit",), family_spirit, frozenset(["family_spirit"])),
)
