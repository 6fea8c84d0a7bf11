"""Pluggable extraction rules.

A rule names the elements it needs and what it reads from them: fields, media and links. A list of
rules is evaluated together, in one projection; later rules override the fields of earlier ones,
media and links of all rules are united. A rule is a native expression, or a Python function that
runs where the page is parsed and whose failure is a value: the page's other rules are not touched.
A native expression that may fail should use Spark's ``try_`` forms, which give null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain.functions import nodes as N
from sitegrain.functions.nodes import Page
from sitegrain.functions.text import let, strip
from sitegrain.operators.html import Call, Result, page_nodes

MEDIA_TYPE = "array<struct<media_type:string,url:string>>"
LINKS_TYPE = "array<string>"


def on_found(selected: Column, read: Callable[[Column], Column]) -> Column:
    """``read(selected)`` if anything was selected, else null. Selects once."""
    return let(selected, lambda s: F.when(F.size(s) > 0, read(s)))


@dataclass(frozen=True)
class Rule:
    """``read(page, url)`` gives one struct column with the rule's ``fields``.

    With ``media`` or ``links`` the struct also has fields of these names, of the types
    ``MEDIA_TYPE`` and ``LINKS_TYPE``. ``needs`` lists element patterns (or tuples of alternatives)
    that must all occur on the page, else the rule gives nothing. A rule that selects those elements
    anyway gives a null struct itself (see ``on_found``) and needs no guard. Fields named in
    ``structured`` are no texts: an empty list counts as a value, where a blank text does not.
    """

    name: str
    fields: tuple[str, ...]
    read: Callable[[Page, Column], Column]
    structured: frozenset[str] = frozenset()
    needs: tuple[N.Sel | tuple[N.Sel, ...], ...] = ()
    media: bool = False
    links: bool = False

    @property
    def column(self) -> str:
        return f"rule_{self.name}"

    def result(self, page: Page, url: Column) -> Column:
        """The rule's struct, null where it does not apply."""
        out = self.read(page, url)
        for need in self.needs:
            out = F.when(page.has(*(need if isinstance(need, tuple) else (need,))), out)
        return out

    def value(self, field: str) -> Column:
        """The field, from the rule's own column; null where the rule gives nothing."""
        value = F.col(self.column)[field]
        return value if field in self.structured else F.when(strip(value) != "", value)


@dataclass(frozen=True)
class PythonRule:
    """``read(url, *elements)`` returns a ``Result``; it gets the elements of each of ``needs``, none of them empty.

    ``fields`` gives the Spark type of each field; other data it returns is left out.
    """

    name: str
    fields: Mapping[str, str] = field(hash=False)
    needs: tuple[tuple[N.Sel, ...], ...] = ()
    read: Callable[..., Result] = None
    media: bool = True
    links: bool = True

    @property
    def column(self) -> str:
        return f"rule_{self.name}"

    @property
    def call(self) -> Call:
        return Call(self.name, self.needs, self.read)

    def result(self, page: Page, url: Column) -> Column:
        schema = ",".join(f"`{n}`:{t}" for n, t in self.fields.items())

        def read(mine: Column) -> Column:
            data = F.from_json(mine.data, F.lit(f"struct<{schema}>")) if self.fields else None
            return F.struct(
                *[data[n].alias(n) for n in self.fields], mine.media.alias("media"), mine.links.alias("links"), mine.error.alias("error")
            )

        mine = F.get(F.filter("user", lambda u: (u.rule == self.name) & u.applies), F.lit(0))
        return let(mine, lambda m: F.when(m.isNotNull(), read(m)))

    def value(self, field: str) -> Column:
        value = F.col(self.column)[field]
        return F.when(strip(value) != "", value) if self.fields[field] == "string" else value


AnyRule = Rule | PythonRule


def calls(rules: Sequence[AnyRule]) -> list[Call]:
    """What the parser has to run."""
    return [r.call for r in rules if isinstance(r, PythonRule)]


def rule_columns(rules: Sequence[AnyRule], page: Page, url: Column, on: Column | None = None) -> list[Column]:
    """One struct column per rule, so that the work of a rule is done once for all its fields."""
    out = []
    for rule in rules:
        value = rule.result(page, url)
        out.append((value if on is None else F.when(on, value)).alias(rule.column))
    return out


def merge_rules(rules: Sequence[AnyRule]) -> dict[str, Column]:
    """Over ``rule_columns``: one column per field, the value of the last rule that has one."""
    offers: dict[str, list[Column]] = {}
    for rule in rules:
        for name in rule.fields:
            offers.setdefault(name, []).append(rule.value(name))
    return {name: F.coalesce(*reversed(values)) for name, values in offers.items()}


def united(rules: Sequence[AnyRule], part: str, kind: str) -> Column:
    """Over ``rule_columns``: the media or links of all rules, in the order of rules."""
    none = F.array().cast(kind)
    listed = [F.coalesce(F.col(r.column)[part], none) for r in rules if getattr(r, part)]
    return F.concat(none, *listed)


def rule_failures(rules: Sequence[AnyRule]) -> Column:
    """Over ``rule_columns``: ``struct(rule, message)`` of each rule that failed on the page."""
    failed = [
        F.struct(F.lit(r.name).alias("rule"), F.col(r.column)["error"].alias("message")) for r in rules if isinstance(r, PythonRule)
    ]
    listed = F.array(*failed) if failed else F.array()
    return F.filter(listed.cast("array<struct<rule:string,message:string>>"), lambda f: f.message.isNotNull())


def extraction_report(pages: DataFrame, rules: Sequence[AnyRule]) -> DataFrame:
    """Per rule over unparsed pages: pages seen, pages with the rule's elements, pages with at least one value,
    media and links found, and pages on which it failed."""
    page, url = Page(), F.col("final_url")
    columns = rule_columns(rules, page, url)
    read = page_nodes(pages, page, calls(rules)).select(*columns)
    flags = []
    for rule in rules:
        any_value = F.lit(False)
        for name in rule.fields:
            any_value = any_value | rule.value(name).isNotNull()
        whole = F.col(rule.column)

        def count(part: str, rule=rule, whole=whole) -> Column:
            return F.coalesce(F.size(whole[part]), F.lit(0)).cast("long") if getattr(rule, part) else F.lit(0).cast("long")

        failed = whole["error"].isNotNull() if isinstance(rule, PythonRule) else F.lit(False)
        flags.append(
            F.struct(
                F.lit(rule.name).alias("rule"), whole.isNotNull().cast("long").alias("applies"), any_value.cast("long").alias("filled"),
                count("media").alias("media"), count("links").alias("links"), failed.cast("long").alias("failed"),
            )
        )
    rows = read.select(F.explode(F.array(*flags)).alias("r"))
    sums = [F.coalesce(F.sum(f"r.{n}"), F.lit(0)).alias(n) for n in ("applies", "filled", "media", "links", "failed")]
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(F.count("*").alias("pages"), *sums)
