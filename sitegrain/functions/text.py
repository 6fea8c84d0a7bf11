"""String, number and emptiness expressions. All are native Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters str.split()/str.strip() treat as blank: the Unicode set plus four separators.
BLANK = r"[\s\x1c-\x1f]"
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
NUMBER = r"[0-9]+(?:[.,][0-9]+)?"
# The spellings of "no single year" on a label.
NON_VINTAGE = ("non-vintage", "non vintage")
NON_VINTAGE_SHORT = "nv"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A plain column reference is not enough: the optimizer may inline a column that
    is used once, and inside a lambda "once" means once per array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def collapse(c: Column) -> Column:
    """Trim and reduce every run of blanks to one space."""
    return F.trim(F.regexp_replace(c, rf"(?U){BLANK}+", " "))


def keep_if(c: Column, test: Callable[[Column], Column]) -> Column:
    """``c`` where the test holds, else null. Evaluates ``c`` once."""
    return F.get(F.filter(F.array(c), test), F.lit(0))


def empty_to_null(c: Column) -> Column:
    return keep_if(c, lambda v: v != "")


def name_key(c: Column) -> Column:
    """The case- and padding-insensitive form of an entity name."""
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def unquote(c: Column) -> Column:
    """Drop outer straight quotes, then outer curly quotes, then outer blanks."""
    straight = F.regexp_replace(strip(c), r'^"+|"+\z', "")
    return strip(F.regexp_replace(straight, r"^[“”]+|[“”]+\z", ""))


def capitalize_words(c: Column) -> Column:
    return F.initcap(collapse(c))


def first_number(c: Column) -> Column:
    """The first integer or decimal in a text; a decimal comma counts as a point."""
    # A cast that fails costs far more than the search, so nothing empty comes to it.
    found = empty_to_null(F.regexp_extract(c, f"({NUMBER})", 1))
    return F.replace(found, F.lit(","), F.lit(".")).try_cast("double")


def first_year(c: Column) -> Column:
    return F.regexp_extract(c, "([0-9]{4})", 1).try_cast("int")


def vintage_year(c: Column) -> Column:
    """The year on a label; null where the label says the wine has none."""
    low = F.lower(c)
    none = strip(low) == NON_VINTAGE_SHORT
    for spelling in NON_VINTAGE:
        none = none | low.contains(spelling)
    return F.when(~none, first_year(c))


def number_range(c: Column) -> Column:
    """``struct(low, high)`` of the first two numbers; one number stands for both."""

    def pair(found: Column) -> Column:
        low = F.get(found, F.lit(0))
        return F.struct(low.alias("low"), F.coalesce(F.get(found, F.lit(1)), low).alias("high"))

    texts = F.regexp_extract_all(c, F.lit(f"({NUMBER})"), F.lit(1))
    return let(F.transform(texts, lambda t: F.regexp_replace(t, ",", ".").try_cast("double")), pair)


def after_dash(c: Column) -> Column:
    """The part after the first dash, or the whole text when there is no dash."""
    return F.when(F.instr(c, "-") > 0, strip(F.regexp_replace(c, r"(?s)^[^-]*-", ""))).otherwise(c)


def is_empty(c: Column, kind: T.DataType | None = None) -> Column:
    """Null, the empty string, the empty list or the empty map. Zero is a value."""
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return c.isNull() | (F.size(c) == 0)
    if kind is None or isinstance(kind, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def filled(c: Column, kind: T.DataType | None = None) -> Column:
    return ~is_empty(c, kind)
