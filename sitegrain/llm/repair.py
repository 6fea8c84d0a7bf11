"""Repair of damaged conversations by generalised LR parsing with weighted edits.

The role grammar, a conversation is empty or an optional system turn and pairs of a user and an
assistant turn, is compiled to SLR tables. A graph-structured stack is kept of all parses that edits
can lead to: its nodes are cells of a state and the cell below, shared by the stacks that grew from
them. At each row every top may keep, rerole or delete the row, and before it insert a turn. Stacks
whose top states are equal are merged into that with the smallest (cost, audit). For this grammar a
top state tells all that may follow: what lies below differs only in whether a system turn or a pair
was read before, and no later row depends on that. Of two audits of one cost neither continues the
other, since they hold a letter for each row and inserts cost extra, so the smaller stays smaller.

Rows reach the parser sorted by conversation and turn, as a stream: memory holds the tops, and the
rows and letters since the last one on which all tops agree; what lies before goes into the running
hash. So a conversation of any length passes in steps. The hash is over the whole repaired text in
its order, which is why a conversation's rows go through one task. Whether a role and text came at
an earlier turn is found before, by a distributed minimum for each of them, so no task remembers a
conversation's texts.

Defined results: null values count as one space, also in the damage's key, except that turns are
ordered and counted as they are, null first; rows of one turn are ordered by role and text; rows
without ``conv_id`` are a conversation of their own; repeated rows are duplicates; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"\x20\x09-\x0D"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
ROLES = {"u": "user", "a": "assistant"}
# Conversation: nothing, pairs, or a system turn and pairs.
GRAMMAR = (("S", ""), ("S", "C"), ("S", "sC"), ("C", "P"), ("C", "CP"), ("P", "ua"))
HELD = 256  # rows after which agreed letters are looked for
# What it costs at most to follow, with a stack whose last role is the first one, every repair that a
# stack with the second one can still take ("": no turn yet): inserts that close the gap, or deleting a
# system turn that comes too late.
FOLLOWS = {
    ("a", ""): DELETE, ("a", "s"): 0, ("a", "u"): INSERT,
    ("u", ""): INSERT + DELETE, ("u", "s"): INSERT, ("u", "a"): INSERT,
    ("s", ""): 2 * INSERT, ("s", "u"): INSERT, ("s", "a"): 2 * INSERT,
    ("", "s"): 0, ("", "u"): INSERT, ("", "a"): 0,
}
SEEN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# The parser


class Tables(NamedTuple):
    shift: dict[tuple[int, str], int]
    reduce: dict[tuple[int, str], tuple[str, int]]
    goto: dict[tuple[int, str], int]


def tables(grammar: tuple[tuple[str, str], ...] = GRAMMAR) -> Tables:
    """SLR tables of a grammar whose first rule's name is the start; $ ends the input."""
    start = grammar[0][0]
    names = {n for n, _ in grammar}
    nullable = {n for n, right in grammar if not right}
    first = {n: set() for n in names}
    follow = {n: set() for n in names} | {start: {"$"}}
    for _ in range(len(grammar) * len(names)):
        for n, right in grammar:
            for i, x in enumerate(right):
                first[n] |= first.get(x, {x})
                if x not in nullable:
                    break
            for i, x in enumerate(right):
                if x in names:
                    rest = right[i + 1:]
                    follow[x] |= first.get(rest[0], {rest[0]}) if rest else follow[n]

    def closed(items: frozenset) -> frozenset:
        items = set(items)
        while True:
            more = {(n, right, 0) for _, r, at in items if at < len(r) for n, right in grammar if n == r[at]} - items
            if not more:
                return frozenset(items)
            items |= more

    states, out = [closed(frozenset((n, r, 0) for n, r in grammar if n == start))], Tables({}, {}, {})
    for number, items in enumerate(states):
        for x in sorted({r[at] for _, r, at in items if at < len(r)}):
            to = closed(frozenset((n, r, at + 1) for n, r, at in items if at < len(r) and r[at] == x))
            if to not in states:
                states.append(to)
            (out.goto if x in names else out.shift)[number, x] = states.index(to)
        for n, r, at in items:
            if at == len(r):
                for x in follow[n]:
                    assert (number, x) not in out.shift and (number, x) not in out.reduce, "no SLR grammar"
                    out.reduce[number, x] = (n, len(r))
    return out


class Cell(NamedTuple):
    """The top of a stack: a state, and the cell below."""

    state: int
    below: Cell | None


class Top(NamedTuple):
    cost: int
    audit: str
    cell: Cell


class Parser:
    """All repairs of the rows so far, by top state."""

    def __init__(self, rules: Tables):
        self.rules = rules
        self.tops = {0: Top(0, "", Cell(0, None))}
        self.insert()

    def advance(self, cell: Cell, terminal: str) -> Cell | None:
        """The stack after the reductions that ``terminal`` asks for and its shift; None where it does not fit."""
        while (state := self.rules.shift.get((cell.state, terminal))) is None:
            rule = self.rules.reduce.get((cell.state, terminal))
            if rule is None:
                return None
            name, length = rule
            for _ in range(length):
                cell = cell.below
            to = self.rules.goto.get((cell.state, name))
            if to is None:  # the start is reduced
                return cell if terminal == "$" else None
            cell = Cell(to, cell)
        return Cell(state, cell)

    @staticmethod
    def merge(tops: dict[int, Top], top: Top) -> bool:
        """Of stacks with equal tops that with the smallest (cost, audit) stays."""
        old = tops.get(top.cell.state)
        if old is None or top[:2] < old[:2]:
            tops[top.cell.state] = top
            return True
        return False

    def insert(self) -> None:
        """Turns may be inserted here."""
        fresh = list(self.tops.values())
        while fresh:
            more = []
            for cost, audit, cell in fresh:
                for terminal in ROLES:
                    to = self.advance(cell, terminal)
                    if to is not None:
                        top = Top(cost + INSERT, audit + "I", to)
                        if self.merge(self.tops, top):
                            more.append(top)
            fresh = more

    def row(self, initial: str, broken: bool, truncated: bool) -> None:
        """Read a row: ``broken`` ones have to go, truncated ones cost extra where they stay."""
        tops: dict[int, Top] = {}
        extra = TRUNCATED if truncated else 0
        for cost, audit, cell in self.tops.values():
            self.merge(tops, Top(cost + DELETE, audit + "D", cell))
            if broken:
                continue
            to = self.advance(cell, initial) if initial != "$" else None
            if to is not None:
                self.merge(tops, Top(cost + KEEP + extra, audit + "K", to))
            for terminal in ROLES:
                to = self.advance(cell, terminal)
                if to is not None:
                    self.merge(tops, Top(cost + REROLE + extra, audit + "R", to))
        self.tops = tops
        self.insert()

    def agreed(self) -> str:
        """Drop the tops that can no longer win, and take the letters that all other audits begin with off them."""
        role = {state: terminal for (_, terminal), state in self.rules.shift.items()} | {0: ""}
        costs = {role[s]: t.cost for s, t in self.tops.items()}
        self.tops = {
            s: t for s, t in self.tops.items()
            if not any(t.cost > cost + FOLLOWS[other, role[s]] for other, cost in costs.items() if other != role[s])
        }
        prefix = os.path.commonprefix([t.audit for t in self.tops.values()])
        self.tops = {s: Top(t.cost, t.audit[len(prefix):], t.cell) for s, t in self.tops.items()}
        return prefix

    def best(self) -> Top:
        """The best of the whole repairs."""
        whole = [t for t in self.tops.values() if self.advance(t.cell, "$") is not None]
        return min(whole, key=lambda t: t[:2])


class Repair:
    """One conversation on its way through a task."""

    def __init__(self, rules: Tables, conv_id: int | None):
        self.conv_id, self.parser = conv_id, Parser(rules)
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.last_turn = None
        self.turns, self.before, self.last = 0, None, None
        self.held: list[tuple[str, str]] = []
        self.audit: list[str] = []
        self.state, self.first, self.hash = None, True, hashlib.sha256()

    def row(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault in (None, "truncated") and (turn, role, text) == self.last:
            fault = "duplicate"  # a copy at the same turn comes right behind
        self.last = (turn, role, text)
        initial = role[:1]
        if self.before is not None:
            self.faults["illegal"] += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if fault:
            self.faults[fault] += 1
        self.parser.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
        self.held.append((role, text))
        if len(self.held) % HELD == 0:
            self.write(self.parser.agreed())

    def write(self, letters: str) -> None:
        """Apply ``letters`` to the held rows; inserts behind the last of them belong to it."""
        at = 0
        for letter in letters:
            role, text = ("", "") if letter == "I" else self.held[at]
            at += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = ROLES["a" if self.state == "u" else "u"]
            self.state = role[:1]
            self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.first = False
        self.held = self.held[at:]
        self.audit.append(letters)

    def result(self) -> tuple:
        best = self.parser.best()
        self.write(best.audit)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), best.cost, "".join(self.audit), self.hash.hexdigest())


def _repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rules, names = tables(), [c.split()[0] for c in SEEN.split(", ")]
    now, key, rows = None, None, []
    for batch in batches:
        columns = [batch[c] for c in ("conv", "turn", "role", "text", "fault", "dropped")]
        for conv, turn, role, text, fault, dropped in zip(*columns, strict=True):
            if now is None or conv != key:
                if now is not None:
                    rows.append(now.result())
                now, key = Repair(rules, None if conv is None else int(conv)), conv
            if not dropped:
                now.row(None if turn is None else int(turn), role, text, fault)
            if len(rows) >= 4096:
                yield pd.DataFrame(rows, columns=names, dtype=object)
                rows = []
    if now is not None:
        rows.append(now.result())
        yield pd.DataFrame(rows, columns=names, dtype=object)


# Rows


def spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and dropped of each row after damage; dropped rows stay to name their conversation."""
    kind = (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).cast("int")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"),
        spaced("text").alias("text"), kind.alias("kind"),
    )
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repair(rows: DataFrame) -> DataFrame:
    """Repair conversations given as conv_id, turn, role, text (no nulls in these two) and dropped."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.select("*", digest.alias("digest"))
    # Only what came at more than one turn is joined back.
    seen = rows.where("not dropped").groupBy("conv_id", "digest").agg(
        F.min(F.struct("turn")).alias("low"), F.max(F.struct("turn")).alias("high")
    ).where("low <> high").select(F.col("conv_id").alias("of"), F.col("digest").alias("seen"), F.col("low.turn").alias("since"), F.lit(True).alias("again"))
    joined = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("seen")), "left")
    fault = (
        F.when(~F.col("text").rlike(f"[^{BLANKS}]"), "blank")
        .when(F.col("again") & ~F.col("turn").eqNullSafe(F.col("since")), "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{BLANKS}]*\z"), "truncated")
    )
    # As strings, so that nulls and large numbers pass into pandas as they are.
    ordered = joined.select(
        F.col("conv_id").cast("string").alias("conv"), "conv_id", "dropped", "turn", "role", "text", fault.alias("fault")
    ).repartition("conv_id").sortWithinPartitions("conv_id", "dropped", "turn", "role", "text")
    return ordered.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "fault", "dropped").mapInPandas(_repair, SEEN)


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage the conversations and repair them: a row for each conv_id."""
    return repair(damaged(conversations))
