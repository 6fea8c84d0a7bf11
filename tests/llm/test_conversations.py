"""The conversation operators against plain counterparts."""

import hashlib
import random
import re
from collections import Counter
from itertools import product
from zlib import crc32

import pytest

from checks.compare import compare, connect
from sitegrain.llm import repair, trie
from sitegrain.llm.oracle import ORACLE
from sitegrain.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CONVERSATIONS = "conv_id long, turn long, role string, text string, shard int, path string, words int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 2) for r in rows], CONVERSATIONS).repartition(3)


def by_conversation(rows):
    out = {}
    for c, turn, role, text in rows:
        out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return out


# Prefix trie


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def plain_trie(rows):
    own = by_conversation(r for r in rows if r[0] is not None)
    own = {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda x: (x[0], x[1], digest(x[2], x[3])))] for c, ts in own.items()}
    nodes = {}
    for c, ts in own.items():
        h = crc32(str(c).encode()) % 4
        path = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + ts[h:]
        for d in range(len(path) + 1):
            node = nodes.setdefault(tuple(path[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(path):
                node["ends"].append(c)
    out = []
    for p, node in nodes.items():
        below = {q: n for q, n in nodes.items() if q[:len(p)] == p}
        children = {q for q in below if len(q) == len(p) + 1}
        saved = sum((len(n["members"]) - 1) * len(q[-1][1].encode().split()) for q, n in below.items() if q)
        leaves = sum(not any(len(r) > len(q) and r[:len(q)] == q for r in below) for q in below)
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        above = min(nodes[p[:-1]]["members"]) if p else None
        out.append((min(node["members"]), len(p), above, len(node["members"]), len(children), leaves, saved, ends))
    return Counter(out)


def tree_rows(seed=3):
    """Shared prefixes, copies, repeated rows, ties, nulls, negative ids, a long conversation."""
    rng = random.Random(seed)
    rows = []
    for c in range(-45, 120):
        if rng.random() < 0.2:
            continue
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(turn % 3))))
    rows += [(c, t, "user", f"same words {t}") for c in range(200, 260) for t in range(3)]
    rows += [(300, None, "user", "first"), (300, 0, None, "x"), (300, 0, "user", None), (300, 1, "user", "y"), (300, 1, "user", "y")]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (301, None, None, None)]
    rows += [(320, t, "user", f"turn {t}") for t in range(60)] + [(321, t, "user", f"turn {t}") for t in range(50)]
    return rows


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_trie(spark, shards):
    got = trie.conversation_trie(spark, table(spark, tree_rows()), shards)
    assert got.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert Counter(map(tuple, got.collect())) == plain_trie(tree_rows())


def test_trie_with_short_splitters_and_chunks(spark, monkeypatch):
    """Splitters cut after a turn, and identifiers hashed in chunks, change nothing."""
    monkeypatch.setattr(trie, "SPLITTER_TURNS", 1)
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 2)
    got = trie.conversation_trie(spark, table(spark, tree_rows()), 9)
    assert Counter(map(tuple, got.collect())) == plain_trie(tree_rows())


def test_copies_spread_over_shards(spark):
    """One path of many conversations has splitters of its own, which differ in the identifier."""
    paths = spark.range(2000).selectExpr("id as conv_id", f"repeat('0', {2 * trie.DIGITS}) as path", "array(1, 2) as words")
    tree = trie.skeleton(paths, 10)
    assert len(tree.splitters) == 9 and len({p for p, _ in tree.splitters}) == 1 and len(tree.rows) == 3
    got = {r["depth"]: r for r in trie.prefix_trie(spark, paths, 10).collect()}
    ends = hashlib.sha256(",".join(map(str, range(2000))).encode()).hexdigest()
    assert got[2]["ends_sha256"] == ends and got[0]["saved_tokens"] == 3 * 1999 and got[1]["n_leaves"] == 1


def test_trie_of_nothing(spark):
    assert trie.conversation_trie(spark, table(spark, tree_rows()).where("false")).count() == 0


def test_trie_against_sql(spark):
    assert compare(spark, connect(SF), SF, "op11_prefix_trie", QUERIES["op11_prefix_trie"], ORACLE["op11_prefix_trie"]) == ""


# Repair

BLANK = "[ \t-\r]"


def plain_rows(rows):
    """Damage in plain Python: the rows of each conversation in order."""
    out = {}
    for c, turn, role, text in rows:
        kept = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, kept in out.items()}


def plain_faults(rows):
    out = []
    for i, (_, role, text) in enumerate(rows):
        visible = re.sub(BLANK, "", text)
        if not visible:
            out.append("blank")
        elif any(r[1:] == (role, text) for r in rows[:i]):
            out.append("duplicate")
        else:
            out.append("" if visible[-1] in ".!?" else "truncated")
    return out


def every_repair(rows, faults, inserts=2):
    """The best of all repairs with up to two inserts in a row: (cost, audit, repaired rows)."""
    gaps = [[(5 * n, "I" * n, way) for n in range(inserts + 1) for way in product("ua", repeat=n)]]
    steps = list(gaps)
    for (_, role, text), fault in zip(rows, faults, strict=True):
        more = 5 if fault == "truncated" else 0
        ways = [(2, "D", ())]
        if fault not in ("blank", "duplicate"):
            ways += [(more, "K", ((role, text),)), *[(1 + more, "R", ((r, text),)) for r in ("user", "assistant")]]
        steps += [ways, *gaps]
    best = None
    for way in product(*steps):
        turns = [({"u": "user", "a": "assistant"}[t], "") if isinstance(t, str) else t for _, _, ts in way for t in ts]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in turns)):
            found = (sum(c for c, _, _ in way), "".join(a for _, a, _ in way), turns)
            best = found if best is None or found[:2] < best[:2] else best
    return best


def automaton_repair(rows, faults):
    """The same by the plain automaton of the role pattern, for any length."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    def put(tops, state, found):
        if state is not None and (state not in tops or found[:2] < tops[state][:2]):
            tops[state] = found
            return True
    def inserted(tops):
        for _ in range(4):
            for state, (cost, audit, turns) in list(tops.items()):
                for r in ("user", "assistant"):
                    put(tops, moves.get((state, r[0])), (cost + 5, audit + "I", [*turns, (r, "")]))
        return tops
    tops = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults, strict=True):
        more, after = 5 if fault == "truncated" else 0, {}
        for state, (cost, audit, turns) in tops.items():
            put(after, state, (cost + 2, audit + "D", turns))
            if fault not in ("blank", "duplicate"):
                put(after, moves.get((state, role[:1])), (cost + more, audit + "K", [*turns, (role, text)]))
                for r in ("user", "assistant"):
                    put(after, moves.get((state, r[0])), (cost + 1 + more, audit + "R", [*turns, (r, text)]))
        tops = inserted(after)
    return min((tops[s] for s in ("", "a") if s in tops), key=lambda t: t[:2])


def plain_repair(rows, best_of):
    out = []
    for c, kept in plain_rows(rows).items():
        faults = plain_faults(kept)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        cost, audit, fixed = best_of(kept, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return Counter(out)


def damaged_rows(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(count):
        for turn in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "upper", "Pair", "$", "s"])
            text = rng.choice(["one.", "two", "three! \t", None, "", " \n", "four?", "äö 😀.", f"{c} {turn}.", "x"])
            rows.append((c - 5, rng.choice([turn, turn, turn + 3, None, 2]), role, text))
    return rows + [(None, 1, "user", "a."), (None, None, None, None), (900, None, "user", "only."), (901, 2**60, "user", "far."), (901, -4, "system", "s.")]


def test_tables_are_of_the_grammar():
    """Every word of up to seven roles is accepted or refused as the role pattern does."""
    rules = repair.tables()
    for n in range(8):
        for word in product("sua", repeat=n):
            parser = repair.Parser(rules)
            cell = repair.Cell(0, None)
            for x in (*word, "$"):
                cell = cell and parser.advance(cell, x)
            assert (cell is not None) == bool(re.fullmatch("(s?(ua)+)?", "".join(word)))


def test_best_repair_of_all():
    """Short conversations against every possible repair."""
    rng = random.Random(5)
    rules = repair.tables()
    for _ in range(150):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), f"{i}") for i in range(rng.randint(0, 3))]
        faults = [rng.choice(["", "", "blank", "truncated"]) for _ in rows]
        one = repair.Repair(rules, 1)
        for row, fault in zip(rows, faults, strict=True):
            one.row(*row, fault or None)
        cost, audit, fixed = every_repair(rows, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        assert one.result()[-3:] == (cost, audit, digest)
        assert automaton_repair(rows, faults)[:2] == (cost, audit)


@pytest.mark.parametrize("held", [1, 256])
def test_repair(spark, monkeypatch, held):
    monkeypatch.setattr(repair, "HELD", held)
    rows = damaged_rows(1, 250, 9)
    got = repair.repair_conversations(table(spark, rows))
    assert got.columns == [c.split()[0] for c in repair.SEEN.split(", ")]
    assert Counter(map(tuple, got.collect())) == plain_repair(rows, automaton_repair)


def test_repair_of_long_conversations(spark):
    """Held rows stay few, and letters agree with the plain automaton over thousands of rows."""
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{t}" + rng.choice(["", ".", "!"])) for t in range(3000)]
    rows += [(8, t, ("user", "assistant")[t % 2], "same.") for t in range(2000)]
    got = repair.repair_conversations(table(spark, rows))
    assert Counter(map(tuple, got.collect())) == plain_repair(rows, automaton_repair)
    one = repair.Repair(repair.tables(), 7)
    for _, turn, role, text in rows[:3000]:
        one.row(turn, role, text, None if text[-1] in ".!" else "truncated")
        assert len(one.held) <= repair.HELD + 16


def test_repair_query_against_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, QUERIES["op12_repair"](spark, SF).collect())) == plain_repair(rows, automaton_repair)


def test_repair_of_nothing(spark):
    assert repair.repair_conversations(table(spark, tree_rows()).where("false")).count() == 0
