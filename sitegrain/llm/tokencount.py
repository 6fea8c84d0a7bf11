"""Token counts of a byte-pair vocabulary by a deterministic transducer.

A token sequence is what byte-pair merging yields if every two neighbours in it are: a text's
prefix therefore has one possible last token for what came before. The transducer follows the
text character by character; its state holds, for every place from which a token may still grow,
the vocabulary's trie node reached, the last token before it, and how many tokens that place lies
behind. Each transition carries the number of tokens that it adds. States and transitions are
compiled as texts ask for them, and kept.

No token spans a blank after another character, so from there on the state is the same whatever
came before. A chunk of text thus maps any entry state to a count and an exit state that need only
its head and tail (``ChunkMap``); such maps compose associatively, and a text longer than a chunk
is counted in parallel and folded in order.

Defined results: a null text is an empty one and has no tokens; repeated rows are counted one by
one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import whole_text

BLANK = "▁"
SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
SYNCHRONISED = re.compile(f"(?<=[^{BLANK}]){BLANK}")
REMEMBERED = 1_000_000  # segments, and transitions, before they are forgotten
CHUNK = 1 << 17
LIMIT = 4096


class Vocabulary:
    """Pieces by rank (smaller: merged earlier), their trie, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[str, float], tables: tuple | None = None):
        self.ranks, self.known = ranks, {}
        if tables:
            self.trie, self.token = tables
            return
        # Pieces that merging never reaches are no tokens.
        self.trie: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        for piece in filter(self._reached, ranks):
            node = 0
            for c in piece:
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.token.append(None)
                node = self.trie[node][c]
            self.token[node] = piece

    def _reached(self, piece: str) -> bool:
        """Whether merging the piece's characters ends in the piece."""
        return len(self._merge([*piece])) == 1

    def _merge(self, parts: list[str], border: int = -1) -> list[str]:
        """Merge to the end, or until two parts meet at the ``border``."""
        ranks = self.ranks
        while True:
            pairs = ((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks)
            _, i = min(pairs, default=(0, -1))
            if i < 0 or sum(map(len, parts[:i + 1])) == border:
                return parts if i < 0 else []
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def neighbours(self, left: str | None, right: str) -> bool:
        """Whether merging leaves the two tokens apart."""
        if left is None:
            return True
        key = (left, right)
        if key not in self.known:
            self.known[key] = bool(self._merge([*left, *right], len(left)))
        return self.known[key]


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to any entry state: ``head`` runs from it, then ``count`` tokens, then ``tail`` from a fixed state.

    A chunk without a fixed state inside is all head; its count is None.
    """

    head: str
    count: int | None
    tail: str


class Transducer:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        start = ((0, None, 0),)
        self.numbers, self.states = {start: 0}, [start]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.transitions, self.segments = 0, {}

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        """The next state and the tokens added, on one character."""
        v = self.vocabulary
        grown, last, added = [], None, 0
        for node, before, behind in self.states[state]:
            at = v.trie[node].get(c)
            if at is None:
                continue
            if last is None and v.token[at] is not None and v.neighbours(before, v.token[at]):
                last, added = v.token[at], 1 - behind
            grown.append((at, before, behind))
        if last is None:  # outside the vocabulary: a token for each byte
            added, items = len(c.encode("utf-8", "surrogatepass")), ((0, None, 0),)
        else:
            items = (*((at, before, behind + added) for at, before, behind in grown if v.trie[at]), (0, last, 0))
        number = self.numbers.setdefault(items, len(self.states))
        if number == len(self.states):
            self.states.append(items)
            self.moves.append({})
        self.moves[state][c] = move = (number, added)
        self.transitions += 1
        return move

    def run(self, text: str) -> int:
        """Tokens of a text that begins at a place where no token can be under way."""
        state, total, moves = 0, 0, self.moves
        for c in text:
            move = moves[state].get(c) or self._compile(state, c)
            state = move[0]
            total += move[1]
        return total

    def count(self, text: str) -> int:
        """The same, segment by segment; what a segment adds is remembered. A line end is a token of its own."""
        if self.transitions > REMEMBERED or len(self.segments) > REMEMBERED:
            self._forget()
        total, known = 0, self.segments
        for line in text.split("\n"):
            for s in SEGMENT.findall(line):
                n = known.get(s)
                if n is None:
                    n = known[s] = self.run(s)
                total += n
        return total + text.count("\n")

    def chunk_map(self, chunk: str) -> ChunkMap:
        first = SYNCHRONISED.search(chunk)
        if first is None:
            return ChunkMap(chunk, None, "")
        end = len(chunk)
        while not (SYNCHRONISED.match(chunk, end)):
            end = chunk.rfind(BLANK, 0, end)
        return ChunkMap(chunk[:first.start()], self.count(chunk[first.start():end]), chunk[end:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First ``a``, then ``b``; associative."""
        if a.count is None and b.count is None:
            return ChunkMap(a.head + b.head, None, "")
        if a.count is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.count is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        return ChunkMap(a.head, a.count + self.count(a.tail + b.head) + b.count, b.tail)

    def total(self, m: ChunkMap) -> int:
        """Tokens of a whole text's map, entered at the start."""
        return self.count(m.head) + (0 if m.count is None else m.count + self.count(m.tail))


def compile_vocabulary(model: str) -> Transducer:
    """Read pieces and scores of a sentencepiece BPE model with identity normalisation and byte fallback."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ordinary = (
        i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))
    )
    return Transducer(Vocabulary({sp.id_to_piece(i): -sp.get_score(i) for i in ordinary}))


def normalised(text: str) -> str:
    """Blanks become the visible sign, and one stands before the text; an empty text stays empty."""
    return BLANK + text.replace(" ", BLANK) if text else ""


def count_tokens(spark: SparkSession, docs: DataFrame, model: str, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``model`` is the vocabulary's file on the driver; the compiled tables, a few MB fixed by the
    vocabulary, are broadcast. Texts of more than four chunks are cut, counted where their chunks
    are dealt to, and folded.
    """
    compiled = compile_vocabulary(model).vocabulary
    shared = spark.sparkContext.broadcast({"ranks": compiled.ranks, "tables": (compiled.trie, compiled.token)})

    def worker() -> Transducer:
        """The transducer of this Python worker: its states stay for the tasks that follow."""
        held = shared.value
        if "transducer" not in held:
            held["transducer"] = Transducer(Vocabulary(held["ranks"], held["tables"]))
        return held["transducer"]

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    long = F.col("n_bytes") > 4 * chunk

    def whole(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        transducer = worker()
        for batch in texts:
            yield pd.Series([transducer.count(normalised(t)) for t in batch], dtype="int64")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uid, doc_id, n_bytes, text in batch[["uid", "doc_id", "n_bytes", "text"]].itertuples(index=False):
                text = normalised(text)
                for k, at in enumerate(range(0, len(text), chunk)):
                    yield pd.DataFrame({"uid": [uid], "doc_id": [doc_id], "n_bytes": [n_bytes], "k": [k], "part": [text[at:at + chunk]]})

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            maps = [worker().chunk_map(p) for p in batch["part"]]
            yield batch.drop(columns="part").assign(
                head=[m.head for m in maps], count=[m.count for m in maps], tail=[m.tail for m in maps]
            )

    def folded(group: pd.DataFrame) -> pd.DataFrame:
        transducer = worker()
        maps = [
            ChunkMap(h, None if pd.isna(c) else int(c), t)
            for h, c, t in group.sort_values("k")[["head", "count", "tail"]].itertuples(index=False)
        ]
        total = transducer.total(reduce(transducer.compose, maps))
        return group[["doc_id", "n_bytes"]].head(1).assign(n_tokens=total)

    short = rows.where(~long).select("doc_id", "n_bytes", F.pandas_udf(whole, "long")("text").alias("n_tokens"))
    # Ids pass as text: a batch with a null one would turn them into floats.
    parts = rows.where(long).select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("string").alias("doc_id"), "text", "n_bytes"
    ).mapInPandas(cut, "uid long, doc_id string, n_bytes long, k long, part string")
    maps = parts.repartition("uid", "k").mapInPandas(
        mapped, "uid long, doc_id string, n_bytes long, k long, head string, count long, tail string"
    )
    cut_up = maps.groupBy("uid").applyInPandas(folded, "doc_id string, n_bytes long, n_tokens long").withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )
    return short.unionByName(cut_up).withColumn("over_limit", F.col("n_tokens") > limit)
