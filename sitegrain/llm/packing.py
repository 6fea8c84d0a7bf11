"""Mixture-controlled packing by deficit round-robin over source queues.

All documents become one stream of tokens that is cut into sequences. Each source is a queue. In
every window of the stream each queue earns its share of the window's tokens (a source's share is
its part of all tokens, so that all queues end together) and is served in granules; what it has
earned and not been served stays as its deficit, which the next window takes over.

The state of the round-robin before window ``w`` has a closed form: a queue of ``T`` tokens has
earned ``T * w / windows`` and been served the whole granules of that. So any task can take up the
queues at any window with the deficits carried there, whatever partition its documents lie in, and
the place of a token follows from its place in its queue alone (``Rounds``).

Defined results: a null or empty text is its end token; a null source is a queue of its own;
repeated rows are packed one by one; an empty table gives an empty result; other columns are not
read. Only the stream's end is not a multiple of a sequence: it is cut into sequences whose
lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import prefix_digits, running_start, settings, stored, whole_text

SEQUENCE = 2048
WINDOW = 16 * SEQUENCE  # tokens over which the proportions hold
GRANULE = 256  # tokens a queue is served at once
QUEUES = 1024  # with more sources than this, sources share queues by a hash
MOST_WINDOWS = 1 << 27  # beyond 4e12 tokens windows grow, so that the sums stay in 64 bits
END = 1
REMEMBERED = 1_000_000  # words whose ids a Python worker keeps, some 250 bytes each
BATCH = 1024  # texts handed to Python at once
# No token spans a single blank between two other characters; a blank belongs to what follows it.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# Nor does one span a letter and a stop or line end beside it. Only letters of every version of Unicode are named.
LETTER, STOP = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", ".,;:!?"
PARTS = re.compile(rf"(?<=[{LETTER}])(?=[{STOP}\n])|(?:(?<=[{STOP}])|(?<=\S\n))(?=[{LETTER}])")


class Rounds:
    """Where each queue's tokens stand in the stream. ``totals``: tokens of each queue."""

    def __init__(self, totals: np.ndarray, window: int = WINDOW, granule: int = GRANULE):
        self.totals, self.granule = totals.astype(np.int64), granule
        self.all = int(self.totals.sum())
        self.windows = max(1, min(-(-self.all // window), MOST_WINDOWS))
        # Tokens earned in a window, in parts of windows * granule.
        self.unit = self.windows * granule
        self.whole, self.part = np.divmod(self.totals, self.unit)

    def served(self, queue: np.ndarray | slice, w: np.ndarray) -> np.ndarray:
        """Tokens served before window ``w``: the whole granules earned, and all at the end."""
        granules = self.whole[queue] * w + self.part[queue] * w // self.unit
        return np.where(w >= self.windows, self.totals[queue], np.minimum(granules * self.granule, self.totals[queue]))

    def window_of(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The window in which the granule that holds place ``at`` of a queue is served."""
        need = np.minimum((at // self.granule + 1) * self.granule, self.totals[queue])
        w = np.floor(need.astype(np.float64) / self.totals[queue] * self.windows).astype(np.int64) - 1
        w = np.clip(w, 0, self.windows - 1)
        for _ in range(2):  # the estimate is off by one window at most each way
            w = np.where((w > 0) & (self.served(queue, w) >= need), w - 1, w)
        for _ in range(3):
            w = np.where(self.served(queue, w + 1) < need, w + 1, w)
        return w

    def place(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place in the stream of place ``at`` of a queue."""
        w = self.window_of(queue, at)
        rounds, row = np.unique(w, return_inverse=True)
        out = np.empty(len(at), np.int64)
        step = max(1, (1 << 22) // len(self.totals))
        for k in range(0, len(rounds), step):
            some = rounds[k:k + step, None]
            before, after = self.served(slice(None), some), self.served(slice(None), some + 1)
            turn = np.cumsum(after - before, axis=1) - (after - before)  # of the queues before in the window
            start = before.sum(axis=1)[:, None] + turn - before
            mine = (row >= k) & (row < k + step)
            out[mine] = start[row[mine] - k, queue[mine]] + at[mine]
        return out


def cut(rounds: Rounds, queue: np.ndarray, start: np.ndarray, length: np.ndarray, sequence: int = SEQUENCE):
    """Pieces of documents that lie at ``start`` of their queue: (document, its token, length, sequence_id, offset)."""
    g = rounds.granule
    count = (start + length - 1) // g - start // g + 1
    doc = np.repeat(np.arange(len(start)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    low = np.maximum(start[doc], (start[doc] // g + k) * g)
    high = np.minimum(start[doc] + length[doc], (start[doc] // g + k + 1) * g)
    place = rounds.place(queue[doc], low)
    # Granules that follow one another in the stream are one run.
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + (high - low)[:-1])
    at = np.flatnonzero(first)
    size = np.add.reduceat(high - low, at) if len(at) else np.zeros(0, np.int64)
    doc, token, place = doc[at], (low - start[doc])[at], place[at]
    # Cut at the ends of sequences; those of the tail are powers of two.
    full = rounds.all // sequence * sequence
    tail, edge, ends = rounds.all - full, full, []
    for bit in reversed(range(sequence.bit_length())):
        if tail >> bit & 1:
            edge += 1 << bit
            ends.append(edge)
    starts = np.array([full, *ends], np.int64)

    def number(p: np.ndarray) -> np.ndarray:
        return np.where(p < full, p // sequence, full // sequence + np.searchsorted(starts, p, side="right") - 1)

    def begin(s: np.ndarray) -> np.ndarray:
        whole = full // sequence
        return np.where(s < whole, s * sequence, starts[np.clip(s - whole, 0, len(starts) - 1)])

    pieces = number(place + size - 1) - number(place) + 1
    run = np.repeat(np.arange(len(place)), pieces)
    s = number(place)[run] + np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = np.maximum(place[run], begin(s))
    high = np.minimum((place + size)[run], begin(s + 1))
    return doc[run], token[run] + low - place[run], high - low, s, low - begin(s)


class Encoder:
    """Ids of texts as the library gives them, as bytes. A word's ids are remembered, at most about ``remembered`` words.

    ``plain``: the tokenizer cuts texts as GPT-2 does. Then no token spans a blank and what stands before it, if no
    white space follows the blank, nor a letter and a stop beside it. New words are encoded in such parts: there are
    fewer of them than of words.
    """

    def __init__(self, content: str, remembered: int, plain: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.remembered = Tokenizer.from_str(content), remembered
        self.width = width_of(self.tokenizer)
        self.known: dict[str, bytes] = {}  # by word: the ids of a blank and the word
        self.inner: dict[str, bytes] = {}  # by part: the ids of the part without a blank
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = plain
        # Tokens that begin with a blank, which byte-level vocabularies write so.
        blank = [k for t, k in self.tokenizer.get_vocab().items() if t.startswith("\u0120")]
        self.begins = np.isin(np.arange(self.tokenizer.get_vocab_size()), blank)

    def _each(self, texts: list[str]) -> list[bytes]:
        codes = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(code.ids, self.width).tobytes() for code in codes]

    def _after_blank(self, words: list[str]) -> list[bytes]:
        """The ids of a blank and the word for each word; one call for all where no word holds a blank."""
        if not words:
            return []
        (code,) = self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)
        ids = np.array(code.ids, self.width)
        first = np.flatnonzero(self.begins[ids])
        if len(first) != len(words):
            return self._each([" " + w for w in words])
        held, at = ids.tobytes(), (first * ids.itemsize).tolist()
        return [held[a:b] for a, b in zip(at, [*at[1:], len(held)], strict=True)]

    def _learn(self, words: dict[str, None]) -> None:
        """Remember the ids of new words."""
        known, inner = self.known, self.inner
        whole, odd, parts = [], [], {}
        for word in words:
            if word.isalpha():
                whole.append(word)
            elif " " in word:
                odd.append(word)
            elif len(cut_up := PARTS.split(word)) > 1:
                parts[word] = cut_up
            else:
                whole.append(word)
        whole += dict.fromkeys(ps[0] for ps in parts.values() if ps[0] not in known and ps[0] not in words)
        known.update(zip(whole, self._after_blank(whole), strict=True))
        known.update(zip(odd, self._each([" " + w for w in odd]), strict=True))
        rest = list(dict.fromkeys(p for ps in parts.values() for p in ps[1:] if p not in inner))
        inner.update(zip(rest, self._each(rest), strict=True))
        for word, (first, *others) in parts.items():
            known[word] = known[first] + b"".join(map(inner.__getitem__, others))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.plain:
            return self._each(texts)
        if len(self.known) + len(self.inner) > self.remembered:
            self.known, self.inner = {}, {}
        known = self.known
        heads, words, new = [], [], {}
        for text in texts:
            head, *rest = [text] if any(map(text.__contains__, self.special)) else text.split(" ")
            codes = list(map(known.get, rest))
            missing = [w for w, ids in zip(rest, codes, strict=True) if ids is None]
            if any(not w or w[0].isspace() for w in missing):
                head, *rest = BETWEEN.split(text)
                codes = list(map(known.get, rest))
                missing = [w for w, ids in zip(rest, codes, strict=True) if ids is None]
            heads.append(head)
            words.append((rest, codes))
            new.update(dict.fromkeys(missing))
        self._learn(new)
        return [
            h + b"".join([known[w] if ids is None else ids for w, ids in zip(rest, codes, strict=True)])
            for h, (rest, codes) in zip(self._each(heads), words, strict=True)
        ]


def width_of(tokenizer) -> str:
    """The numpy type of ids: 16 bits where they suffice."""
    return "<u2" if tokenizer.get_vocab_size() < 1 << 16 else "<u4"


def cuts_as_gpt2(content: str) -> bool:
    """Whether a tokenizer file cuts whole texts by GPT-2's pattern and by nothing else."""
    held = json.loads(content)
    cutter = held.get("pre_tokenizer") or {}
    return (
        held.get("normalizer") is None and cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex", True) and not cutter.get("add_prefix_space", True)
    )


def tokenised(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int = END, remembered: int = REMEMBERED) -> DataFrame:
    """Stored rows: uid, doc_id, source, shuffle key, tokens, ids (little-endian, 16 bits where they suffice).

    ``tokenizer`` is a file on the driver; its content travels to the tasks.
    """
    import tokenizers

    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    width = width_of(tokenizers.Tokenizer.from_str(content))
    shared = spark.sparkContext.broadcast({"content": content, "plain": cuts_as_gpt2(content)})

    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = shared.value
        if "encoder" not in held:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            held["encoder"] = Encoder(held.pop("content"), remembered, held["plain"])
        last = np.array([end], width).tobytes()
        for batch in texts:
            out = []
            gc.disable()  # nothing here is cyclic, and to look for cycles walks over all words again and again
            try:
                for at in range(0, len(batch), 256):
                    out += [b + last for b in held["encoder"](batch.iloc[at:at + 256].tolist())]
            finally:
                gc.enable()
            yield pd.Series(out, dtype=object)

    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1")).alias("source"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("shuffle"),
        F.pandas_udf(ids, "binary")(whole_text()).alias("ids"),
    )
    size = np.dtype(width).itemsize
    # Texts reach Python in small batches, since each is there several times while it is encoded.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    with settings(spark, {key: str(min(now, BATCH) if now > 0 else BATCH)}):
        return stored(spark, rows.withColumn("tokens", (F.octet_length("ids") / size).cast("long")), "packing-ids")


def pack(
    spark: SparkSession, docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, window: int = WINDOW, remembered: int = REMEMBERED,
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = tokenised(spark, docs, tokenizer, remembered=remembered)
    names = [r[0] for r in rows.select("source").distinct().limit(QUEUES + 1).collect()]
    key = F.col("source") if len(names) <= QUEUES else F.pmod(F.xxhash64("source"), F.lit(QUEUES)).cast("string")
    narrow = rows.select("uid", key.alias("source"), "tokens", "shuffle")
    totals = sorted(tuple(r) for r in narrow.groupBy("source").agg(F.sum("tokens")).collect())  # QUEUES rows at most
    rounds = Rounds(np.array([t for _, t in totals], np.int64), window)
    numbers = spark.createDataFrame([(s, k) for k, (s, _) in enumerate(totals)], "source string, queue int")

    digits = prefix_digits(rows.count())
    lines = running_start(
        narrow.withColumn("bucket", F.substring("shuffle", 1, digits)), "source", "bucket", ["shuffle", "tokens", "uid"],
        F.col("tokens"), "line",
    ).join(F.broadcast(numbers), "source").select("uid", "queue", "line")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Some rows at a time: their ids are unpacked to 32 bits.
        for batch in (whole.iloc[at:at + BATCH] for whole in batches for at in range(0, len(whole), BATCH)):
            tokens = batch["tokens"].to_numpy()
            doc, start, length, number, offset = cut(
                rounds, batch["queue"].to_numpy(), batch["line"].to_numpy(), tokens, sequence
            )
            ids = [np.frombuffer(b, f"<u{len(b) // n}").astype("<u4") for b, n in zip(batch["ids"], tokens, strict=True)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].to_numpy()[doc], "start": start, "length": length,
                "ids_crc32": [crc32(ids[d][a:a + n]) for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)],
                "doc_tokens": tokens[doc], "sequence_id": number, "offset": offset,
            })

    joined = rows.select("uid", F.col("doc_id").cast("string"), "tokens", "ids").join(lines, "uid")
    # Ids pass as text: a batch with a null one would turn them into floats.
    return joined.select("doc_id", "tokens", "ids", "queue", "line").mapInPandas(
        pieces,
        "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    ).withColumn("doc_id", F.col("doc_id").cast("long"))
