"""Near duplicates by SimHash, compared bit-sliced.

A text's fingerprint has a bit for each of the 64 bits that more than half of its shingles' hashes
set. Equal fingerprints are one node. Two that differ in at most ``radius`` bits agree in at least
one of ``radius + 1`` bands of bits, in two of ``radius + 2``, and so on; nodes are dealt to buckets
by such agreements, so no pair within the radius is missed.

In a bucket the fingerprints are stored as bit planes: plane ``j`` holds bit ``j`` of 64 nodes in
one word. Many queries run against all nodes at once: each plane's differences are added to
bitwise carry-save counters of three bits and an overflow, and a block is left as soon as every
counter in it exceeds the radius. What a bucket yields is one edge for each node that has a
neighbour, to the smallest node of its part of the bucket; the parts meet in ``components``.

A bucket of more than ``BLOCK`` nodes is split: nodes are dealt to groups, and each pair of groups
is a bucket of its own, so the work of a hot bucket spreads and none of its pairs is lost.

Defined results: a null or empty text has fingerprint zero, which links like any other; fewer words
than a shingle make one shingle; repeated rows share a node; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import keep_rows, stored, text_sha, whole_text
from sitegrain.llm.components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
BITS = 64
BLOCK = 2048  # nodes of a group in a split bucket
QUERIES_AT_ONCE = 256
BUCKET_NODES = 64  # the bands are chosen so that buckets of evenly spread nodes hold about so many


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)], np.uint64
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, the fingerprint as a long, and ``more``."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.pandas_udf(_fingerprints, "long")(whole_text()).alias("fp"), *more
    )


def bands(nodes: int, radius: int = RADIUS) -> tuple[int, int]:
    """How many bands, and how many of them must agree, so that even buckets hold about ``BUCKET_NODES``.

    Every choice finds all pairs; more bands make more, smaller buckets.
    """
    agree = 1
    while agree < 4 and nodes / 2 ** (BITS * agree / (radius + agree)) > BUCKET_NODES:
        agree += 1
    return radius + agree, agree


def _band_keys(fp: Column, count: int, agree: int) -> list[Column]:
    """A key for each choice of ``agree`` bands: the choice's number, and the bits of these bands."""
    edges = [BITS * i // count for i in range(count + 1)]
    keys = []
    for bands_ in combinations(range(count), agree):
        wanted = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in bands_)
        signed = wanted - (1 << 64) if wanted >= 1 << 63 else wanted
        keys.append(fp.bitwiseAND(F.lit(signed).cast("long")))
    return keys


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row ``j`` holds bit ``j`` of every fingerprint, 64 to a word."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(queries: np.ndarray, sliced: np.ndarray, order: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """For each query and block (a word of 64 nodes) the bits that mark the nodes at most ``radius`` bits away.

    ``order`` lists the planes to compare; planes in which a bucket agrees can be left out. Returns
    the marks and the blocks they stand for. Counters hold ``a + 2b + 4c``; ``over`` marks distances
    beyond the radius, and a block that is over for every query is abandoned.
    """
    block = np.arange(sliced.shape[1])
    a, b, c, over = (np.zeros((len(queries), len(block)), np.uint64) for _ in range(4))
    full = ~np.uint64(0)
    for step, j in enumerate(order):
        flip = np.where((queries >> np.uint64(j)) & np.uint64(1), full, np.uint64(0))
        carry = sliced[j, block] ^ flip[:, None]
        carry, a = a & carry, a ^ carry
        carry, b = b & carry, b ^ carry
        over |= c & carry
        c ^= carry
        over |= _beyond(a, b, c, radius)
        if step % 4 == 3 and step > 8:
            alive = (over != full).any(axis=0)
            if not alive.any():
                return over[:, :0], block[:0]
            if 2 * alive.sum() <= len(block):
                block = block[alive]
                a, b, c, over = (v[:, alive] for v in (a, b, c, over))
    return ~over, block


def _beyond(a: np.ndarray, b: np.ndarray, c: np.ndarray, radius: int) -> np.ndarray:
    """Where the counters hold more than ``radius``, at most 4."""
    return {0: a | b | c, 1: b | c, 2: c | (a & b), 3: c, 4: c & (a | b)}[radius]


class Parts:
    """The connected parts of a bucket's nodes, as the smallest member of each."""

    def __init__(self, count: int):
        self.of = np.arange(count)

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.of[x], self.of[y]
            apart = a != b
            if not apart.any():
                return
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while True:
                root = self.of[self.of]
                if (root == self.of).all():
                    break
                self.of = root


def bucket_edges(fps: np.ndarray, left: np.ndarray | None = None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its part) among sorted distinct fingerprints of a bucket.

    Where ``left`` marks one of two groups, only pairs between the groups are compared.
    """
    n = len(fps)
    parts = Parts(n)
    if n > 1:
        differing = np.bitwise_or.reduce(fps ^ fps[0])
        order = np.flatnonzero((differing >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1))
        ask = np.arange(n) if left is None else np.flatnonzero(left)
        answer = np.arange(n) if left is None else np.flatnonzero(~left)
        sliced = planes(fps[answer])
        for at in range(0, len(ask), QUERIES_AT_ONCE):
            some = ask[at:at + QUERIES_AT_ONCE]
            hits, block = within(fps[some], sliced, order, radius)
            q, w = np.nonzero(hits)
            if not len(q):
                continue
            marks = np.unpackbits(hits[q, w].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(marks)
            node = block[w[row]] * 64 + bit
            real = node < len(answer)
            parts.join(some[q[row[real]]], answer[node[real]])
    linked = np.flatnonzero(parts.of != np.arange(n))
    return fps[linked], fps[parts.of[linked]]


def _buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket come in; a bucket that goes on in the next batch waits for it."""
    held = None

    def edges(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        sizes = rows.groupby(["choice", "key", "x", "y"], sort=False).size().to_numpy()
        stops = np.cumsum(sizes)
        fps, side, x, y = (rows[c].to_numpy() for c in ("fp", "side", "x", "y"))
        node, root = [], []
        for a, b in zip((stops - sizes)[sizes > 1], stops[sizes > 1], strict=True):
            group = fps[a:b].view(np.uint64)
            sort = np.argsort(group)
            found = bucket_edges(group[sort], None if x[a] == y[a] else (side[a:b] == x[a])[sort])
            node.append(found[0])
            root.append(found[1])
        if node:
            yield pd.DataFrame({"src": np.concatenate(node).view(np.int64), "dst": np.concatenate(root).view(np.int64)})

    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = held[["choice", "key", "x", "y"]].iloc[-1]
        open_ = (held[["choice", "key", "x", "y"]] == last).all(axis=1).to_numpy()
        start = int(np.argmax(open_))
        if start:
            yield from edges(held.iloc[:start].reset_index(drop=True))
            held = held.iloc[start:].reset_index(drop=True)
    if held is not None and len(held):
        yield from edges(held)


def links(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Edges (src, dst) that connect what lies within the radius. ``nodes`` is a stored table of distinct ``fp``."""
    count, agree = bands(nodes.count())
    keys = _band_keys(F.col("fp"), count, agree)
    dealt = nodes.select("fp", F.posexplode(F.array(*keys)).alias("choice", "key"))
    # Groups of a bucket: one, unless it is hot.
    hot = (
        dealt.groupBy("choice", "key").count().where(F.col("count") > BLOCK)
        .select("choice", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("groups"))
    )
    split = (
        dealt.join(hot, ["choice", "key"], "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
        .withColumn("side", F.pmod(F.xxhash64("fp"), F.col("groups")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        .select("choice", "key", "fp", "side", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"))
    )
    bucket = ["choice", "key", "x", "y"]
    return (
        split.repartition(*map(F.col, bucket)).sortWithinPartitions(*bucket)
        .mapInPandas(_buckets, "src long, dst long").distinct()
    )


def _roots(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """fp, first (its smallest doc_id) and root (a fingerprint that names the component) of every fingerprint in ``rows``."""
    # A node's name is its fingerprint; its documents count through the smallest id.
    nodes = stored(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(spark, links(spark, nodes.select("fp")))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = stored(spark, fingerprints(docs), "simhash-rows")
    named = _roots(spark, rows)
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest ``doc_id``, a null one last.

    Rows that share this ``doc_id`` are told apart by the digest of their text; of wholly repeated ones one stays.
    """
    rows = stored(spark, fingerprints(docs, text_sha().alias("sha")), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "sha")
    # The best row of a fingerprint first, so that a hot one is a row for each task.
    best = rows.groupBy("fp").agg(F.min(order).alias("best")).join(_roots(spark, rows).select("fp", "root"), "fp")
    best = best.groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.sha")
    wanted = rows.select("doc_id", "sha").alias("r").join(
        best.alias("b"), F.col("r.sha").eqNullSafe(F.col("b.sha")) & F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")), "left_semi"
    )
    return keep_rows(docs, wanted)
