"""Prefix trie of conversations by sorted shards and a skeleton of splitter paths.

A conversation is a path of turns, each named by a digest of its role and text, so that sorting
paths puts the members of every trie node side by side. Paths are dealt to shards by splitters, keys
(path, conv_id) from a hashed sample; the identifier belongs to the key, so that one path with very
many copies spreads over shards too. The trie of the splitters' paths, the skeleton, is broadcast.
Only a node of the skeleton can have members in two shards: one that is no prefix of any splitter
lies between two of them. A shard is swept once in order, with a stack of open nodes. A node outside
the skeleton is finished when it closes; for one of the skeleton the shard yields a partial
aggregate, and partials are reduced to one row per skeleton node. Sums over subtrees of the skeleton
are differences of running sums in its preorder.

Sizes: the skeleton has at most ``shards`` x ``SPLITTER_TURNS`` nodes, whatever the input. A longer
splitter is cut there, which is as right a splitter, only less even. A shard's sweep holds the open
path and the finished children of its open nodes, at most the shard's own nodes. A conversation
travels as one row of about 40 bytes a turn.

Defined results: rows without ``conv_id`` belong to no conversation and are left out; turns are
ordered by ``turn``, null first, and among equal ones by their digest; repeated rows are turns of
their own; a null role or text is empty; an empty table has no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitegrain.llm.common import WORD, stored, whole_text

DIGITS = 32  # hex digits of a turn's digest
SAMPLES = 16  # sampled paths for each shard
SPLITTER_TURNS = 4096
HEAD_OF, HEADS = 20, 4  # a conversation's head comes from the last one divisible by 20, and has less than 4 turns
IDS_AT_ONCE = 10_000
BLANK = hashlib.sha256(b"").hexdigest()
SWEPT = (
    "shard int, skeleton int, parent int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, ends_sha256 string, ids string, chunk long"
)
NAMES = [c.split()[0] for c in SWEPT.split(", ")]


def turns(conversations: DataFrame) -> DataFrame:
    """Each conversation as the array ``turns`` of (turn, digest, words) in order."""
    role, text = whole_text("role"), whole_text("text")
    return (
        conversations.where("conv_id is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.struct(
                F.col("turn").cast("long").alias("turn"),
                F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGITS).alias("digest"),
                F.regexp_count(text, F.lit(WORD)).alias("words"),
            ).alias("turn"),
        )
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """The head of a conversation comes from its base: conv_id, path (joined digests), words (an array)."""
    base = F.col("conv_id") - F.col("conv_id") % HEAD_OF
    heads = own.where(F.col("conv_id") % HEAD_OF == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    length = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    joined = own.withColumn("base", base).withColumn("length", length).join(heads, "base", "left")
    whole = F.concat(
        F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("length")),
        F.slice("turns", F.col("length") + 1, F.size("turns")),
    )
    return joined.select("conv_id", whole.alias("turns")).select(
        "conv_id", F.array_join("turns.digest", "").alias("path"), F.col("turns.words").alias("words")
    )


# The skeleton


@dataclass
class Skeleton:
    """The trie of the splitters' paths; nodes are numbered in preorder, the root is 0."""

    splitters: list[tuple[str, int]]
    child: dict[tuple[int, str], int] = field(default_factory=dict)
    rows: list[list[int]] = field(default_factory=lambda: [[0, -1, 0, 0]])  # number, parent, depth, last number below

    def __post_init__(self):
        for path, _ in self.splitters:
            at, way = 0, [0]
            for i in range(0, len(path), DIGITS):
                key = (at, path[i:i + DIGITS])
                if key not in self.child:
                    self.child[key] = len(self.rows)
                    self.rows.append([len(self.rows), at, len(way), 0])
                at = self.child[key]
                way.append(at)
            for node in way:
                self.rows[node][3] = len(self.rows) - 1


def skeleton(paths: DataFrame, shards: int) -> Skeleton:
    """Splitters of about equal ranges, from a sample drawn by a hash of ``conv_id``."""
    scale = 1 << 30
    wanted = min(scale, SAMPLES * shards * scale // max(1, paths.count()))
    sample = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(scale)) < wanted).select(
        F.substring("path", 1, SPLITTER_TURNS * DIGITS).alias("path"),
        F.when(F.length("path") <= SPLITTER_TURNS * DIGITS, F.col("conv_id")).otherwise(-(1 << 63)).alias("conv_id"),
    )
    order = Window.orderBy("path", "conv_id")
    ranges = sample.select("path", "conv_id", F.ntile(shards).over(order).alias("range"))
    first = ranges.groupBy("range").agg(F.min(F.struct("path", "conv_id")).alias("key")).where("range > 1")
    return Skeleton(sorted({(r["key"]["path"], r["key"]["conv_id"]) for r in first.collect()}))


# A shard


class Node:
    """An open node of the sweep."""

    __slots__ = ("conv_id", "children", "convs", "done", "ends", "ids", "leaves", "saved", "skeleton", "words")

    def __init__(self, words: int, skeleton: int):
        self.words, self.skeleton = words, skeleton
        self.convs = self.children = self.leaves = self.saved = 0
        self.conv_id: int | None = None
        self.ends = None  # the hash so far of those who end here
        self.ids: list[int] = []  # of those, where the hash is taken later
        self.done: list[tuple] = []  # finished children that wait for this node's conv_id

    def member(self, conv_id: int, convs: int = 1) -> None:
        self.convs += convs
        self.conv_id = conv_id if self.conv_id is None or conv_id < self.conv_id else self.conv_id


class Sweep:
    """Rows of one shard in order go in, rows of ``SWEPT`` come out in ``rows``."""

    def __init__(self, child: dict[tuple[int, str], int], shard: int):
        self.child, self.shard, self.path, self.rows, self.chunk = child, shard, "", [], 0
        self.open = [Node(0, 0)]

    def add(self, path: str, conv_id: int, words) -> None:
        depth, most = 0, min(len(path), len(self.path))
        if path.startswith(self.path):
            depth = most
        else:
            while path[depth:depth + DIGITS] == self.path[depth:depth + DIGITS]:
                depth += DIGITS
        self.close(depth // DIGITS)
        for i in range(depth, len(path), DIGITS):
            above = self.open[-1].skeleton
            known = self.child.get((above, path[i:i + DIGITS]), -1) if above >= 0 else -1
            self.open.append(Node(int(words[i // DIGITS]), known))
        self.path = path
        end = self.open[-1]
        end.member(conv_id)
        if end.skeleton >= 0:
            end.ids.append(conv_id)
            if len(end.ids) >= IDS_AT_ONCE:
                self.put_ids(end)
        elif end.ends is None:
            end.ends = hashlib.sha256(str(conv_id).encode())
        else:
            end.ends.update(f",{conv_id}".encode())

    def close(self, depth: int) -> None:
        """Close the open nodes deeper than ``depth``."""
        while len(self.open) - 1 > depth:
            node = self.open.pop()
            self.finish(node, self.open[-1], len(self.open))

    def finish(self, node: Node, above: Node | None, depth: int) -> None:
        if node.skeleton < 0:
            node.leaves += not node.children
            node.saved += (node.convs - 1) * node.words
        for row in node.done:
            self.put(row, node.conv_id, None)
        if above is not None:
            above.member(node.conv_id, node.convs)
        if node.skeleton >= 0:
            # What lies below in the skeleton itself is added when the partials are reduced.
            self.put_ids(node)
            self.rows.append((
                self.shard, node.skeleton, None, node.conv_id, depth, None, node.convs, node.children, node.leaves, node.saved,
                node.words, None, None, None,
            ))
            return
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        ends = node.ends.hexdigest() if node.ends else BLANK
        row = (node.conv_id, depth, node.convs, node.children, node.leaves, node.saved, ends)
        if above.skeleton >= 0:
            self.put(row, None, above.skeleton)
        else:
            above.done.append(row)

    def put(self, row: tuple, parent_conv_id: int | None, parent: int | None) -> None:
        conv_id, depth, convs, children, leaves, saved, ends = row
        self.rows.append((
            self.shard, None, parent, conv_id, depth, parent_conv_id, convs, children, leaves, saved, None, ends, None, None,
        ))

    def put_ids(self, node: Node) -> None:
        if node.ids:
            self.rows.append((self.shard, node.skeleton, *[None] * 10, ",".join(map(str, node.ids)), self.chunk))
            self.chunk += 1
            node.ids = []

    def end(self) -> None:
        self.close(0)
        self.finish(self.open.pop(), None, 0)


def sweep(batches: Iterator[pd.DataFrame], child: dict[tuple[int, str], int]) -> Iterator[pd.DataFrame]:
    now = None
    for batch in batches:
        for shard, path, conv_id, words in zip(batch["shard"], batch["path"], batch["conv_id"], batch["words"], strict=True):
            if now is None or now.shard != shard:
                if now is not None:
                    now.end()
                    yield pd.DataFrame(now.rows, columns=NAMES, dtype=object)
                now = Sweep(child, shard)
            now.add(path, conv_id, words)
            if len(now.rows) >= 10_000:
                yield pd.DataFrame(now.rows, columns=NAMES, dtype=object)
                now.rows = []
    if now is not None:
        now.end()
        yield pd.DataFrame(now.rows, columns=NAMES, dtype=object)


def _hash_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash for each skeleton node over its sorted chunks of identifiers."""
    now, digest = None, None
    for batch in batches:
        for node, ids in zip(batch["skeleton"], batch["ids"], strict=True):
            if node == now:
                digest.update(f",{ids}".encode())
                continue
            if now is not None:
                yield pd.DataFrame({"skeleton": [now], "ends_sha256": [digest.hexdigest()]})
            now, digest = node, hashlib.sha256(ids.encode())
    if now is not None:
        yield pd.DataFrame({"skeleton": [now], "ends_sha256": [digest.hexdigest()]})


def skeleton_nodes(spark: SparkSession, tree: Skeleton, swept: DataFrame) -> DataFrame:
    """Reduce the shards' partials to finished rows of the skeleton's nodes, with ``skeleton``."""
    partial = swept.where("skeleton is not null and ids is null").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("words").alias("words"),
    )
    ids = swept.where("ids is not null").select("skeleton", "shard", "chunk", "ids")
    ends = ids.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "chunk").mapInPandas(_hash_ids, "skeleton int, ends_sha256 string")
    shape = spark.createDataFrame([tuple(r) for r in tree.rows], "skeleton int, parent int, depth long, last int")
    below = shape.groupBy(F.col("parent").alias("skeleton")).agg(F.count(F.lit(1)).alias("below"))
    nodes = (
        shape.join(partial, "skeleton").join(below, "skeleton", "left").join(ends, "skeleton", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("below", F.lit(0)))
        .withColumn("leaf_here", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn("saved_here", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    )
    # Of the skeleton's rows only, whose number does not grow with the input.
    upto = Window.orderBy("skeleton").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nodes = stored(
        spark,
        nodes.withColumn("leaves_upto", F.sum("leaf_here").over(upto)).withColumn("saved_upto", F.sum("saved_here").over(upto)),
        "trie-skeleton",
    )
    last = nodes.select(F.col("skeleton").alias("last"), F.col("leaves_upto").alias("leaves_last"), F.col("saved_upto").alias("saved_last"))
    above = nodes.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(last, "last").join(above, "parent", "left").select(
        "skeleton", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves_last") - F.col("leaves_upto") + F.col("leaf_here")).alias("n_leaves"),
        (F.col("saved_last") - F.col("saved_upto") + F.col("saved_here")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(BLANK)).alias("ends_sha256"),
    )


def prefix_trie(spark: SparkSession, paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id, path, words): conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    paths = stored(spark, paths, "trie-paths")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tree = skeleton(paths, shards)
    sent = spark.sparkContext.broadcast((tree.splitters, tree.child))

    @F.pandas_udf("int")
    def shard(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(sent.value[0], key) for key in zip(path, conv_id, strict=True)], dtype="int32")

    dealt = paths.withColumn("shard", shard("path", "conv_id")).repartitionById(len(tree.splitters) + 1, F.col("shard"))
    swept = stored(
        spark,
        dealt.sortWithinPartitions("shard", "path", "conv_id").mapInPandas(lambda batches: sweep(batches, sent.value[1]), SWEPT),
        "trie-swept",
    )
    top = stored(spark, skeleton_nodes(spark, tree, swept), "trie-top")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    below = swept.where("skeleton is null").join(
        F.broadcast(top.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("above"))), "parent", "left"
    ).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return below.select(*columns).unionByName(top.select(*columns))


def conversation_trie(spark: SparkSession, conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The prefix trie of the rebuilt conversations."""
    return prefix_trie(spark, rebuilt(turns(conversations)), shards)
