"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text becomes hashed features: its words, its words cut to stems (so that inflected forms meet),
pairs of neighbouring words, and pairs with one or two words between (skip-grams). FTRL-proximal
learns them one text at a time with a rate for each coordinate; its L1 term leaves few weights
that are not zero, so the model that travels to the tasks is a short list of places and weights.

The model is fitted on about ``max_training_rows`` labelled texts, chosen by a hash of ``doc_id``
among those that are not held out, in one task; scoring covers every text whole.

Defined results: a null or empty text gets the score of the bias alone; labels that are null, or of
unknown documents, are not learnt from, and of several labels of one document the largest counts;
repeated rows are scored one by one; without any label all scores are 0 (nothing is rejected); an empty table gives an empty result; label, language, source and id are no features.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain.llm.common import whole_text
from sitegrain.llm.spans import hash_share

BITS = 20
FOLDS = 5  # a document is held out if crc32 of its id's decimal form leaves no rest
WORDS = re.compile(r"\w+")
STEMS = (5, 7)
SKIPS = (1, 2, 3)  # distance of the pair's words; 1: neighbours
BIAS = 0


@dataclass(frozen=True)
class Settings:
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.5
    epochs: int = 3


class Hasher:
    """Turns texts into places of features; remembers the hashes of words for a while."""

    def __init__(self, bits: int = BITS, remembered: int = 150_000):
        self.mask, self.remembered = np.uint64((1 << bits) - 1), remembered
        self.words: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        if len(self.words) >= self.remembered:
            self.words.clear()
        stems = (word[:n] for n in STEMS)
        self.words[word] = h = (crc32(word.encode()), *(crc32(s.encode(), n) for n, s in zip(STEMS, stems, strict=True)))
        return h

    def places(self, text: str | None) -> np.ndarray:
        """The place of every feature of the text, as often as it stands there."""
        words = WORDS.findall((text or "").lower())
        if not words:
            return np.zeros(0, np.int64)
        known = self.words
        h = np.array([known.get(w) or self._of(w) for w in words], dtype=np.uint64)
        first = h[:, 0]
        parts = [h.ravel()]
        for d in SKIPS:
            parts.append(first[:-d] * np.uint64(0x9E3779B97F4A7C15) + first[d:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(d))
        mixed = np.concatenate(parts)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        place = ((mixed >> np.uint64(20)) & self.mask).astype(np.int64)
        return place[place != BIAS]


def valued(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places with ``log(1 + count)``, and the bias."""
    at, count = np.unique(places, return_counts=True)
    return np.append(at, BIAS), np.append(np.log1p(count, dtype=np.float32), np.float32(1))


def fit(examples: list[tuple[bytes, bytes, int]], settings: Settings = Settings(), bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over ``(places, counts, label)``: the places and weights that are not zero.

    Examples stay packed, as 32-bit places and 16-bit counts, until their turn.
    """
    s = settings
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        l1 = np.where(at == BIAS, 0.0, s.l1)
        w = (np.sign(zi) * l1 - zi) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(s.epochs):
        for places, counts, y in examples:
            at = np.append(np.frombuffer(places, np.uint32).astype(np.int64), BIAS)
            x = np.append(np.log1p(np.frombuffer(counts, np.uint16), dtype=np.float32), np.float32(1))
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    every = np.flatnonzero(n)
    w = weights(every)
    return every[w != 0], w[w != 0].astype(np.float32)


class Model:
    """Weights by place; what is not listed is zero."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, bits: int = BITS):
        self.places, self.weights, self.bits = places, weights, bits

    def scores(self, texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(1 << self.bits, np.float32)
        dense[self.places] = self.weights
        hashed, known = Hasher(self.bits), len(self.places) > 0

        def score(text: str | None) -> float:
            places = hashed.places(text)
            at, x = valued(places[dense[places] != 0])
            return float(1.0 / (1.0 + np.exp(-np.clip(dense[at] @ x, -30, 30))))

        for batch in texts:
            yield pd.Series([score(t) if known else 0.0 for t in batch], dtype="float64")

    def column(self, text: Column) -> Column:
        return F.pandas_udf(self.scores, "double")(text)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, wanted: int) -> DataFrame:
    """About ``wanted`` labelled texts that are not held out: doc_id, text, toxic.

    The labels are chosen before the join, so what is broadcast has about ``wanted`` rows of two numbers.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    chosen = known.where(hash_share(F.col("doc_id"), wanted, known.count()))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashed = Hasher()
    for batch in batches:
        rows = []
        for doc_id, text, toxic in zip(batch["doc_id"], batch["text"], batch["toxic"], strict=True):
            at, count = np.unique(hashed.places(text), return_counts=True)
            rows.append((doc_id, toxic, at.astype(np.uint32).tobytes(), np.minimum(count, 65535).astype(np.uint16).tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "toxic", "places", "counts"])


def train(docs: DataFrame, labels: DataFrame, max_training_rows: int = 10_000, settings: Settings = Settings()) -> Model:
    """Encode the sample where it lies, and learn it in one task, in an order that a hash fixes."""
    encoded = training_rows(docs, labels, max_training_rows).mapInPandas(
        _encode, "doc_id long, toxic int, places binary, counts binary"
    )

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        examples = []
        for batch in batches:
            examples += zip(batch["places"], batch["counts"], batch["toxic"], strict=True)
        place, weight = fit(examples, settings)
        yield pd.DataFrame({"place": place.astype("int64"), "weight": weight.astype("float64")})

    ordered = encoded.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "places")
    rows = ordered.mapInPandas(learn, "place long, weight double").collect()  # at most 2**BITS numbers
    return Model(np.array([r["place"] for r in rows], np.int64), np.array([r["weight"] for r in rows], np.float32))


def score_toxicity(docs: DataFrame, labels: DataFrame, max_training_rows: int = 10_000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, max_training_rows)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), model.column(whole_text()).alias("score")
    ).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_training_rows: int = 10_000) -> DataFrame:
    """``docs`` without the texts that the model calls toxic; all columns stay."""
    return docs.where(train(docs, labels, max_training_rows).column(whole_text()) < 0.5)
