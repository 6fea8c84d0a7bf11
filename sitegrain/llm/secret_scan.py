"""Secrets: fixed patterns, and character Markov models for strings that no pattern names.

Two first-order models over printable ASCII are trained from labelled strings: random ones (all
values that the fixed patterns confirm) and ordinary identifiers (all words of the texts). A
candidate's mean log-likelihood ratio per transition says which of the two it looks like; the
threshold is calibrated on the part of them that was not trained on. All of it is built-in
column expressions; a model is a table of at most 94 x 94 numbers.

Defined results: a null text is empty; repeated rows are scanned one by one; a text without
matches gives zeros and empty strings (the SHA-256 of the empty string); an empty table gives an
empty result; where there are no samples only the fixed patterns count; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import stored, whole_text
from sitegrain.llm.spans import apart_from, located, matches, report

# Kinds and patterns of the base. The shortest lengths are part of the patterns:
# a shorter run is dropped whole, so leaving it out changes no other match.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
SHORTEST_VALUE = 6
# Candidates of the models: runs of key-like characters, starting where such a run starts.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
LETTERS = 94  # printable ASCII without the blank
FIRST = 33


def base_matches() -> list[Column]:
    text = F.col("text")
    return [
        matches(0, F.lit(True), ASSIGN),
        matches(1, F.contains(text, F.lit("AKIA")), ACCESS),
        matches(2, F.lit(True), HEX),
    ]


def confirmed(kind: Column, value: Column) -> Column:
    """Whether a match of a fixed pattern counts."""
    return F.when(kind == 0, F.length(F.regexp_extract(value, ASSIGN, 1)) >= SHORTEST_VALUE).otherwise(kind < 3)


def transitions(value: Column) -> Column:
    """Codes 1 .. 94*94 of the neighbouring characters of a printable ASCII string."""
    at = lambda i: F.ascii(F.substring(value, i, F.lit(1))) - FIRST
    return F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: at(i) * LETTERS + at(i + 1) + 1)


def generated() -> Column:
    """Renderings of SHA-256 digests of counters ``id``: hexadecimal, Base64 and upper-case letters and digits."""
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    base64 = F.base64(F.unhex(digest))
    return F.array(
        F.substring(digest, 1, 32), F.substring(base64, 1, 32),
        F.upper(F.substring(F.regexp_replace(base64, "[^A-Za-z0-9]", ""), 1, 20)),
    )


def labelled_strings(spark: SparkSession, docs: DataFrame, rows: DataFrame, renderings: int) -> DataFrame:
    """Labelled strings, each once: value, random (0/1), held_out. A fourth is held out.

    Random: every value that a fixed pattern confirms, and about ``renderings`` renderings of digests.
    Ordinary: the words and hyphened or slashed identifiers of all documents.
    """
    value = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 1)).otherwise(F.col("value"))
    secret = rows.where(confirmed(F.col("kind"), F.col("value"))).select(value.alias("value"))
    random = secret.unionByName(spark.range(max(1, renderings // 3)).select(F.explode(generated()).alias("value")))
    words = docs.select(F.explode(F.regexp_extract_all(whole_text(), F.lit(r"(?<![!-~])[A-Za-z][A-Za-z_/-]{5,}+"), F.lit(0))).alias("value"))
    both = random.distinct().withColumn("random", F.lit(1)).unionByName(words.distinct().withColumn("random", F.lit(0)))
    return both.where(F.length("value") >= 6).withColumn("held_out", F.pmod(F.xxhash64("value", F.lit(7)), F.lit(4)) == 0)


def markov_weights(samples: DataFrame) -> list[float]:
    """For each pair of characters the log ratio of its probabilities given the first one, in 0.01 steps."""
    counts = (
        samples.where("not held_out").select("random", F.explode(transitions(F.col("value"))).alias("code"))
        .groupBy("random", "code").count()
    )
    seen = [[0] * (LETTERS * LETTERS) for _ in range(2)]
    for label, code, n in counts.collect():  # 2 x 94 x 94 rows at most
        if 1 <= code <= LETTERS * LETTERS:
            seen[label][code - 1] = n
    weights = []
    for a in range(LETTERS):
        ordinary, random = (row[a * LETTERS:(a + 1) * LETTERS] for row in seen)
        of = [math.log(sum(row) + 0.5 * LETTERS) for row in (ordinary, random)]
        weights += [
            round(math.log(r + 0.5) - of[1] - math.log(o + 0.5) + of[0], 2) for o, r in zip(ordinary, random, strict=True)
        ]
    return weights


def likelihood_ratio(value: Column, weights: list[float]) -> Column:
    """The mean log-likelihood ratio of a string's transitions."""
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")
    codes = transitions(value)
    total = F.aggregate(codes, F.lit(0.0), lambda sum_, code: sum_ + F.element_at(table, code))
    return total / F.greatest(F.size(codes), F.lit(1))


def calibrated(samples: DataFrame, weights: list[float], false_share: float) -> float:
    """The least ratio, in thousandths, that at most ``false_share`` of the held-out ordinary strings exceed; never below zero.

    Counted in thousandths, so the driver gets a row for each that occurs, whatever the input.
    """
    held = samples.where("held_out and random = 0").where(F.length("value") >= 12)
    place = F.ceil(likelihood_ratio(F.col("value"), weights) * 1000)
    bins = sorted(tuple(r) for r in held.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect())
    above = total = sum(n for _, n in bins)
    for at, n in bins:
        above -= n
        if above <= false_share * total:
            return max(0.0, at / 1000)
    return 0.0


def scan_secrets(
    spark: SparkSession, docs: DataFrame, renderings: int = 5_000, false_share: float = 0.001,
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    The models are fitted on all values and words (see ``labelled_strings``). A candidate that overlaps a span of the base
    adds nothing; any other one counts as ``random`` if its ratio passes the calibrated threshold
    and it mixes digits with letters.
    """
    rows = stored(spark, located(docs, [*base_matches(), matches(3, F.lit(True), CANDIDATE)]), "secret-matches")
    samples = stored(spark, labelled_strings(spark, docs, rows, renderings), "secret-samples")
    weights = markov_weights(samples)
    threshold = calibrated(samples, weights, false_share)

    base = confirmed(F.col("kind"), F.col("value")) & (F.col("kind") < 3)
    looks = F.rlike("value", F.lit("[0-9]")) & F.rlike("value", F.lit("[A-Za-z]"))
    random = (F.col("kind") == 3) & looks & (likelihood_ratio(F.col("value"), weights) > threshold)
    marked = apart_from(rows.repartition("uid"), base)
    return report(marked, base | (random & F.col("free")), KINDS, 3, ("start", "kind"))
