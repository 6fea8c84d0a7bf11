"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text. The ledger holds its measurements and one long whose bit
``i`` is set where rule ``i`` fails. Policies are versioned masks over the bits: a text is kept if
none of a policy's bits is set, so a new policy, and what each rule of it decides alone
(``ablation``), come from the ledger without reading a text again.

Measuring is one pass over Arrow batches; words and windows of one text are in memory at a time.

Defined results: a null text has no words, so it fails ``few_words``; repeated rows are measured
one by one; an empty table gives an empty ledger; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain.llm.common import whole_text

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
WINDOW = 5
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps_words", "n_shouts", "n_distinct_words",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurements; a rule keeps its bit for ever."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 30 * n_words"),
    Rule(3, "repeated_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
    Rule(6, "capitals", "n_words >= 10 and 100 * n_caps_words > 50 * n_words"),
    Rule(7, "shouting", "100 * n_shouts > 30 * n_words"),
    Rule(8, "few_distinct_words", "n_words >= 200 and 100 * n_distinct_words < 5 * n_words"),
)
BASE = ("few_words", "repeated_windows")
# Policies never change; a new choice of rules gets a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": tuple(r.name for r in RULES),
}


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << r.bit for r in RULES if r.name in names)


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # at ASCII blanks only
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    repeated = 0
    windows = Counter(zip(*(words[i:] for i in range(WINDOW)), strict=False)) if n >= WINDOW else {}
    if len(windows) < n - WINDOW + 1:
        covered = 0  # words before this place are counted
        for at, window in enumerate(zip(*(words[i:] for i in range(WINDOW)), strict=False)):
            if windows[window] > 1:
                repeated += at + WINDOW - max(at, covered)
                covered = at + WINDOW
    return (
        n,
        len(text) - sum(map(text.count, SPACE)),
        len(SYMBOL.findall(text)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        sum(map(bytes.isupper, words)),
        text.count("!!"),
        len(set(words)),
    )


def _measure_all(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=list(MEASURES), dtype="int64")


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements, and ``failures``, a bit for each failed rule."""
    measured = F.pandas_udf(_measure_all, ", ".join(f"{m} long" for m in MEASURES))(whole_text())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), measured.alias("m")).select("doc_id", "m.*")
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return rows.withColumn("failures", failures.cast("long"))


def passes(policy: str) -> Column:
    """Whether a ledger row has none of the policy's bits."""
    return F.col("failures").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: texts it fails, texts it alone rejects, and texts kept without it.

    Texts are counted by their bits first, so what is compared are the combinations that occur.
    """
    of = mask(POLICIES[policy])
    combos = rows.groupBy(F.col("failures").bitwiseAND(F.lit(of)).alias("bits")).count()
    rules = [r for r in RULES if r.name in POLICIES[policy]]
    each = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in rules)))
    return (
        combos.withColumn("r", each).groupBy("r.rule", "r.bit")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("rejected_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not("r.bit")) == 0, F.col("count")).otherwise(0)).alias("kept_without"),
        )
        .drop("bit")
    )


def quality(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """One row per document: doc_id, the contract's measurements, failures, base_failed, kept."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures",
        (~passes("base")).alias("base_failed"), (passes("base") & passes(policy)).alias("kept"),
    )
