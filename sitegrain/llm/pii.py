"""Personal data: fixed patterns, and boosted trees over loose candidates.

High-recall generators propose spans that may overlap (the fixed patterns, spelled-out or spaced
e-mail addresses, and any run of digits with separators). Gradient-boosted trees score a candidate
by its format and its context. Labels come from the fixed patterns: their confirmed spans, and
rewritings of these in the same context (``at`` and ``dot`` spelled out, other separators, no
plus sign), are positive; candidates that overlap no confirmed span are negative. A threshold for
each generator is calibrated on held-out candidates. Spans of the base always stay; a candidate
that passes its threshold and overlaps none of them is added.

All steps are DataFrame operations and Spark ML. The trees are fitted on every labelled candidate
that is not held out, the thresholds are counted over every one that is, and scoring covers all.
(Where a feature has more values than bins, Spark ML's trees choose the bins' borders from 10,000
kinds of candidates; what falls between the borders is counted over all.)

Defined results: a null text is empty; repeated rows are scanned one by one; a text without spans
gives zeros and empty strings; an empty table gives an empty result; where a label
is missing nothing is added to the base; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import stored
from sitegrain.llm.spans import apart_from, located, matches, report

# Kinds and patterns of the base. Possessive groups and the tests before them change
# no match; they keep long runs of letters or digits from being tried again at every place.
KINDS = ("email", "ip", "card", "phone", "email_like", "number_like")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"  # shorter runs fail whole, so they are not matched
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Generators of candidates.
EMAIL_LIKE = (
    r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?@\x20?|\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]++"
    r"(?:(?:\x20?\.\x20?|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]++){1,8}+"
)
NUMBER_LIKE = r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().,/-]{0,2}[0-9]){5,}+"
CONTEXT = 24
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CUES = ("phone", "tel", "call", "fax", "mobile", "mail", "contact", "card", "visa", "account", "ssn", "ip", "host", "address")
FEATURES = (
    "length", "digits", "letters", "separators", "dots", "blanks", "hyphens", "at_signs", "plus", "parenthesis", "groups",
    "longest_group", "distinct_digits", "slashes", "glued_before", "glued_after", "cue_before", "colon_before", "money",
)


def all_matches() -> list[Column]:
    text = F.col("text")
    digit = F.rlike(text, F.lit("[0-9]"))
    at = F.contains(text, F.lit("@"))
    return [
        matches(0, at, EMAIL, CONTEXT),
        matches(1, digit, IP, CONTEXT),
        matches(2, digit, CARD, CONTEXT),
        matches(3, F.contains(text, F.lit("+")), PHONE, CONTEXT),
        matches(4, at | F.rlike(text, F.lit(r"(?i)[(\[]at[)\]]|\x20at\x20")), EMAIL_LIKE, CONTEXT),
        matches(5, digit, NUMBER_LIKE, CONTEXT),
    ]


def luhn(digits: Column) -> Column:
    """Whether a string of 13 to 19 digits passes the Luhn test."""
    def weight(i: int) -> Column:  # i-th digit from the right, none: 0
        d = F.coalesce(F.substring(F.reverse(digits), i + 1, 1).try_cast("int"), F.lit(0))
        return d if i % 2 == 0 else F.when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.pmod(reduce(lambda a, b: a + b, (weight(i) for i in range(19))), F.lit(10)) == 0


def confirmed(kind: Column, value: Column) -> Column:
    """Whether a match of a fixed pattern counts."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.length(digits)
    return (
        F.when(kind == 0, True)
        .when(kind == 1, F.rlike(value, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$")))
        .when(kind == 2, count.between(13, 19) & luhn(digits))
        .when(kind == 3, count.between(9, 15))
        .otherwise(False)
    )


def features(rows: DataFrame) -> DataFrame:
    """Format and context of each candidate (``value``, ``before``, ``after``), as numbers."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")

    def count(characters: str) -> Column:
        return (F.length(value) - F.length(F.regexp_replace(value, f"[{characters}]", ""))).cast("double")

    groups = F.split(F.regexp_replace(value, "^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", ""), "[^0-9A-Za-z]+", -1)
    columns = {
        "length": F.length(value).cast("double"),
        "digits": count("0-9"), "letters": count("A-Za-z"), "separators": count(r"\x20().,/\-"), "dots": count("."),
        "blanks": count(r"\x20"), "hyphens": count(r"\-"), "at_signs": count("@"), "plus": count("+"), "parenthesis": count("()"),
        "slashes": count("/"),
        "groups": F.size(groups).cast("double"),
        "longest_group": F.array_max(F.transform(groups, lambda g: F.length(g))).cast("double"),
        "distinct_digits": F.size(F.array_distinct(F.split(F.regexp_replace(value, "[^0-9]", ""), ""))).cast("double"),
        "glued_before": F.rlike(before, F.lit(r"[^\x20\x09-\x0D]$")).cast("double"),
        "glued_after": F.rlike(after, F.lit(r"^[A-Za-z0-9]")).cast("double"),
        "cue_before": F.rlike(before, F.lit(rf"(?i)\b(?:{'|'.join(CUES)})\b")).cast("double"),
        "colon_before": F.rlike(before, F.lit(r"[:=]\x20?$")).cast("double"),
        "money": F.rlike(before, F.lit(r"[$€£]\x20?$")).cast("double"),
    }
    return rows.withColumns({name: F.coalesce(columns[name], F.lit(0.0)) for name in FEATURES})


def rewritten(kind: Column, value: Column) -> Column:
    """A confirmed value and other ways to write it."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    spelled = F.regexp_replace(F.regexp_replace(value, "@", " at "), r"\.", " dot ")
    bracketed = F.regexp_replace(F.regexp_replace(value, "@", " (at) "), r"\.", " (dot) ")
    grouped = lambda sep: F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{sep}")
    return (
        F.when(kind == 0, F.array(value, spelled, bracketed))
        .when(kind == 2, F.array(value, grouped(" "), grouped("-"), grouped(".")))
        .when(kind == 3, F.array(value, F.regexp_replace(value, r"^\+", ""), F.regexp_replace(F.regexp_replace(value, "[()]", ""), r"\x20", ".")))
        .otherwise(F.array(value))
    )


def labelled_candidates(marked: DataFrame) -> DataFrame:
    """All labelled candidates: generator, features, label, held_out, and in ``rows`` how many are alike in these.

    Format and context are small numbers, so candidates alike are counted together: fitting costs in
    proportion to the kinds of candidates, and still weighs every one of them.
    """
    usable = marked.where("base or (kind > 3 and free)")
    generator = F.when(F.col("kind").isin(0, 4), 4).otherwise(5)
    varied = usable.select(
        generator.alias("generator"), F.col("base").cast("int").alias("label"), "before", "after",
        (F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(3)) == 0).alias("held_out"),
        F.explode(F.when(F.col("base"), rewritten(F.col("kind"), F.col("value"))).otherwise(F.array("value"))).alias("value"),
    )
    alike = ["generator", "label", "held_out", *FEATURES]
    return features(varied).groupBy(*alike).agg(F.count(F.lit(1)).alias("rows")).sortWithinPartitions(*alike)


def weighted(fitting: DataFrame, totals: dict[int, int]) -> DataFrame:
    """Add ``weight``: both labels weigh the same in all, and a candidate weighs one on average."""
    half = sum(totals.values()) / 2
    share = F.when(F.col("label") == 1, F.lit(half / totals[1])).otherwise(F.lit(half / totals[0]))
    return fitting.withColumn("weight", F.col("rows") * share)


def calibrated(scored: DataFrame, precision: float) -> dict[int, float]:
    """For each generator the lowest score from which held-out candidates reach ``precision``; none: 2.0.

    Scores are taken in hundredths, so at most 101 rows for each generator reach the driver.
    """
    bins = scored.groupBy("generator", F.floor(F.col("score") * 100).alias("bin")).agg(
        F.sum(F.col("label") * F.col("rows")).alias("good"), F.sum("rows").alias("all")
    ).collect()
    out = {}
    for g in (4, 5):
        good = total = 0
        out[g] = 2.0
        for r in sorted((r for r in bins if r["generator"] == g), key=lambda r: -r["bin"]):
            good, total = good + r["good"], total + r["all"]
            # Half a false one is always assumed, so that a few lucky candidates do not count.
            if good / (total + 0.5) >= precision:
                out[g] = r["bin"] / 100
    return out


def scan_pii(
    spark: SparkSession, docs: DataFrame, precision: float = 0.98, trees: int = 10, depth: int = 4,
) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = stored(spark, located(docs, all_matches()), "pii-matches")
    base = F.col("kind").isNotNull() & confirmed(F.col("kind"), F.col("value"))
    marked = stored(spark, apart_from(rows.withColumn("base", F.coalesce(base, F.lit(False))).repartition("uid"), F.col("base")), "pii-marked")
    labelled = stored(spark, labelled_candidates(marked), "pii-labelled")
    fitting = labelled.where("not held_out")
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    chosen = marked.repartition("uid")
    totals = {r["label"]: r["n"] for r in fitting.groupBy("label").agg(F.sum("rows").alias("n")).collect()}
    if len(totals) < 2:
        return report(chosen, F.col("base"), KINDS, 4, ("kind", "start"))

    model = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=5, seed=1
    ).fit(vector.transform(weighted(fitting, totals)).select("vector", "label", "weight"))

    def scored(df: DataFrame) -> DataFrame:
        return model.transform(vector.transform(df)).withColumn("score", vector_to_array("probability")[1])

    limits = calibrated(scored(labelled.where("held_out")).select("generator", "label", "score", "rows"), precision)
    candidates = marked.where("kind > 3 and free")
    added = scored(features(candidates)).where(
        F.col("score") >= F.when(F.col("kind") == 4, F.lit(limits[4])).otherwise(F.lit(limits[5]))
    ).select("uid", "kind", "idx", F.lit(True).alias("added"))
    chosen = marked.join(added, ["uid", "kind", "idx"], "left")
    return report(chosen, F.col("base") | F.coalesce("added", F.lit(False)), KINDS, 4, ("kind", "start"))
