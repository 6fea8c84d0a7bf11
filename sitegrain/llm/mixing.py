"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, shuffled by a hash, form a line of words that is cut into blocks of
equal size. Slot ``k`` of the schedule takes the golden-ratio point ``frac((k + 1/2) * phi)``;
the point falls into one source's stretch of the cumulative targets, and the slot's rank among
the slots of that source says which block it takes. After the last block a source starts anew,
up to three times. Since the points' discrepancy is a few slots, so is the distance of every
prefix of the schedule from the targets; a few closing slots then make each source whole.

Defined results: a null text has size 0; a null source is a source of its own, the last one;
documents of size 0 are listed with 0 words taken; repeated rows are documents of their own;
where all texts are empty all targets are 0; an empty table gives an empty result; other columns
are not read. The same table gives the same mix on every run; documents with equal ``doc_id`` and
size may change places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitegrain.llm.common import WORD, prefix_digits, running_start, stored, whole_text

WEIGHTS = (5, 2, 1)  # by the sources' order, repeating
EPOCHS = 3  # a source is read so often at most
LARGEST_BLOCK = 2048
SLOTS_PER_SOURCE = 4096
GOLDEN = 0.6180339887498949
SLOT_BITS = 14  # slots are ranked in stretches of 2**SLOT_BITS
CELLS = 4096


def sized(docs: DataFrame, uid: Column | None = None) -> DataFrame:
    """Narrow rows: uid, doc_id, source key (sorts by code point, null last), size, shuffle key.

    A ``uid`` made here holds only once the rows are stored.
    """
    return docs.select(
        (F.monotonically_increasing_id() if uid is None else uid).alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1")).alias("source"),
        F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("shuffle"),
    )


def source_targets(rows: DataFrame) -> DataFrame:
    """One row per source: source_size, target, and ``words``, the target in whole words.

    Sources are filled in the order in which they would overflow; once one does not, all later
    ones share what is left by weight.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(rank - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "source")
    everything = Window.partitionBy()
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    return (
        sums.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * EPOCHS)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("left", F.col("all_words") - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("shares", F.sum("weight").over(after))
        .withColumn("place", F.row_number().over(by_limit))
        .withColumn("fits", F.col("limit") * F.col("shares") >= F.col("left") * F.col("weight"))
        .withColumn("rest", F.min(F.when(F.col("fits"), F.struct("place", "left", "shares"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("place") < F.col("rest.place"), F.col("limit").cast("double"))
            .otherwise((F.col("weight") * F.col("rest.left")).cast("double") / F.col("rest.shares")),
        )
        .withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
        .select("source", "source_size", "target", "words")
    )


def block_words(targets: DataFrame) -> tuple[int, int, int]:
    """Words of a block, of all targets, and the number of sources that take part.

    A source has some thousand slots, so that a slot more or less does not count; blocks hold
    ``LARGEST_BLOCK`` words at most.
    """
    total, sources = targets.where("words > 0").agg(F.coalesce(F.sum("words"), F.lit(0)), F.count(F.lit(1))).first()
    return max(1, min(LARGEST_BLOCK, total // max(1, sources * SLOTS_PER_SOURCE))), total, sources


def schedule(spark: SparkSession, targets: DataFrame) -> DataFrame:
    """The slots: position in the mix, source, rank within it, block, and words it takes.

    ``targets`` is a stored table of ``source_targets``.
    """
    live = targets.where("words > 0")
    block, total, sources = block_words(targets)
    slots = -(-total // block)
    cells = max(CELLS, 4 * sources)

    # Each source's stretch of [0, 1), listed under every cell it touches, so that points find it by equality.
    upto = F.sum("words").over(Window.orderBy("source"))
    stretch = live.select(
        "*", ((upto - F.col("words")) / F.lit(float(total or 1))).alias("low"), (upto / F.lit(float(total or 1))).alias("high")
    ).withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1).cast("long"))))
    )
    point = (F.col("slot") + 0.5) * GOLDEN
    points = (
        spark.range(slots).withColumnRenamed("id", "slot")
        .withColumn("point", point - F.floor(point))
        .withColumn("cell", F.floor(F.col("point") * cells))
    )
    hits = points.join(
        stretch.select("cell", "source", "low", "high"), "cell"
    ).where("point >= low and point < high").select("slot", "source")
    spans = hits.withColumn("span", F.shiftright("slot", SLOT_BITS))
    ranked = stored(
        spark, running_start(spans, "source", "span", ["slot"], F.lit(1), "rank").select("slot", "source", "rank"), "mixing-slots"
    )

    # What a source needs: whole rounds of its blocks, and a last part of one.
    needed = live.select(
        "source", "source_size", "words",
        F.ceil(F.col("source_size") / block).cast("long").alias("blocks"),
    ).withColumn(
        "ranks",
        F.floor(F.col("words") / F.col("source_size")) * F.col("blocks")
        + F.ceil(F.pmod(F.col("words"), F.col("source_size")) / block),
    )
    given = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("given"))
    closing = (
        needed.join(given, "source", "left").withColumn("given", F.coalesce("given", F.lit(0)))
        .where("given < ranks")
        .select("source", F.explode(F.sequence("given", F.col("ranks") - 1)).alias("rank"))
        .withColumn("slot", F.lit(slots) + F.col("rank"))
    )
    filled = ranked.unionByName(closing).join(needed, "source").where("rank < ranks")
    first = F.col("block") * block
    before = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + first
    return (
        filled.withColumn("block", F.pmod("rank", "blocks"))
        .withColumn("take", F.least(F.lit(block), F.col("source_size") - first, F.col("words") - before))
        .select("slot", "source", "rank", "block", first.alias("first"), "take")
    )


def mix(spark: SparkSession, rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The mix: which words of which document each slot takes (slot, uid, from_word, words).

    ``rows`` and ``targets`` are stored tables of ``sized`` and ``source_targets``.
    """
    slots = schedule(spark, targets)
    digits = prefix_digits(rows.count())
    line = running_start(
        rows.where("size > 0").withColumn("bucket", F.substring("shuffle", 1, digits)),
        "source", "bucket", ["shuffle", "size", "uid"], F.col("size"), "start",
    )
    block, _, _ = block_words(targets)
    pieces = line.select(
        "uid", "source", "size", "start",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"),
    )
    low = F.greatest("start", "first")
    high = F.least(F.col("start") + F.col("size"), F.col("first") + F.col("take"))
    return (
        slots.join(pieces, ["source", "block"])
        .select("slot", "uid", (low - F.col("start")).alias("from_word"), (high - low).alias("words"))
        .where("words > 0")
    )


def mix_sources(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (and ``uid`` of ``sized``)."""
    return taken_words(spark, stored(spark, sized(docs), "mixing-rows"))


def taken_words(spark: SparkSession, rows: DataFrame) -> DataFrame:
    targets = stored(spark, source_targets(rows), "mixing-targets")
    taken = mix(spark, rows, targets).groupBy("uid").agg(F.sum("words").alias("taken"))
    return (
        rows.join(targets.select("source", "source_size", "target"), "source")
        .join(taken, "uid", "left")
        .select("uid", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def apply_mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` as mixed: a row for each round in which a document is read, none where it never is.

    Where a source's target ends inside a document, that round holds only its first words.
    ``n_chars``, where there is such a column, follows the text. Columns stay as they are.
    """
    held = stored(spark, docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("uid")), "mixing-docs")
    rows = stored(spark, sized(held.select("doc.doc_id", "doc.source", "doc.text", "uid"), F.col("uid")), "mixing-rows")
    taken = taken_words(spark, rows).where("taken > 0").select("uid", "size", "taken")
    rounds = held.join(taken, "uid").withColumn(
        "round", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size"))))
    )
    words = F.least(F.col("size"), F.col("taken") - (F.col("round") - 1) * F.col("size"))
    text = F.col("doc.text")
    head = F.array_join(
        F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), words.cast("int")), ""
    )
    cut = F.when(words < F.col("size"), head).otherwise(text)
    doc = F.col("doc").withField("text", cut)
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length(cut).cast(docs.schema["n_chars"].dataType))
    return rounds.select(doc.alias("doc")).select("doc.*")
