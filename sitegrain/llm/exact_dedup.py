"""Exact deduplication as a stateful stream.

Rows become a narrow stream of digest, identifier and locator. A streaming aggregation with
RocksDB state that never expires keeps, for each digest, the row that stays and the number of
rows seen; the state is then read as a table, and decides. Digests seen more than once are hits:
their texts are compared byte by byte, and only where one digest has several texts these are told
apart by their bytes.

Defined results: a null text is an empty one; a null ``doc_id`` counts as smaller than any other;
of rows that share text and ``doc_id`` (repeated rows) every one reports the same decision, and
``drop_copies`` leaves one of them; an empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import keep_rows, settings, stored, whole_text
from sitegrain.session import work_dir

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # Else every partition's store reserves some megabytes of disk before it holds a row.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha_key(sha: Column) -> Column:
    """The key of the state: the whole digest."""
    return sha


def narrow_rows(docs: DataFrame, locator: Column | None = None) -> DataFrame:
    """What the stream carries of each document: SHA-256, identifier, and where its content lies."""
    text = whole_text()
    return docs.select(
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(
            (F.input_file_name() if locator is None else locator).alias("file"),
            F.octet_length(text).cast("long").alias("bytes"),
        ).alias("locator"),
    )


def digest_state(
    spark: SparkSession, source: str, schema, checkpoint: str, key: Callable[[Column], Column] = sha_key,
    bytes_per_batch: int = 1 << 36, files_per_batch: int | None = None,
) -> DataFrame:
    """Run the stream over what lies in ``source`` and return its state: key, keeper, rows.

    ``checkpoint`` holds the state on disk. A later call with the same folder resumes where the
    last one ended and takes only files that came since. ``bytes_per_batch`` and
    ``files_per_batch`` bound a micro-batch.
    """
    reader = spark.readStream.schema(schema)
    # Spark takes one of the two limits.
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    state = (
        reader.parquet(source)
        .groupBy(key(F.col("sha")).alias("key"))
        .agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("rows"))
    )
    with settings(spark, ROCKSDB):
        query = (
            state.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        # The state's value holds the aggregates in their order.
        table = spark.read.format("statestore").load(checkpoint)
        (name,) = table.schema["key"].dataType.names
        keeper, rows = table.schema["value"].dataType.names
        return stored(
            spark,
            table.select(
                F.col(f"key.`{name}`").alias("key"),
                F.col(f"value.`{keeper}`").alias("keeper"),
                F.col(f"value.`{rows}`").alias("rows"),
            ),
            "dedup-state",
        )


def exact_dedup(
    spark: SparkSession, docs: DataFrame, key: Callable[[Column], Column] = sha_key,
    locator: Column | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest ``doc_id`` stays.
    """
    source = work_dir(spark, "dedup-rows")
    narrow_rows(docs, locator).write.parquet(source)
    schema = narrow_rows(docs, locator).schema
    rows = spark.read.schema(schema).parquet(source).withColumn("key", key(F.col("sha")))
    state = digest_state(spark, source, schema, work_dir(spark, "dedup-stream"), key, files_per_batch=files_per_batch)

    groups = stored(
        spark, state.where("rows > 1").select("key", F.col("keeper.doc_id").alias("keep_id"), F.col("rows").alias("group_size")), "dedup-groups"
    )
    # Hits: every byte counts. Copies combine before the shuffle, so a hot text is a row for each task.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn(
        "key", key(F.unhex(F.sha2("text", 256)))
    )
    classes = texts.join(state.where("rows > 1").select("key"), "key", "left_semi").groupBy("key", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    clashes = stored(spark, classes.groupBy("key").count().where("count > 1").select("key"), "dedup-clashes")
    columns = [
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.coalesce("keep_id", "doc_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    ]
    if clashes.isEmpty():
        return rows.join(groups, "key", "left").select(*columns)
    # One digest, several texts: these few rows are matched by their whole text.
    clear = rows.join(clashes, "key", "left_anti").join(groups, "key", "left")
    apart = texts.join(clashes, "key", "left_semi").join(classes, ["key", "text"]).withColumn("sha", F.unhex(F.sha2("text", 256)))
    return clear.select(*columns).unionByName(apart.select(*columns))


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the copies: of equal texts one row stays, that with the largest ``doc_id``."""
    return keep_rows(docs, exact_dedup(spark, docs).where("kept").select("doc_id", F.unhex("text_sha256")))
