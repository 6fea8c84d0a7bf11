"""Entity tables as plain Parquet, partitioned by a bucket of the key.

A batch is merged with the buckets its keys fall into and replaces them by dynamic partition
overwrite; other buckets are not read. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name)


@dataclass(frozen=True)
class Table:
    path: str
    schema: T.StructType
    key: str
    buckets: int = 64

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, buckets: Iterable[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        if not exists(spark, self.path):
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(T.StructType([*self.schema.fields]).add("bucket", "integer")).parquet(self.path)
        rows = rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))
        return rows.where(F.col(self.key).isNotNull()).select(*self.schema.fieldNames())

    def touched(self, *keys: DataFrame) -> list[int]:
        """The buckets that hold these keys: never more than there are buckets."""
        ids = [k.select(self.bucket(F.col(k.columns[0])).alias("b")) for k in keys]
        return sorted(r.b for r in reduce(DataFrame.unionAll, ids).distinct().collect())

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """With its bucket; Spark splits a large one into several files."""
        out = rows.select(*self.schema.fieldNames()).withColumn("bucket", self.bucket(F.col(self.key)))
        return out.hint("rebalance", F.col("bucket"))

    def replace(self, rows: DataFrame, buckets: Iterable[int]) -> None:
        """Put ``rows`` in the place of the given buckets. A row without a key stands for a bucket that may be empty."""
        spark = rows.sparkSession
        marks = spark.createDataFrame([(b,) for b in buckets], "bucket int")
        out = self._dealt(rows).unionByName(marks, allowMissingColumns=True)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        self._dealt(rows).write.mode("append").partitionBy("bucket").parquet(self.path)
