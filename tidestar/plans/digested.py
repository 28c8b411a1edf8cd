"""Versions of a keyed table, laid out by bucket of the key, with the digests of their buckets beside them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.operators.changes import diff_changes
from tidestar.operators.digests import BUCKET, bucket_digests, differing_buckets, key_bucket
from tidestar.storage import folders_with

DIGESTS = T.StructType(
    [
        T.StructField(BUCKET, T.IntegerType()),
        *(T.StructField(c, T.LongType()) for c in ("n_rows", "xored", "summed")),
    ]
)


@dataclass(frozen=True)
class DigestedVersions:
    """Versions side by side under one folder: rows in ``rows/v=n`` by bucket, their digests in ``digests/v=n``.

    The digests are taken from the rows as stored and written after them; a version is there once they are, so a write that
    failed is not read, and the next one overwrites it. The number of buckets stays for the life of the folder: choose it
    so that a bucket is a file of some hundred megabytes. One writer at a time. Rows must have the columns of ``row``, and
    unique keys that are not null.
    """

    root: str
    row: T.StructType
    keys: Sequence[str]
    buckets: int = 256

    def versions(self, spark: SparkSession) -> list[int]:
        """Complete versions. One listing, no job."""
        return sorted(int(f.rsplit("=", 1)[1]) for f in folders_with(spark, f"{self.root}/digests/v=*/_SUCCESS"))

    def write(self, df: DataFrame) -> int:
        """Write the frame as the next version, and give its number."""
        spark = df.sparkSession
        version = max(self.versions(spark), default=0) + 1
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.row])
        rows = rows.withColumn(BUCKET, key_bucket(self.keys, self.buckets)).hint("rebalance", BUCKET)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/rows/v={version}")
        digests = bucket_digests(self._rows(spark, version).drop(BUCKET), self.keys, self.buckets)
        digests.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/digests/v={version}")
        return version

    def _rows(self, spark: SparkSession, version: int) -> DataFrame:
        stored = T.StructType([*self.row.fields, DIGESTS[BUCKET]])
        return spark.read.schema(stored).parquet(f"{self.root}/rows/v={version}")

    def read(self, spark: SparkSession, version: int, only: Sequence[int] | None = None) -> DataFrame:
        """A version's rows, of all buckets or of some; no other folder is read."""
        rows = self._rows(spark, version)
        return (rows if only is None else rows.filter(F.col(BUCKET).isin(list(only)))).drop(BUCKET)

    def digests(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.schema(DIGESTS).parquet(f"{self.root}/digests/v={version}")

    def diff(self, spark: SparkSession, before: int, after: int) -> DataFrame:
        """The changes from one version to another; only buckets whose digests differ are read."""
        known = self.versions(spark)
        if not {before, after} <= set(known):
            raise ValueError(f"there are versions {known}, not {sorted({before, after} - set(known))}")
        odd = differing_buckets(self.digests(spark, before), self.digests(spark, after))
        return diff_changes(self.read(spark, before, odd), self.read(spark, after, odd), self.keys)
