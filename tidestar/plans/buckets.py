"""The current state of a captured table in buckets of its key, of which a batch rewrites those it touches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.functions.decode import conform
from tidestar.operators.changes import apply_changes, live_rows
from tidestar.storage import folders_with, remove_folder

BUCKET = T.StructField("bucket", T.IntegerType())


@dataclass(frozen=True)
class BucketedState:
    """Last images by key under one folder, with delete marks and order, so that changes may come in any order of batches.

    A fold writes a version ``v=n`` that holds the buckets its changes touch. The current files of a bucket are those of
    the newest finished version that has it, so readers see a fold once it is whole, and never a part. One writer at a
    time. ``row`` is the table's schema; the order columns, which start with ``__``, are kept as ``bigint``.
    """

    root: str
    row: T.StructType
    keys: Sequence[str]
    order: Sequence[str]
    buckets: int = 256

    @property
    def schema(self) -> T.StructType:
        marks = [T.StructField("__deleted", T.StringType()), *(T.StructField(c, T.LongType()) for c in self.order)]
        return T.StructType([*self.row.fields, *marks])

    def bucket_of(self) -> Column:
        """Null keys have a bucket like others."""
        keys = [F.col(k).cast(self.row[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def current(self, spark: SparkSession) -> dict[int, str]:
        """The folder that holds each bucket's current rows. Two listings, no job."""
        done = {f.rsplit("/", 1)[1] for f in folders_with(spark, f"{self.root}/v=*/_SUCCESS")}
        newest: dict[int, tuple[int, str]] = {}
        for folder in set(folders_with(spark, f"{self.root}/v=*/bucket=*/*.parquet")):
            _, version, bucket = folder.rsplit("/", 2)
            if version in done:
                at = int(bucket.split("=")[1])
                newest[at] = max(newest.get(at, (0, "")), (int(version.split("=")[1]), folder))
        return {bucket: folder for bucket, (_, folder) in newest.items()}

    def stored(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame:
        """Rows with marks, of all buckets or of some; no other folder is read."""
        folders = [f for b, f in self.current(spark).items() if only is None or b in set(only)]
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table's current rows."""
        return live_rows(self.stored(spark))

    def fold(self, changes: DataFrame) -> list[int]:
        """Apply a change frame, and give the buckets it touched. Folding the same changes again changes nothing."""
        spark = changes.sparkSession
        news = changes.withColumns({c: F.col(c).cast("bigint") for c in self.order}).withColumn(BUCKET.name, self.bucket_of())
        news.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = sorted(r[0] for r in news.select(BUCKET.name).distinct().collect())  # at most one number a bucket
            if touched:
                done = [int(f.rsplit("=", 1)[1]) for f in folders_with(spark, f"{self.root}/v=*/_SUCCESS")]
                state = apply_changes(self.stored(spark, touched), news.drop(BUCKET.name), list(self.keys), list(self.order), "mark")
                rows = conform(state, self.schema).withColumn(BUCKET.name, self.bucket_of())
                rows = rows.hint("rebalance", BUCKET.name)
                rows.write.mode("overwrite").partitionBy(BUCKET.name).parquet(f"{self.root}/v={max(done, default=0) + 1}")
        finally:
            news.unpersist()
        return touched

    def vacuum(self, spark: SparkSession) -> int:
        """Remove the folders that newer versions stand in front of, and give their number. Run it while no reader holds them."""
        current = set(self.current(spark).values())
        old = [f for f in set(folders_with(spark, f"{self.root}/v=*/bucket=*/*.parquet")) if f not in current]
        for folder in old:
            remove_folder(spark, folder)
        return len(old)
