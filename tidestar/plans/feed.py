"""A replica whose columns and types come from the feed itself, and widen with it."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import schemas
from tidestar.functions.decode import conform, unwrap_cdc
from tidestar.functions.feed_schema import row_types, wider_type
from tidestar.operators.changes import apply_changes
from tidestar.storage import folders_with
from tidestar.streaming.run import query_id

MARKS = schemas.struct((schemas.TEXT, "__op __deleted"), (schemas.LONG, "__ts_ms __lsn __offset"))
TYPE = schemas.struct((schemas.TEXT, "row"))


@dataclass(frozen=True)
class FeedTable:
    """The changes of a captured table under one folder, and its row type as the feed has told it so far.

    A column that the feed adds is added, and null in rows before it; one that it widens is widened; one that it no longer
    sends stays, null in rows after it. A change that does not hold the old values, such as number to text, is refused
    before the batch writes anything. The wider type is written before the first rows that need it, and files keep the type
    they were written with, which parquet readers widen. A batch has its own folder, which a replay overwrites. One writer
    at a time. Tombstones and records that do not parse are no changes.
    """

    root: str
    keys: Sequence[str]

    def _types(self, spark: SparkSession) -> list[int]:
        return sorted(int(f.rsplit("=", 1)[1]) for f in folders_with(spark, f"{self.root}/types/v=*/_SUCCESS"))

    def row(self, spark: SparkSession) -> T.StructType | None:
        """The row type so far; none before the first change."""
        known = self._types(spark)
        if not known:
            return None
        text = spark.read.schema(TYPE).parquet(f"{self.root}/types/v={known[-1]}").first()["row"]
        return T.StructType.fromJson(json.loads(text))

    def load(self, records: DataFrame, run: str, batch_id: int) -> T.StructType | None:
        """Load a batch of topic records whose values hold schema and payload, and give the row type after it."""
        spark = records.sparkSession
        records = records.select("value", "offset").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before, news = self.row(spark), row_types(records)
            if before is None and not news:
                return None
            row = reduce(wider_type, [*([before] if before else []), *news])
            missing = set(self.keys) - set(row.fieldNames())
            if missing:
                raise ValueError(f"the feed's rows have no {sorted(missing)}")
            if row != before:
                number = max(self._types(spark), default=0) + 1
                spark.createDataFrame([(row.json(),)], TYPE).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/types/v={number}")
            changes = unwrap_cdc(records, row, keep_tombstones=False, keep=["offset"], wrapped=True)
            changes = changes.withColumnRenamed("offset", "__offset").filter("__deleted IS NOT NULL")
            folder = f"{self.root}/rows/run={run}/batch_id={batch_id}"
            conform(changes, T.StructType([*row.fields, *MARKS])).write.mode("overwrite").parquet(folder)
            return row
        finally:
            records.unpersist()

    def sink(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function for a stream of topic records."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.load(batch, query_id(batch.sparkSession), batch_id)

        return write

    def read(self, spark: SparkSession, deletes: str = "apply") -> DataFrame:
        """The table's current rows, by the last change of each key."""
        row = self.row(spark)
        if row is None:
            raise ValueError(f"no feed was loaded into {self.root}")
        changes = spark.read.schema(T.StructType([*row.fields, *MARKS])).parquet(f"{self.root}/rows")
        changes = changes.select(*[F.col(f.name) for f in row], *MARKS.fieldNames())
        return apply_changes(None, changes, self.keys, ["__offset"], deletes)
