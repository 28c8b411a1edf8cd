"""Parquet loads that can be repeated: a ledger of the files that were loaded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.storage import folders_with

FILE = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_modification_time", T.TimestampType()),
    ]
)


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """The files that a scan of a path reads, one row each; none is opened."""
    files = spark.read.format("binaryFile").load(path)
    of = files.metadataColumn("_metadata")
    return files.select(*[of[f.name].alias(f.name) for f in FILE])


@dataclass(frozen=True)
class LedgerTable:
    """A table that takes each file of its sources once, however often they are loaded.

    A load writes the rows of the files it does not know to ``rows/load=n``, then these files with size and time to
    ``files/load=n``. Its rows are there once the files are, so a load that failed in between is not read, and the next one
    overwrites it. A known file that has another size or time is refused, since its old rows can't be told from the
    others. One writer at a time; rows are matched to ``row`` by name.
    """

    root: str
    row: T.StructType

    def loads(self, spark: SparkSession) -> list[int]:
        """Finished loads. One listing, no job."""
        return sorted(int(f.rsplit("=", 1)[1]) for f in folders_with(spark, f"{self.root}/files/load=*/_SUCCESS"))

    def _parts(self, spark: SparkSession, part: str, schema: T.StructType) -> DataFrame:
        folders = [f"{self.root}/{part}/load={n}" for n in self.loads(spark)]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of all finished loads."""
        return self._parts(spark, "rows", self.row)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """The files that were loaded."""
        return self._parts(spark, "files", FILE)

    def load(self, spark: SparkSession, path: str) -> int:
        """Load the files under a path that are not in the ledger, and give their number.

        The names of new files come to the driver, which lists the path's files for any scan of it. The scan is narrowed to
        them when it is planned, so that a file which arrives in the meantime is left to the next load, whole.
        """
        files, seen = file_list(spark, path).alias("f"), self.ledger(spark).alias("s")
        same = [F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("file_size", "file_modification_time")]
        changed = F.col("s.file_path").isNotNull() & ~(same[0] & same[1])
        met = files.join(seen, F.col("f.file_path") == F.col("s.file_path"), "left")
        found = met.filter(F.col("s.file_path").isNull() | changed).select("f.*", changed.alias("changed")).collect()
        odd = sorted(r["file_path"] for r in found if r["changed"])
        if odd:
            raise ValueError(f"{len(odd)} files were loaded and changed since, {odd[0]} among them")
        if not found:
            return 0
        number = max(self.loads(spark), default=0) + 1
        scan = spark.read.schema(self.row).parquet(path)
        rows = scan.filter(scan.metadataColumn("_metadata")["file_path"].isin([r["file_path"] for r in found]))
        rows.select(*self.row.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/rows/load={number}")
        news = spark.createDataFrame([tuple(r)[: len(FILE)] for r in found], FILE)
        news.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/files/load={number}")
        return len(found)
