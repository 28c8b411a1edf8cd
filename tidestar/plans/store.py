"""Star tables as partitioned parquet folders that can be loaded again without harm."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import schemas
from tidestar.functions.decode import conform
from tidestar.functions.derive import with_datetime_hash
from tidestar.operators.changes import rows_to_insert
from tidestar.operators.star import describe_times, distinct_times
from tidestar.plans.star import code_dimensions
from tidestar.session import require_utc
from tidestar.storage import folders_with, make_folder, remove_folder

# The two tables that grow with the data are laid out by pickup month, and sorted by time inside their files,
# whose statistics then narrow a read to days. Months keep folders large enough when a batch spans years.
MONTH = ["pickup_year", "pickup_month"]
BATCH = schemas.struct((schemas.TEXT, "run"), (schemas.LONG, "batch_id"))
PICKUP = schemas.struct((schemas.INT, "pickup_year pickup_month"), (T.DateType(), "pickup_date"))
#: The batch of a load of all days; a day that was loaded by itself afterwards stands in front of it.
ALL_DAYS = -1
#: Half of the stored bytes are hex digests, which only an entropy coder makes shorter.
CODEC = "zstd"
CODE_KEYS = [key for name, key in schemas.DIM_KEYS.items() if name != "dim_datetime"]


def _months_between(first: date, last: date) -> Column:
    """Folders that can hold rows of the days from first to last."""
    month = F.col("pickup_year") * 12 + F.col("pickup_month")
    return month.between(*[d.year * 12 + d.month for d in (first, last)])


def _by_month(rows: DataFrame) -> DataFrame:
    """Rows rebalanced by pickup month, and sorted by pickup time in it."""
    pickup = F.col("tpep_pickup_datetime")
    dated = rows.withColumns({"pickup_year": F.year(pickup), "pickup_month": F.month(pickup)})
    return dated.hint("rebalance", *MONTH).sortWithinPartitions(*MONTH, "tpep_pickup_datetime")


def _kept(codes: DataFrame) -> DataFrame:
    """Few rows, kept for several jobs, each of which runs a task for every partition: not more of these than run at once."""
    return codes.coalesce(codes.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass(frozen=True)
class StarStore:
    """The star under one folder.

    Dimensions take only keys they lack, so loading a batch twice adds nothing.
    The fact is laid out by run, batch and pickup month, and a batch overwrites
    its own folder, so loading it twice leaves it once. Dimensions are written
    before the fact: whatever fact is visible has its dimension rows. One
    writer at a time.
    """

    root: str
    null_safe: bool = True

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def stored_schema(self, table: str) -> T.StructType:
        extra = [*PICKUP, *BATCH] if table == "fact_trips" else []
        return T.StructType([*schemas.STAR_TABLES[table].fields, *extra])

    def create(self, spark: SparkSession) -> None:
        """Lay down empty tables where there are none."""
        for name in schemas.STAR_TABLES:
            make_folder(spark, self.path(name))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """A table in its declared columns."""
        return self.stored(spark, table).select(*schemas.STAR_TABLES[table].fieldNames())

    def stored(self, spark: SparkSession, table: str, first: date | None = None, last: date | None = None) -> DataFrame:
        """A table with its layout columns; a growing table may be narrowed to the pickup days first..last."""
        rows = spark.read.schema(self.stored_schema(table)).parquet(self.path(table))
        if table == "fact_trips":
            for run, days in self._days_loaded_again(spark).items():
                hidden = (F.col("run") == run) & (F.col("batch_id") == ALL_DAYS) & F.col("pickup_date").isin(days)
                rows = rows.filter(~F.coalesce(hidden, F.lit(False)))
        if first is None or last is None:
            return rows
        if table == "fact_trips":
            days = F.col("pickup_date").between(first, last)
        else:
            days = (F.col("tpep_pickup_datetime") >= F.lit(str(first)).cast("timestamp")) & (
                F.col("tpep_pickup_datetime") < F.lit(str(last + timedelta(days=1))).cast("timestamp")
            )
        return rows.filter(_months_between(first, last) & days)

    def _batches(self, spark: SparkSession, run: str, batch_id: str) -> list[str]:
        """Folders of finished batches; the names may hold wildcards."""
        return folders_with(spark, f"{self.path('fact_trips')}/run={run}/batch_id={batch_id}/_SUCCESS")

    def _days_loaded_again(self, spark: SparkSession) -> dict[str, list[date]]:
        """For each run with a load of all days: the days that were loaded by themselves after it. One listing, no job."""
        found: dict[str, list[date]] = {}
        for whole in self._batches(spark, "*", str(ALL_DAYS)):
            run = whole.rsplit("/", 2)[1].removeprefix("run=")
            ids = [f.rsplit("=", 1)[1] for f in self._batches(spark, run, "*") if f != whole]
            found[run] = [datetime.strptime(i, "%Y%m%d").date() for i in ids]
        return {run: days for run, days in found.items() if days}

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self.read(spark, name) for name in schemas.STAR_TABLES}

    def register(self, spark: SparkSession) -> None:
        """Temporary views of the tables, for SQL."""
        for name, df in self.tables(spark).items():
            df.createOrReplaceTempView(name)

    def load(
        self, trips: DataFrame, run: str, batch_id: int | None, gated: tuple[DataFrame, Callable[[], object]] | None = None
    ) -> None:
        """Merge the dimensions of clean trips, then write their fact rows as one batch.

        Without a ``batch_id`` the rows replace all of the run. A batch ``yyyymmdd`` of that run, loaded later, then
        replaces that day: the whole load's rows of the day are no longer read.

        A batch loaded again with no rows leaves none behind. The trips are read
        four times: for the combinations of code keys (few, kept, and the
        source of four dimensions), for their months, for the distinct times, and for the fact.
        ``gated`` (see ``gated_trips``) has the same rows for the first of these, and a check after it that may raise
        before anything is written.
        """
        spark = trips.sparkSession
        require_utc(spark, "loading a star")
        pickup = F.col("tpep_pickup_datetime")
        first, check = gated or (trips, None)
        codes = _kept(first.select(*CODE_KEYS).distinct())
        try:
            found = codes.count()
            if check:
                check()
            if found:
                # A number for each calendar month. Apart from the codes: sets gathered by code are objects, and are sorted.
                months = [r[0] for r in trips.select((F.year(pickup) * 12 + F.month(pickup)).alias("m")).distinct().collect()]
                self._merge_datetime(trips, months)
                for name, rows in code_dimensions(codes).items():
                    self._merge_codes(spark, name, rows)
        finally:
            codes.unpersist()
        self._write_fact(trips, run, batch_id)

    def of_months(self, spark: SparkSession, table: str, months: list[int]) -> DataFrame:
        """A growing table's rows of some calendar months (year * 12 + month); no other folder is read."""
        return self.stored(spark, table).filter((F.col("pickup_year") * 12 + F.col("pickup_month")).isin(months))

    def _merge_datetime(self, trips: DataFrame, months: list[int]) -> None:
        """Only rows of the batch's months can hold its keys, so only those are read: one odd date adds its month.

        The hash is a function of the two times, which are never null and by which the rows were made
        distinct, so the times are joined, and nothing but the times is shuffled: the rest is derived as it is written.
        """
        name = "dim_datetime"
        stored = schemas.STAR_TABLES[name]
        target = self.of_months(trips.sparkSession, name, months)
        pairs = conform(distinct_times(trips), T.StructType([stored[c] for c in schemas.EVENT_TIMES]))
        new = rows_to_insert(target, pairs, list(schemas.EVENT_TIMES), null_safe=False, unique=True)
        new = conform(describe_times(_by_month(new)), stored)
        new.write.mode("append").option("compression", CODEC).partitionBy(*MONTH).parquet(self.path(name))

    def _merge_codes(self, spark: SparkSession, name: str, rows: DataFrame) -> None:
        """Most batches bring no new code; skipping their write spares the table a trail of empty files."""
        rows = conform(rows, schemas.STAR_TABLES[name])
        new = _kept(rows_to_insert(self.read(spark, name), rows, [schemas.DIM_KEYS[name]], self.null_safe, unique=True))
        try:
            if not new.isEmpty():
                new.hint("rebalance").write.mode("append").parquet(self.path(name))
        finally:
            new.unpersist()

    def _write_fact(self, trips: DataFrame, run: str, batch_id: int | None) -> None:
        """Rebalancing by month writes few files, and splits a month too big for one task. The hash is taken after it."""
        kept = [c for c in trips.columns if c in schemas.FACT_TRIPS.names and c != "datetime_hash"]
        dated = with_datetime_hash(_by_month(trips.select(*kept, *schemas.EVENT_TIMES)))
        dated = dated.withColumn("pickup_date", F.to_date("tpep_pickup_datetime"))
        rows = conform(dated, T.StructType([*schemas.FACT_TRIPS, *PICKUP]))
        whole = batch_id is None
        folder = f"{self.path('fact_trips')}/run={run}/batch_id={ALL_DAYS if whole else batch_id}"
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
        writer.partitionBy(*MONTH).parquet(folder)
        if whole:
            for old in self._batches(trips.sparkSession, run, "*"):
                if not old.endswith(f"/batch_id={ALL_DAYS}"):
                    remove_folder(trips.sparkSession, old)
