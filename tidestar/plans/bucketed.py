"""The fact and its times in a bucketed layout, whose join needs no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.functions.derive import with_datetime_hash
from tidestar.operators.star import FACT_COLUMNS, describe_times, distinct_times

PART = "time_part"
LAYOUT = [*schemas.EVENT_TIMES, PART]


@dataclass(frozen=True)
class BucketedStar:
    """``dim_datetime`` and ``fact_trips`` as tables of one database, in equal buckets of the two times that the hash is made of.

    The times are 16 bytes and exact, where the hash is 64. A time with more than a bucket's share of the trips is
    dealt over several parts, each with its own copy of the dimension's row, so that no task of the join takes it alone.
    There are as many buckets as ``buckets`` says, or more where the trips have more than ``bucket_rows`` for each.
    """

    database: str
    prefix: str = ""
    buckets: int = 64
    bucket_rows: int = 500_000

    def table(self, name: str) -> str:
        return f"{self.database}.{self.prefix}{name}"

    def buckets_for(self, n_rows: int) -> int:
        return max(self.buckets, -(-n_rows // self.bucket_rows))

    def hot_times(self, trips: DataFrame, n_rows: int | None = None) -> DataFrame:
        """Times that hold more than a bucket's share, with their parts: fewer rows than buckets, whatever the data."""
        n_rows = trips.count() if n_rows is None else n_rows
        counts = trips.groupBy(*schemas.EVENT_TIMES).agg(F.count(F.lit(1)).alias("n"))
        share = max(n_rows, 1) / self.buckets_for(n_rows)
        hot = counts.where(F.col("n") > share).select(*schemas.EVENT_TIMES, F.ceil(F.col("n") / share).cast("int").alias("parts"))
        return trips.sparkSession.createDataFrame(hot.collect(), hot.schema)

    def laid(self, trips: DataFrame) -> tuple[int, dict[str, DataFrame]]:
        """The number of buckets, and the rows of each table dealt to them; times are hashed and described after their shuffle."""
        n_rows = trips.count()
        buckets, hot = self.buckets_for(n_rows), self.hot_times(trips, n_rows)
        parts = F.coalesce("parts", F.lit(1))
        number = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 30))  # drawn before the join, which may move rows
        own = [c for c in FACT_COLUMNS if c != "datetime_hash"]
        fact = trips.select(*own, *schemas.EVENT_TIMES, number.alias("__number")).join(hot, schemas.EVENT_TIMES, "left")
        fact = fact.select(*own, *schemas.EVENT_TIMES, F.pmod("__number", parts).cast("int").alias(PART))
        copies = F.explode(F.sequence(F.lit(0), parts - 1)).alias(PART)
        times = distinct_times(trips).join(hot, schemas.EVENT_TIMES, "left").select(*schemas.EVENT_TIMES, copies)
        fact, times = (rows.repartition(buckets, *LAYOUT) for rows in (fact, times))  # one file a bucket
        return buckets, {"fact_trips": with_datetime_hash(fact).select(*FACT_COLUMNS, *LAYOUT), "dim_datetime": describe_times(times, PART)}

    def write(self, trips: DataFrame, root: str) -> None:
        """Write clean trips, whose times are not null. Each table is shuffled once here, and by no join afterwards."""
        buckets, tables = self.laid(trips)
        for name, rows in tables.items():
            writer = rows.write.format("parquet").mode("overwrite").bucketBy(buckets, *LAYOUT).sortBy(*LAYOUT)
            writer.option("compression", "zstd").option("path", f"{root}/{name}").saveAsTable(self.table(name))

    def fact(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table("fact_trips")).select(*FACT_COLUMNS)

    def dim_datetime(self, spark: SparkSession) -> DataFrame:
        """The dimension, each time once."""
        dim = spark.table(self.table("dim_datetime")).filter(F.col(PART) == 0)
        return dim.select(*schemas.DIM_DATETIME.fieldNames())

    def joined(self, spark: SparkSession) -> DataFrame:
        """Every fact row with the attributes of its time, bucket by bucket."""
        fact, dim = (spark.table(self.table(name)) for name in ("fact_trips", "dim_datetime"))
        attributes = [c for c in schemas.DIM_DATETIME.fieldNames() if c != "datetime_hash"]
        return fact.join(dim.drop("datetime_hash").hint("merge"), LAYOUT, "left").select(*FACT_COLUMNS, *attributes)
