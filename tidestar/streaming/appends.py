"""Append sinks: one streaming query per table, and batch appends inside a micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidestar import schemas
from tidestar.operators.star import build_dim_datetime, build_fact
from tidestar.streaming.run import query_id, with_trigger


def append(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name."""
    df.write.mode("append").saveAsTable(table)


def stream_append(
    df: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
    source: str = "parquet",
) -> StreamingQuery:
    """Start a query that appends a stream to a table; its offsets live in the checkpoint."""
    writer = df.writeStream.format(source).outputMode(mode).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).toTable(table)


def append_star(
    trips: DataFrame, database: str, checkpoints: str, every: str | None = None
) -> dict[str, StreamingQuery]:
    """Six independent append queries over described, clean trips: raw dimension rows and the unhashed fact.

    Each query reads the source by itself and dimensions keep their repeats;
    ``start_star`` reads it once and merges. Kept for feeds that want plain
    appends. The layout has no hash keys, so tables of the merged star are refused as targets.
    """
    frames = {
        "dim_datetime": build_dim_datetime(trips, hashed=False),
        "dim_passenger_count": trips.select("passenger_count"),
        "dim_payment_type": trips.select(*schemas.DIM_PAYMENT_TYPE.fieldNames()),
        "dim_ratecode": trips.select(*schemas.DIM_RATECODE.fieldNames()),
        "dim_trip_distance": trips.select("trip_distance"),
        "fact_trips": build_fact(trips, hashed=False),
    }
    spark = trips.sparkSession
    for name, df in frames.items():
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table) and set(spark.table(table).columns) != set(df.columns):
            raise ValueError(f"{table} has other columns than these appends; give them a database of their own")
    return {
        name: stream_append(df, f"{database}.{name}", f"{checkpoints}/{name}", every) for name, df in frames.items()
    }


def routed_sink(root: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes routed records, one pass for all their tables.

    Each batch has its own folder with one subfolder per ``table``; a replayed
    batch overwrites itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{root}/run={query_id(batch.sparkSession)}/batch_id={batch_id}"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("table").parquet(folder)

    return write


def read_routed(spark: SparkSession, root: str, schema: T.StructType, table: str) -> DataFrame:
    """The records routed to one table; only its folders are read."""
    stored = T.StructType([*[f for f in schema if f.name != "table"], T.StructField("table", T.StringType())])
    records = spark.read.schema(stored).parquet(root).filter(F.col("table") == table)
    return records.select([f.name for f in schema if f.name != "table"])
