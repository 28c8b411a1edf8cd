"""Change-feed sources: subscription, snapshot bootstrap, table filter and routing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar import schemas


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Subscribe to one broker topic; a new query starts at the latest offsets unless told otherwise.

    Needs the broker connector package on the classpath. Bound a micro-batch with
    ``maxOffsetsPerTrigger``.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).options(**options).load()


def file_topic(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same record contract read from a folder that parquet files are dropped into."""
    return spark.readStream.schema(schemas.TOPIC).options(**options).parquet(path)


def bootstrap(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """A change frame that starts with the snapshot as read rows (``r``), then the changes.

    Order columns missing from the snapshot are null and so sort before every change.
    """
    marked = snapshot.withColumns({"__op": F.lit("r"), "__deleted": F.lit("false")})
    return marked.unionByName(changes, allowMissingColumns=True)


def include_tables(changes: DataFrame, tables: Iterable[str], source: str = "source") -> DataFrame:
    """Keep changes whose ``source`` block names one of the ``schema.table`` entries."""
    name = F.concat_ws(".", F.col(f"{source}.schema"), F.col(f"{source}.table"))
    return changes.filter(name.isin(list(tables)))


def route(records: DataFrame, tables: Mapping[str, str], column: str = "topic") -> DataFrame:
    """Add the target ``table`` of each record; a topic without a mapping keeps its own name."""
    target = F.col(column)
    for topic, table in tables.items():
        target = F.when(F.col(column) == topic, F.lit(table)).otherwise(target)
    return records.withColumn("table", target)
