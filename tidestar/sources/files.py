"""Table scans and append loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan parquet; a declared schema skips footer inference and narrows the read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def append_load(spark: SparkSession, path: str, table: str) -> None:
    """Append a parquet file set to an existing table, matching columns by name."""
    spark.read.parquet(path).write.mode("append").saveAsTable(table)


def jdbc_append(df: DataFrame, url: str, table: str, connections: int = 8, **options: str) -> None:
    """Append to a relational table over at most ``connections`` parallel connections.

    Needs the database's JDBC driver on the classpath.
    """
    writer = df.write.format("jdbc").mode("append").options(url=url, dbtable=table, numPartitions=connections)
    writer.options(**options).save()
