"""Scans, counts and loads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidestar.functions import insert_select
from tidestar.registry.base import query, table
from tidestar.registry.fixtures import TRIPS_SQL, trips
from tidestar.session import work_dir
from tidestar.sources import LedgerTable, append_load, read_parquet, row_count


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet")


@query("count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


def scratch_table(spark: SparkSession, label: str, columns: str) -> tuple[str, str]:
    """A new empty parquet table in a scratch folder: its name and location."""
    name, location = f"{label}_{uuid.uuid4().hex}", work_dir(spark, label)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{location}'")
    return name, location


def columns_of(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


@query("append_load", "SELECT * FROM orders")
def append_load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/orders.parquet"
    schema = spark.read.parquet(path).schema
    name, location = scratch_table(spark, "append_load", columns_of(spark.read.parquet(path)))
    append_load(spark, path, name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(location)


@query(
    "insert_select",
    f"""WITH {TRIPS_SQL}
    SELECT vendor_id, payment_type, fare_amount, tolls_amount,
           CAST(round(CAST(fare_amount AS DECIMAL(12,2)) + CAST(tolls_amount AS DECIMAL(12,2)), 2) AS DECIMAL(14,2))
             AS total_amount
    FROM trips""",
)
def insert_select_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "vendor_id int, payment_type int, fare_amount double, tolls_amount double, total_amount decimal(14,2)"
    name, location = scratch_table(spark, "insert_select", columns)
    insert_select(
        spark,
        name,
        ["total_amount", "vendor_id", "payment_type", "fare_amount", "tolls_amount"],
        """WITH s AS (
             SELECT *, cast(fare_amount AS decimal(12,2)) + cast(tolls_amount AS decimal(12,2)) AS total
             FROM {trips})
           SELECT cast(round(total, 2) AS decimal(14,2)), vendor_id, payment_type, fare_amount, tolls_amount FROM s""",
        trips=trips(spark, sf_dir).drop("total_amount"),
    )
    result = spark.read.schema(spark.table(name).schema).parquet(location)
    spark.sql(f"DROP TABLE {name}")
    return result


@query("ledger_load", "SELECT * FROM orders")
def ledger_load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder loaded twice, then once more with new files in it: every row is there once."""
    orders, folder = table(spark, sf_dir, "orders"), work_dir(spark, "ledger_source")
    target = LedgerTable(work_dir(spark, "ledger"), orders.schema)
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 <> 0"):
        orders.filter(part).write.mode("append").parquet(folder)
        for _ in range(2):
            target.load(spark, folder)
    return target.read(spark)
