"""Query registration and helpers shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.session import pin_utc
from tidestar.sources.files import read_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(pin_utc(spark), sf_dir)

        QUERIES[name] = pinned
        if sql is not None:
            ORACLE[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def without_zone(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain ones, which is how the tables and the oracle hold them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
