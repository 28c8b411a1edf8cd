"""Star-schema builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidestar import schemas
from tidestar.functions.derive import datetime_parts, with_datetime_hash
from tidestar.operators.enrich import enrich
from tidestar.operators.quality import require_not_null

FACT_COLUMNS = schemas.FACT_TRIPS.fieldNames()
TIME_PREFIXES = {"pickup": "tpep_pickup_datetime", "dropoff": "tpep_dropoff_datetime"}
RAW_FACT_COLUMNS = [c for c in schemas.WIRE_TRIPS.fieldNames()]


def distinct_dim(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def build_dim(df: DataFrame, key: str, codes: DataFrame | None = None) -> DataFrame:
    """Distinct keys of a dimension, described from a code list.

    The lookup runs on the distinct keys, not on every row. The described rows pass a shuffle of their own, so that
    a join to them knows their size as measured: by estimate it is a product that grows with the number of tasks.
    """
    keys = distinct_dim(df, [key])
    return keys if codes is None else enrich(keys, codes, key).hint("rebalance")


def build_dim_datetime(df: DataFrame, hashed: bool = True) -> DataFrame:
    """Pickup and drop-off times with their parts, one row per ``datetime_hash``.

    The hash is a function of the two times, so the distinct runs on those two
    8-byte values and only its survivors are hashed and split into parts.
    ``hashed=False`` gives the older layout: one row per trip, no key.
    """
    return describe_times(distinct_times(df)) if hashed else df.select(*schemas.EVENT_TIMES, *datetime_parts(TIME_PREFIXES))


def distinct_times(df: DataFrame) -> DataFrame:
    """Each pickup and drop-off time once; all that has to be shuffled of ``dim_datetime``."""
    return require_not_null(df.select(*schemas.EVENT_TIMES), schemas.EVENT_TIMES).distinct()


def describe_times(pairs: DataFrame, *more: str) -> DataFrame:
    """Distinct times with their hash and parts, row by row, and ``more`` columns."""
    return with_datetime_hash(pairs).select("datetime_hash", *schemas.EVENT_TIMES, *datetime_parts(TIME_PREFIXES), *more)


def build_fact(df: DataFrame, hashed: bool = True) -> DataFrame:
    """Fact rows: with ``datetime_hash`` in place of the times, or with the raw columns."""
    if not hashed:
        return df.select(*RAW_FACT_COLUMNS)
    if "datetime_hash" not in df.columns:
        df = with_datetime_hash(df)
    return df.select(*FACT_COLUMNS)


def create_star(spark: SparkSession, database: str, location: str | None = None, source: str = "parquet") -> None:
    """Create the database and its six tables where they do not exist."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, schema in schemas.STAR_TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING {source}")
