"""Derived columns."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.functions import (
    component_total,
    datetime_parts,
    flag_when,
    interval_text,
    pg_char_cast,
    pg_element,
    pg_int_cast,
    pg_numeric_cast,
    series,
    shift_time,
    total_mismatch,
    trip_dates,
    with_datetime_hash,
)
from tidestar.plans import clean_trips
from tidestar.registry.base import query, table
from tidestar.registry.fixtures import CLEAN_SQL, PARTS_SQL, TRIPS_SQL, trips

PLACES = ["PULocationID", "DOLocationID"]


def total_sql(parts: Iterable[str]) -> str:
    return "CAST(round(" + " + ".join(f"coalesce(CAST({c} AS DECIMAL(18,6)), 0)" for c in parts) + ", 2) AS DECIMAL(14,2))"


TOTAL_SQL = total_sql(schemas.AMOUNT_PARTS)


@query(
    "trip_dates",
    f"""WITH {TRIPS_SQL} SELECT PULocationID, DOLocationID, tpep_pickup_datetime,
      CAST(tpep_pickup_datetime AS DATE) AS tpep_pickup_date, CAST(tpep_dropoff_datetime AS DATE) AS tpep_dropoff_date
    FROM trips""",
)
def dates_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = trip_dates(trips(spark, sf_dir))
    return dated.select(*PLACES, "tpep_pickup_datetime", "tpep_pickup_date", "tpep_dropoff_date")


@query("datetime_parts", f"WITH {TRIPS_SQL} SELECT PULocationID, DOLocationID, {PARTS_SQL} FROM trips")
def parts_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = datetime_parts({"pickup": "tpep_pickup_datetime", "dropoff": "tpep_dropoff_datetime"})
    return trips(spark, sf_dir).select(*PLACES, *parts)


@query("datetime_hash", f"WITH {CLEAN_SQL} SELECT PULocationID, DOLocationID, datetime_hash FROM clean")
def hash_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_datetime_hash(clean_trips(trips(spark, sf_dir))).select(*PLACES, "datetime_hash")


@query(
    "event_hash",
    "SELECT event_id, sha256(concat_ws('||', ts, ts + INTERVAL '1 minute')) AS datetime_hash FROM events",
)
def hash_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times with microseconds, whose text must match digit for digit."""
    events = table(spark, sf_dir, "events").withColumn("later", F.col("ts") + F.lit(timedelta(minutes=1)))
    return with_datetime_hash(events, ["ts", "later"]).select("event_id", "datetime_hash")


@query("total_amount", f"WITH {TRIPS_SQL} SELECT PULocationID, DOLocationID, {TOTAL_SQL} AS computed_total FROM trips")
def total_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).select(*PLACES, component_total(schemas.AMOUNT_PARTS).alias("computed_total"))


MILLS = {"a": "o_custkey % 10", "b": "o_orderkey % 7", "c": "(o_orderkey + o_custkey) % 9 - 4"}


@query(
    "total_of_mills",
    f"SELECT o_orderkey, {total_sql(MILLS)} AS total FROM (SELECT o_orderkey, "
    + ", ".join(f"CAST({e} AS DECIMAL(10,3)) * 0.001 AS {c}" for c, e in MILLS.items())
    + " FROM orders)",
)
def total_of_mills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of less than a cent, which count only when the sum is rounded once."""
    parts = {c: F.expr(f"cast({e} as decimal(10,3)) * 0.001BD") for c, e in MILLS.items()}
    return table(spark, sf_dir, "orders").withColumns(parts).select("o_orderkey", component_total(MILLS).alias("total"))


@query(
    "interval_text",
    """SELECT o_orderkey, o_orderdate + CAST((o_custkey % 50 || ' minutes') AS INTERVAL) AS later,
              o_orderdate - CAST((o_custkey % 7 || ' days') AS INTERVAL) AS earlier FROM orders""",
)
def interval_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts joined to units as text, then read as intervals."""
    later = F.col("o_orderdate") + interval_text(F.col("o_custkey") % 50, "minutes")
    earlier = F.col("o_orderdate") - interval_text(F.col("o_custkey") % 7, "days")
    return table(spark, sf_dir, "orders").select("o_orderkey", later.alias("later"), earlier.alias("earlier"))


@query(
    "pg_text_casts",
    """SELECT c_custkey, rpad(substr(c_mktsegment, 1, 1), 1, ' ') AS flag, rpad(substr(c_mktsegment, 1, 12), 12, ' ') AS padded,
              CAST(round(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38,18)), 1) AS DECIMAL(10,1)) AS balance FROM customer""",
)
def text_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts to char(1), char(12) and numeric(10,1)."""
    segment, balance = F.col("c_mktsegment"), pg_numeric_cast(F.col("c_acctbal"), 10, 1)
    casts = [pg_char_cast(segment, 1).alias("flag"), pg_char_cast(segment, 12).alias("padded"), balance.alias("balance")]
    return table(spark, sf_dir, "customer").select("c_custkey", *casts)


@query(
    "total_mismatch",
    f"""WITH {TRIPS_SQL}
    SELECT PULocationID, DOLocationID, total_amount,
           CAST(CAST(total_amount AS DECIMAL(14,2)) - {TOTAL_SQL} AS DECIMAL(15,2)) AS difference
    FROM trips WHERE CAST(total_amount AS DECIMAL(14,2)) <> {TOTAL_SQL}""",
)
def mismatch_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = total_mismatch(trips(spark, sf_dir), schemas.AMOUNT_PARTS)
    return wrong.select(*PLACES, "total_amount", "difference")


@query(
    "interval_arith",
    """SELECT o_orderkey, o_orderdate - o_custkey * INTERVAL '10 minutes' AS pu,
              o_orderdate - o_custkey * INTERVAL '10 minutes' + (5 + o_custkey % 50) * INTERVAL '1 minute' AS do_ts
    FROM orders""",
)
def interval_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    custkey = F.col("o_custkey")
    pickup = shift_time(F.col("o_orderdate"), -custkey, timedelta(minutes=10))
    dropoff = shift_time(pickup, 5 + custkey % 50, timedelta(minutes=1))
    return table(spark, sf_dir, "orders").select("o_orderkey", pickup.alias("pu"), dropoff.alias("do_ts"))


@query(
    "case_flag",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount < 0.05 THEN 'Y' ELSE 'N' END AS flag FROM lineitem",
)
def case_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = flag_when(F.col("l_discount") < 0.05)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", flag.alias("flag"))


@query(
    "code_from_array",
    """SELECT l_orderkey, l_partkey, l_linenumber - 1 AS i,
              CASE l_linenumber - 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 6 WHEN 4 THEN 7 END AS vendor_id
    FROM lineitem""",
)
def code_from_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes run from 0 to beyond the array."""
    items = table(spark, sf_dir, "lineitem").withColumn("i", F.col("l_linenumber") - 1)
    return items.select("l_orderkey", "l_partkey", "i", pg_element([1, 2, 6, 7], F.col("i")).alias("vendor_id"))


@query(
    "pg_int_cast",
    """SELECT event_id, CAST(floor(value) + 0.5 AS INTEGER) AS half, CAST(value AS INTEGER) AS plain,
              CAST(CAST(floor(value) + 0.5 AS DECIMAL(12,1)) AS INTEGER) AS exact_half
    FROM events""",
)
def int_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.expr("cast(floor(value) as double) + cast(0.5 as double)")
    rows = table(spark, sf_dir, "events").select(
        "event_id", half.alias("half"), F.col("value").alias("plain"), half.cast("decimal(12,1)").alias("exact_half")
    )
    return pg_int_cast(rows, ["half", "plain", "exact_half"])


@query(
    "series",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(unnest(range(1, l_linenumber + 1)) AS INTEGER) AS i
    FROM lineitem""",
)
def series_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return series(items, F.col("l_linenumber"))
