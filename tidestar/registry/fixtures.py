"""The given tables in the shapes the operators expect: trips from lineitem, change feeds from events and orders."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.registry.base import table

# One select list, valid in Spark and in the oracle. Every edge the operators
# care about occurs: null times and counts, negative distances, unknown codes.
TRIP_COLUMNS = {
    "vendor_id": "cast(l_suppkey % 4 + 1 as int)",
    "tpep_pickup_datetime": (
        "case when l_partkey % 101 = 0 then null else l_shipdate + (l_partkey % 1440) * interval '1 minute' end"
    ),
    "tpep_dropoff_datetime": (
        "case when l_partkey % 103 = 0 then null "
        "else l_shipdate + (l_partkey % 1440 + 5 + l_suppkey % 50) * interval '1 minute' end"
    ),
    "passenger_count": "case when l_linenumber = 7 then null else l_linenumber end",
    "trip_distance": "case when l_partkey % 97 = 0 then cast(-1.0 as double) else l_quantity end",
    "ratecode_id": (
        "cast(case when l_suppkey % 8 = 7 then null when l_suppkey % 8 = 6 then 99 else l_suppkey % 8 + 1 end as int)"
    ),
    "store_and_fwd_flag": "case l_linestatus when 'F' then 'Y' else 'N' end",
    "PULocationID": "cast(l_suppkey % 265 + 1 as int)",
    "DOLocationID": "cast(l_partkey % 265 + 1 as int)",
    "payment_type": "case l_returnflag when 'A' then 1 when 'N' then 2 else 0 end",
    "fare_amount": "l_extendedprice",
    "extra": "cast(0.5 as double)",
    "mta_tax": "cast(0.5 as double)",
    "tip_amount": "case when l_linenumber = 6 then null else l_discount end",
    "tolls_amount": "l_tax",
    "improvement_surcharge": "cast(0.3 as double)",
    # What the meter says; off by one on returned third items, for the total check.
    "total_amount": (
        "cast(cast(l_extendedprice as decimal(12,2)) + cast(l_tax as decimal(12,2)) "
        "+ case when l_linenumber = 6 then cast(0 as decimal(12,2)) else cast(l_discount as decimal(12,2)) end "
        "+ cast(5.05 as decimal(12,2)) "
        "+ case when l_linenumber = 3 and l_returnflag = 'R' then cast(1 as decimal(12,2)) "
        "else cast(0 as decimal(12,2)) end as double)"
    ),
    "congestion_surcharge": "cast(2.75 as double)",
    "airport_fee": "cast(0.0 as double)",
    "cbd_congestion_fee": "cast(1.0 as double)",
    "lpep_pickup_datetime": "cast(null as {ts})",
    "lpep_dropoff_datetime": "cast(null as {ts})",
    # Not a trip column: tells a first load from a second where a query needs two.
    "load_wave": "case l_linestatus when 'F' then 1 else 2 end",
}


def _select_list(ts: str) -> list[str]:
    return [f"{expr.format(ts=ts)} AS {name}" for name, expr in TRIP_COLUMNS.items()]


TRIPS_SQL = f"trips AS (SELECT {', '.join(_select_list('timestamp'))} FROM lineitem)"
CLEAN_SQL = f"""{TRIPS_SQL}, clean AS (
  SELECT *, sha256(concat_ws('||', tpep_pickup_datetime, tpep_dropoff_datetime)) AS datetime_hash
  FROM trips
  WHERE passenger_count >= 0 AND trip_distance >= 0 AND fare_amount >= 0 AND tip_amount >= 0 AND tolls_amount >= 0
    AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL)"""


def _code_sql(name: str, rows: list[tuple[int, str]], columns: list[str]) -> str:
    values = ", ".join(f"({code}, '{text}')" for code, text in rows)
    return f"{name} AS (SELECT * FROM (VALUES {values}) AS v({', '.join(columns)}))"


PAYMENTS_SQL = _code_sql("payment_types", schemas.PAYMENT_TYPES, schemas.DIM_PAYMENT_TYPE.fieldNames())
RATES_SQL = _code_sql("rate_codes", schemas.RATE_CODES, schemas.DIM_RATECODE.fieldNames())


def parts_sql(prefix: str, column: str) -> str:
    parts = ("hour", "day", "month", "year")
    return ", ".join(f"CAST(extract({p} FROM {column}) AS INTEGER) AS {prefix}_{p}" for p in parts)


PARTS_SQL = f"{parts_sql('pickup', 'tpep_pickup_datetime')}, {parts_sql('dropoff', 'tpep_dropoff_datetime')}"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_select_list("timestamp_ntz"))


# --- Change feed of user rows, from events: signups create, errors delete, the rest update. ---

USER_ROW = schemas.struct(
    (schemas.LONG, "user_id event_id ts"),
    (schemas.TEXT, "event_type"),
    (schemas.DOUBLE, "value"),
    (schemas.TEXT, "props"),
)
USER_KEY = schemas.struct((schemas.LONG, "user_id"))
OP_SQL = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END"
TABLE_SQL = "CASE event_type WHEN 'purchase' THEN 'purchases' ELSE 'activity' END"


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records whose values are change envelopes; a delete's before image holds only the key."""
    events = table(spark, sf_dir, "events")
    op = F.expr(OP_SQL)
    image = F.struct("user_id", "event_id", _micros("ts").alias("ts"), "event_type", "value", "props")
    envelope = F.struct(
        F.when(op == "d", F.struct("user_id")).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        F.expr("unix_millis(cast(ts as timestamp))").alias("ts_ms"),
        F.struct(F.lit("public").alias("schema"), F.expr(TABLE_SQL).alias("table"), F.col("event_id").alias("lsn")).alias(
            "source"
        ),
    )
    return events.select(
        F.to_json(F.struct("user_id")).cast("binary").alias("key"),
        F.to_json(envelope).cast("binary").alias("value"),
        F.concat(F.lit("app.public."), F.expr(TABLE_SQL)).alias("topic"),
        F.expr("cast(pmod(user_id, 4) as int)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records whose values are flat JSON trips."""
    rows = trips(spark, sf_dir)
    for name in schemas.EVENT_TIMES:
        rows = rows.withColumn(name, F.col(name).cast("timestamp"))
    names = [c for c in schemas.WIRE_TRIPS.fieldNames() if not c.startswith("lpep")]
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(*names)).cast("binary").alias("value"),
        F.lit("trips").alias("topic"),
        F.expr("cast(pmod(DOLocationID, 4) as int)").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.col("tpep_pickup_datetime").alias("timestamp"),
    )


# Some records are no JSON, some have no value, and in some the passenger count is text.
MESSY_TRIP_SQL = """CASE WHEN l_partkey % 41 = 0 THEN 'oops' WHEN l_partkey % 43 = 0 THEN 'null value'
  WHEN l_partkey % 47 = 0 AND l_linenumber <> 7 THEN 'text count' END"""


def messy_trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip feed with records that can't be loaded; the offset is the part, so that a query can tell them."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(*_select_list("timestamp_ntz"), f"{MESSY_TRIP_SQL} AS mess", "l_partkey AS part")
    for name in schemas.EVENT_TIMES:
        rows = rows.withColumn(name, F.col(name).cast("timestamp"))
    names = [c for c in schemas.WIRE_TRIPS.fieldNames() if not c.startswith("lpep")]
    good = F.to_json(F.struct(*names))
    text = F.regexp_replace(F.to_json(F.struct(*names)), '"passenger_count":[0-9]+', '"passenger_count":"many"')
    value = F.when(F.col("mess") == "oops", "oops").when(F.col("mess") == "text count", text).when(F.col("mess").isNull(), good)
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("trips").alias("topic"),
        F.expr("cast(pmod(DOLocationID, 4) as int)").alias("partition"),
        F.col("part").alias("offset"),
        F.col("tpep_pickup_datetime").alias("timestamp"),
    )


def captured_trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records whose values are change envelopes around raw trip rows: raw names, times in microseconds."""
    raw_names = {star: raw for raw, star in schemas.TRIP_NAMES.items()}
    rows = trips(spark, sf_dir).withColumns({c: _micros(c) for c in schemas.EVENT_TIMES})
    rows = rows.withColumnsRenamed(raw_names).withColumn("trip_id", F.monotonically_increasing_id())
    envelope = F.struct(
        F.struct(*schemas.CAPTURED_TRIPS.fieldNames()).alias("after"),
        F.lit("r").alias("op"),
        F.lit(0).alias("ts_ms"),
        F.struct(F.lit("public").alias("schema"), F.lit("trips").alias("table"), F.col("trip_id").alias("lsn")).alias(
            "source"
        ),
    )
    return rows.select(
        F.to_json(F.struct("trip_id")).cast("binary").alias("key"), F.to_json(envelope).cast("binary").alias("value")
    )


LIVE_SQL = f"""{TRIPS_SQL}, live AS (
  SELECT * REPLACE (CASE WHEN DOLocationID % 3 = 0 THEN fare_amount + 1 ELSE fare_amount END AS fare_amount)
  FROM trips WHERE NOT coalesce(PULocationID % 5 = 0, false)), clean AS (
  SELECT *, sha256(concat_ws('||', tpep_pickup_datetime, tpep_dropoff_datetime)) AS datetime_hash
  FROM live
  WHERE passenger_count >= 0 AND trip_distance >= 0 AND fare_amount >= 0 AND tip_amount >= 0 AND tolls_amount >= 0
    AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL)"""


def captured_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A captured feed in which every trip is created, a third get another fare, and a fifth are deleted."""
    raw_names = {star: raw for raw, star in schemas.TRIP_NAMES.items()}
    rows = trips(spark, sf_dir).withColumns({c: _micros(c) for c in schemas.EVENT_TIMES})
    rows = rows.withColumn("trip_id", F.monotonically_increasing_id())
    op = lambda name, at: F.struct(F.lit(name).alias("op"), F.lit(at).alias("at"))
    no = F.lit(None).cast("struct<op:string,at:int>")
    changes = F.array(
        op("c", 0),
        F.when(F.col("DOLocationID") % 3 == 0, op("u", 1)).otherwise(no),
        F.when(F.col("PULocationID") % 5 == 0, op("d", 2)).otherwise(no),
    )
    rows = rows.withColumn("change", F.explode(F.array_compact(changes)))
    dearer = F.col("fare_amount") + F.when(F.col("change.op") == "u", 1).otherwise(0)
    rows = rows.withColumn("fare_amount", dearer).withColumnsRenamed(raw_names)
    envelope = F.struct(
        F.when(F.col("change.op") == "d", F.struct("trip_id")).alias("before"),
        F.when(F.col("change.op") != "d", F.struct(*schemas.CAPTURED_TRIPS.fieldNames())).alias("after"),
        F.col("change.op").alias("op"),
        F.lit(0).alias("ts_ms"),
        F.struct(F.lit("public").alias("schema"), F.lit("trips").alias("table"), F.col("trip_id").alias("lsn")).alias("source"),
    )
    return rows.select(F.to_json(envelope).cast("binary").alias("value"), (F.col("trip_id") * 3 + F.col("change.at")).alias("offset"))


# --- A feed of orders whose schema block changes halfway: the customer key widens, a price is added, a priority goes. ---


def _schema_block(fields: dict[str, str]) -> dict:
    image = [{"type": kind, "optional": True, "field": name} for name, kind in fields.items()]
    rows = [{"type": "struct", "fields": image, "optional": True, "field": name} for name in ("before", "after")]
    return {"type": "struct", "fields": [*rows, {"type": "string", "field": "op"}], "name": "app.public.orders.Envelope"}


ORDER_FEED = {"o_orderkey": "int64", "o_custkey": "int32", "o_orderstatus": "string", "o_orderpriority": "string"}
ORDER_FEED_LATER = {"o_orderkey": "int64", "o_custkey": "int64", "o_orderstatus": "string", "o_totalprice": "double"}


def order_feed(spark: SparkSession, sf_dir: str, later: bool) -> DataFrame:
    """Half of the orders as envelopes with their schema; the later half has fulfilled orders, sent before, deleted."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == int(later))
    fields = ORDER_FEED_LATER if later else ORDER_FEED
    rows = orders.withColumn("gone", F.lit(False))
    if later:
        known = table(spark, sf_dir, "orders").filter((F.col("o_orderkey") % 2 == 0) & (F.col("o_orderstatus") == "F"))
        rows = rows.unionByName(known.withColumn("gone", F.lit(True)))
    payload = F.struct(
        F.when(F.col("gone"), F.struct("o_orderkey")).alias("before"),
        F.when(~F.col("gone"), F.struct(*fields)).alias("after"),
        F.when(F.col("gone"), "d").otherwise("c").alias("op"),
        F.lit(0).alias("ts_ms"),
    )
    text = F.concat(F.lit(f'{{"schema":{json.dumps(_schema_block(fields))},"payload":'), F.to_json(payload), F.lit("}"))
    return rows.select(text.cast("binary").alias("value"), (F.col("o_orderkey") + (10**12 if later else 0)).alias("offset"))


# --- Two versions of orders: some rows go, some change status, urgent open ones are ordered again under a new key. ---

ORDERS_AFTER_SQL = """orders_after AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderstatus = 'O' AND o_totalprice < 100000 THEN 'P' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')
  UNION ALL
  SELECT -(o_orderkey + 1), o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"""


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    cheap_open = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 100000)
    kept = orders.filter(~((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")))
    kept = kept.withColumn("o_orderstatus", F.when(cheap_open, "P").otherwise(F.col("o_orderstatus")))
    again = orders.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    return kept.unionByName(again.withColumn("o_orderkey", -(F.col("o_orderkey") + 1)))
