"""Decoding, envelopes, routing and conforming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import schemas
from tidestar.functions import (
    conform,
    decimals_as_double,
    micros_to_ts,
    parse_json,
    record_key,
    rename,
    split_bad,
    unwrap_cdc,
)
from tidestar.operators import build_fact, diff_changes
from tidestar.plans import clean_trips
from tidestar.registry.base import query, table, without_zone
from tidestar.registry.fixtures import (
    CLEAN_SQL,
    OP_SQL,
    ORDERS_AFTER_SQL,
    TABLE_SQL,
    TRIPS_SQL,
    USER_KEY,
    USER_ROW,
    captured_trip_feed,
    orders_after,
    trips,
    user_feed,
)
from tidestar.sources import bootstrap, include_tables, route
from tidestar.streaming import decode_captured_trips

PROPS = schemas.struct((schemas.INT, "k"))


@query("json_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_json(table(spark, sf_dir, "events"), PROPS, column="props", keep=["event_id"])


@query(
    "cdc_unwrap",
    f"""SELECT event_id AS feed_offset, user_id,
      CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
      CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS ts,
      CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
      CASE WHEN event_type <> 'error' THEN value END AS value,
      CASE WHEN event_type <> 'error' THEN props END AS props,
      {OP_SQL} AS op, CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS deleted
    FROM events""",
)
def cdc_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unwrap_cdc(user_feed(spark, sf_dir), USER_ROW, keep=["offset"])
    names = {"offset": "feed_offset", "__op": "op", "__deleted": "deleted"}
    return rename(rows, names).drop("__ts_ms", "__lsn", "source")


@query("cdc_record_key", "SELECT event_id AS feed_offset, user_id FROM events")
def cdc_record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_key(user_feed(spark, sf_dir), USER_KEY).select(F.col("offset").alias("feed_offset"), "user_id")


@query("cdc_table_filter", "SELECT event_id AS feed_offset, user_id FROM events WHERE event_type = 'purchase'")
def cdc_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = unwrap_cdc(user_feed(spark, sf_dir), USER_ROW, keep=["offset"], fields=["user_id"])
    return include_tables(changes, ["public.purchases"]).select(F.col("offset").alias("feed_offset"), "user_id")


@query(
    "cdc_route",
    f"""SELECT event_id AS feed_offset,
      CASE WHEN {TABLE_SQL} = 'purchases' THEN 'shop_purchases' ELSE 'app.public.activity' END AS target_table
    FROM events""",
)
def cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route(user_feed(spark, sf_dir), {"app.public.purchases": "shop_purchases"})
    return routed.select(F.col("offset").alias("feed_offset"), F.col("table").alias("target_table"))


@query(
    "cdc_bootstrap",
    f"""WITH {ORDERS_AFTER_SQL}
    SELECT o_orderkey, o_orderstatus, 'r' AS op FROM orders
    UNION ALL
    SELECT coalesce(a.o_orderkey, b.o_orderkey), coalesce(a.o_orderstatus, b.o_orderstatus),
           CASE WHEN b.o_orderkey IS NULL THEN 'c' WHEN a.o_orderkey IS NULL THEN 'd' ELSE 'u' END
    FROM orders b FULL JOIN orders_after a ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus""",
)
def cdc_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    changes = diff_changes(orders, orders_after(spark, sf_dir), ["o_orderkey"])
    return bootstrap(orders, changes).select("o_orderkey", "o_orderstatus", F.col("__op").alias("op"))


WIRE_NTZ = T.StructType(
    [T.StructField(f.name, schemas.TS_NTZ if f.dataType == schemas.TS else f.dataType) for f in schemas.WIRE_TRIPS]
)


@query(
    "conform_columns",
    f"WITH {TRIPS_SQL} SELECT {', '.join(WIRE_NTZ.fieldNames())} FROM trips",
)
def conform_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw names and types in, wire names, order and types out; the two columns the raw table lacks become nulls."""
    raw_names = {star: raw for raw, star in schemas.TRIP_NAMES.items()}
    raw = trips(spark, sf_dir).drop("lpep_pickup_datetime", "lpep_dropoff_datetime").withColumnsRenamed(raw_names)
    raw = raw.withColumns({c: F.col(c).cast("smallint") for c in ("VendorID", "RatecodeID", "payment_type")})
    return conform(rename(raw, schemas.TRIP_NAMES), WIRE_NTZ)


@query("micros_to_ts", "SELECT event_id, ts FROM events")
def micros_to_ts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = unwrap_cdc(user_feed(spark, sf_dir), schemas.struct((schemas.LONG, "user_id ts")), keep=["offset", "timestamp"])
    # A delete's image has no time of its own; the record's stands in, as microseconds like the others.
    micros = feed.withColumn("ts", F.coalesce("ts", F.unix_micros("timestamp")))
    return without_zone(micros_to_ts(micros, ["ts"])).select(F.col("offset").alias("event_id"), "ts")


@query(
    "decimal_as_double",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
              CAST(CAST(o_totalprice AS DECIMAL(9,1)) AS DOUBLE) AS rounded FROM orders""",
)
def decimal_as_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", price.cast("decimal(12,2)").alias("price"), price.cast("decimal(9,1)").alias("rounded")
    )
    return decimals_as_double(orders)


# Errors are cut short, views hold text for a number, signups are null.
MESSY_SQL = """CASE event_type WHEN 'error' THEN substr(props, 1, length(props) - 1)
  WHEN 'view' THEN concat('{"k": "', event_type, '"}') WHEN 'signup' THEN NULL ELSE props END"""


@query(
    "bad_records",
    f"""WITH messy AS (SELECT event_id, {MESSY_SQL} AS v FROM events)
    SELECT event_id, v AS bad_value FROM messy
    WHERE v IS NULL OR NOT json_valid(v)
       OR CASE WHEN json_valid(v) THEN json_type(v, '$.k') NOT IN ('UBIGINT', 'BIGINT') ELSE true END""",
)
def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = table(spark, sf_dir, "events").withColumn("v", F.expr(MESSY_SQL))
    return split_bad(messy, PROPS, column="v", keep=["event_id"])[1]


FACT_LIST = ", ".join(schemas.FACT_TRIPS.fieldNames())


@query("cdc_star_fact", f"WITH {CLEAN_SQL} SELECT {FACT_LIST} FROM clean")
def cdc_star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured envelopes all the way to fact rows."""
    rows = decode_captured_trips(captured_trip_feed(spark, sf_dir))
    return without_zone(build_fact(clean_trips(rows)))
