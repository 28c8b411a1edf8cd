"""Fixed schemas, code lists and name maps of the trip feed and its star."""

from __future__ import annotations

from pyspark.sql import types as T

SHORT, INT, LONG, DOUBLE = T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()
TEXT, TS, TS_NTZ, BINARY = T.StringType(), T.TimestampType(), T.TimestampNTZType(), T.BinaryType()
MONEY = T.DecimalType(10, 2)


def struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    """A nullable StructType from ``(type, "name name ...")`` groups, in order."""
    return T.StructType([T.StructField(n, kind) for kind, names in groups for n in names.split()])


# --- Fixed values: table shapes. Names, order and types are part of the contract. ---

# Raw table, keyed by trip_id; also the shape of the last-write-wins replica (with doubles, see REPLICA).
RAW_TRIPS = struct(
    (LONG, "trip_id"),
    (SHORT, "VendorID"),
    (TS_NTZ, "tpep_pickup_datetime tpep_dropoff_datetime"),
    (SHORT, "passenger_count"),
    (T.DecimalType(9, 3), "trip_distance"),
    (SHORT, "RatecodeID"),
    (TEXT, "store_and_fwd_flag"),
    (INT, "PULocationID DOLocationID"),
    (SHORT, "payment_type"),
    (MONEY, "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge total_amount"),
    (MONEY, "congestion_surcharge Airport_fee cbd_congestion_fee"),
)

REPLICA = struct(
    (LONG, "trip_id"),
    (SHORT, "VendorID"),
    (TS, "tpep_pickup_datetime tpep_dropoff_datetime"),
    (SHORT, "passenger_count"),
    (DOUBLE, "trip_distance"),
    (SHORT, "RatecodeID"),
    (TEXT, "store_and_fwd_flag"),
    (INT, "PULocationID DOLocationID"),
    (SHORT, "payment_type"),
    (DOUBLE, "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge total_amount"),
    (DOUBLE, "congestion_surcharge Airport_fee cbd_congestion_fee"),
)

# The row image inside a change envelope: decimals arrive as doubles, timestamps as epoch microseconds.
CAPTURED_TRIPS = T.StructType(
    [T.StructField(f.name, LONG if f.name.endswith("_datetime") else f.dataType) for f in REPLICA]
)

# The flat message the star load parses.
WIRE_TRIPS = struct(
    (INT, "vendor_id"),
    (TS, "tpep_pickup_datetime tpep_dropoff_datetime"),
    (INT, "passenger_count"),
    (DOUBLE, "trip_distance"),
    (INT, "ratecode_id"),
    (TEXT, "store_and_fwd_flag"),
    (INT, "PULocationID DOLocationID payment_type"),
    (DOUBLE, "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge"),
    (DOUBLE, "total_amount congestion_surcharge airport_fee"),
    (TS, "lpep_pickup_datetime lpep_dropoff_datetime"),
)

# Raw name -> star name.
TRIP_NAMES = {"VendorID": "vendor_id", "RatecodeID": "ratecode_id", "Airport_fee": "airport_fee"}

DIM_DATETIME = struct(
    (TEXT, "datetime_hash"),
    (TS, "tpep_pickup_datetime tpep_dropoff_datetime"),
    (INT, "pickup_hour pickup_day pickup_month pickup_year"),
    (INT, "dropoff_hour dropoff_day dropoff_month dropoff_year"),
)
DIM_PASSENGER_COUNT = struct((INT, "passenger_count"))
DIM_PAYMENT_TYPE = struct((INT, "payment_type"), (TEXT, "payment_type_description"))
DIM_RATECODE = struct((INT, "ratecode_id"), (TEXT, "ratecode_description"))
DIM_TRIP_DISTANCE = struct((DOUBLE, "trip_distance"))
FACT_TRIPS = struct(
    (INT, "vendor_id"),
    (TEXT, "datetime_hash"),
    (INT, "passenger_count ratecode_id payment_type"),
    (DOUBLE, "trip_distance"),
    (INT, "PULocationID DOLocationID"),
    (TEXT, "store_and_fwd_flag"),
    (DOUBLE, "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge"),
    (DOUBLE, "total_amount congestion_surcharge airport_fee"),
    (TS, "lpep_pickup_datetime lpep_dropoff_datetime"),
)

STAR_TABLES = {
    "dim_datetime": DIM_DATETIME,
    "dim_passenger_count": DIM_PASSENGER_COUNT,
    "dim_payment_type": DIM_PAYMENT_TYPE,
    "dim_ratecode": DIM_RATECODE,
    "dim_trip_distance": DIM_TRIP_DISTANCE,
    "fact_trips": FACT_TRIPS,
}
# Dimension -> its key, which is also the foreign key in the fact.
DIM_KEYS = {
    "dim_datetime": "datetime_hash",
    "dim_passenger_count": "passenger_count",
    "dim_payment_type": "payment_type",
    "dim_ratecode": "ratecode_id",
    "dim_trip_distance": "trip_distance",
}

# Dimensions that have about as many rows as the fact has distinct trips.
GROWING = {"dim_datetime"}

# --- Fixed values: code lists. Codes without a row (0, 99) keep a null description. ---
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]

# --- Fixed values: column roles in the star load. ---
EVENT_TIMES = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
NON_NEGATIVE = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount"]
FILL_ZERO = {"tip_amount": 0, "tolls_amount": 0, "fare_amount": 0}
AMOUNT_PARTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
]
# Row rules of the raw table, as SQL CHECK conditions.
TRIP_RULES = {
    "pickup_not_null": "tpep_pickup_datetime IS NOT NULL",
    "dropoff_not_null": "tpep_dropoff_datetime IS NOT NULL",
    "distance_not_negative": "trip_distance >= 0",
    "flag_known": "store_and_fwd_flag IN ('Y', 'N')",
    "fare_lower_bound": "fare_amount IS NULL OR fare_amount > -10000",
    "total_lower_bound": "total_amount IS NULL OR total_amount > -10000",
}

# --- Topic records: the column contract shared by a broker source and a file-backed topic. ---
TOPIC = struct((BINARY, "key value"), (TEXT, "topic"), (INT, "partition"), (LONG, "offset"), (TS, "timestamp"))
SOURCE_BLOCK = struct((TEXT, "schema table"), (LONG, "lsn"))


def envelope(row: T.StructType, before: T.StructType | None = None) -> T.StructType:
    """Schema of a change envelope around a row image; ``before`` where less of the old image is wanted."""
    before = row if before is None else before
    return T.StructType(
        [
            *([T.StructField("before", before)] if len(before) else []),
            T.StructField("after", row),
            T.StructField("op", TEXT),
            T.StructField("ts_ms", LONG),
            T.StructField("source", SOURCE_BLOCK),
        ]
    )
