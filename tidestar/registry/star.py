"""Enrichment, star tables and star joins."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.operators import build_dim, build_dim_datetime, build_fact, enrich, orphans, star_join
from tidestar.operators.star import FACT_COLUMNS, RAW_FACT_COLUMNS
from tidestar.plans import BucketedStar, clean_trips, payment_summary, run_batch, star_tables
from tidestar.plans.star import code_dimensions, packed_times
from tidestar.registry.base import ORACLE, query, without_zone
from tidestar.registry.fixtures import (
    CLEAN_SQL,
    LIVE_SQL,
    PARTS_SQL,
    PAYMENTS_SQL,
    RATES_SQL,
    TRIPS_SQL,
    captured_changes,
    trips,
)
from tidestar.session import stored, work_dir
from tidestar.sources import payment_types, rate_codes
from tidestar.streaming import captured_state

FACT_LIST = ", ".join(schemas.FACT_TRIPS.fieldNames())
SOME = ["PULocationID", "DOLocationID", "fare_amount"]


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips(spark, sf_dir))


@query(
    "enrich_payment_type",
    f"""WITH {TRIPS_SQL}, {PAYMENTS_SQL}
    SELECT t.payment_type, t.PULocationID, t.DOLocationID, t.fare_amount, p.payment_type_description
    FROM trips t LEFT JOIN payment_types p ON p.payment_type = t.payment_type""",
)
def enrich_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(trips(spark, sf_dir).select("payment_type", *SOME), payment_types(spark), "payment_type")


@query(
    "enrich_trips",
    f"""WITH {TRIPS_SQL}, {PAYMENTS_SQL}, {RATES_SQL}
    SELECT t.ratecode_id, t.payment_type, t.PULocationID, t.DOLocationID, t.fare_amount,
           p.payment_type_description, r.ratecode_description
    FROM trips t LEFT JOIN payment_types p ON p.payment_type = t.payment_type
                 LEFT JOIN rate_codes r ON r.ratecode_id = t.ratecode_id""",
)
def enrich_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips(spark, sf_dir).select("payment_type", "ratecode_id", *SOME)
    return enrich(enrich(rows, payment_types(spark), "payment_type"), rate_codes(spark), "ratecode_id")


DIM_DATETIME_SQL = f"""SELECT DISTINCT datetime_hash, tpep_pickup_datetime, tpep_dropoff_datetime, {PARTS_SQL}
    FROM clean"""


@query("dim_datetime", f"WITH {CLEAN_SQL} {DIM_DATETIME_SQL}")
def dim_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_datetime(_clean(spark, sf_dir))


@query(
    "dim_datetime_raw",
    f"WITH {CLEAN_SQL} SELECT tpep_pickup_datetime, tpep_dropoff_datetime, {PARTS_SQL} FROM clean",
)
def dim_datetime_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_datetime(_clean(spark, sf_dir), hashed=False)


@query("dim_passenger_count", f"WITH {CLEAN_SQL} SELECT DISTINCT passenger_count FROM clean")
def dim_passenger_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(_clean(spark, sf_dir), "passenger_count")


@query(
    "dim_ratecode",
    f"""WITH {CLEAN_SQL}, {RATES_SQL} SELECT DISTINCT c.ratecode_id, r.ratecode_description
    FROM clean c LEFT JOIN rate_codes r ON r.ratecode_id = c.ratecode_id""",
)
def dim_ratecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(_clean(spark, sf_dir), "ratecode_id", rate_codes(spark))


@query(
    "dim_payment_type",
    f"""WITH {CLEAN_SQL}, {PAYMENTS_SQL} SELECT DISTINCT c.payment_type, p.payment_type_description
    FROM clean c LEFT JOIN payment_types p ON p.payment_type = c.payment_type""",
)
def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(_clean(spark, sf_dir), "payment_type", payment_types(spark))


@query("dim_trip_distance", f"WITH {CLEAN_SQL} SELECT DISTINCT trip_distance FROM clean")
def dim_trip_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim(_clean(spark, sf_dir), "trip_distance")


@query("fact_trips", f"WITH {CLEAN_SQL} SELECT {FACT_LIST} FROM clean")
def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(_clean(spark, sf_dir))


@query("fact_trips_raw", f"WITH {CLEAN_SQL} SELECT {', '.join(RAW_FACT_COLUMNS)} FROM clean")
def fact_trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(_clean(spark, sf_dir), hashed=False)


@query(
    "star_join",
    f"""WITH {CLEAN_SQL}, {PAYMENTS_SQL}, {RATES_SQL}
    SELECT {", ".join("c." + c for c in schemas.FACT_TRIPS.fieldNames())},
           tpep_pickup_datetime, tpep_dropoff_datetime, {PARTS_SQL}, payment_type_description, ratecode_description
    FROM clean c LEFT JOIN payment_types p ON p.payment_type = c.payment_type
                 LEFT JOIN rate_codes r ON r.ratecode_id = c.ratecode_id""",
)
def star_join_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star_tables(_clean(spark, sf_dir))
    return star_join(tables.pop("fact_trips"), tables)


@query("star_join_bucketed", ORACLE["star_join"])
def star_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join over tables laid out for it: written once in buckets, joined without a shuffle."""
    clean = _clean(spark, sf_dir)
    star = BucketedStar("default", f"star_{uuid.uuid4().hex}_", buckets=16)
    star.write(clean, work_dir(spark, "bucketed_star"))
    codes = {name: stored(rows, name) for name, rows in code_dimensions(clean).items()}  # of known size: else the joined rows are shuffled
    return without_zone(star_join(star.joined(spark), codes))


SUMMARY_SQL = f"""WITH {CLEAN_SQL}, {PAYMENTS_SQL}
    SELECT payment_type_description, count(*) AS n_trips,
           CAST(sum(CAST(fare_amount AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS fares,
           CAST(sum(extract(hour FROM tpep_pickup_datetime)) AS BIGINT) AS pickup_hours,
           CAST(min(extract(year FROM tpep_pickup_datetime)) AS INTEGER) AS first_year,
           CAST(max(extract(year FROM tpep_dropoff_datetime)) AS INTEGER) AS last_year
    FROM clean c LEFT JOIN payment_types p ON p.payment_type = c.payment_type
    GROUP BY payment_type_description"""


@query("star_payment_summary", SUMMARY_SQL)
def star_payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole star built and joined back."""
    return payment_summary(star_tables(_clean(spark, sf_dir)))


@query(
    "fk_orphans",
    f"""WITH {CLEAN_SQL}, {RATES_SQL}, loaded AS (SELECT DISTINCT datetime_hash FROM clean WHERE load_wave = 1)
    SELECT 'datetime_hash' AS fk, c.datetime_hash AS fk_value, count(*) AS n_rows, c.datetime_hash IS NULL AS null_key
    FROM clean c WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.datetime_hash = c.datetime_hash)
    GROUP BY c.datetime_hash
    UNION ALL
    SELECT 'ratecode_id', CAST(c.ratecode_id AS VARCHAR), count(*), c.ratecode_id IS NULL
    FROM clean c WHERE NOT EXISTS (SELECT 1 FROM rate_codes r WHERE r.ratecode_id = c.ratecode_id)
    GROUP BY c.ratecode_id""",
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts against the times of the first load, and against the plain code list."""
    rows = _clean(spark, sf_dir)
    fact = build_fact(rows)

    def report(dim: DataFrame, key: str) -> DataFrame:
        value = F.col(key).cast("string").alias("fk_value")
        return orphans(fact, dim, [key]).select(F.lit(key).alias("fk"), value, "n_rows", "null_key")

    first_load = build_dim_datetime(rows.filter("load_wave = 1"))
    return report(first_load, "datetime_hash").unionByName(report(rate_codes(spark), "ratecode_id"))


@query("cdc_star_state", f"WITH {LIVE_SQL} SELECT {FACT_LIST} FROM clean")
def cdc_star_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the trips that creates, updates and deletes leave."""
    left = captured_state(captured_changes(spark, sf_dir))
    return without_zone(build_fact(clean_trips(left)))


DAY_SQL = f"""WITH {CLEAN_SQL}, first_day AS (SELECT min(CAST(tpep_pickup_datetime AS DATE)) AS d FROM trips)
    SELECT {FACT_LIST} FROM clean"""


def _first_day(spark: SparkSession, sf_dir: str) -> date:
    return trips(spark, sf_dir).agg(F.min(F.to_date("tpep_pickup_datetime"))).first()[0]


@query("batch_one_day", f"{DAY_SQL} WHERE CAST(tpep_pickup_datetime AS DATE) = (SELECT d FROM first_day)")
def batch_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day loaded, twice."""
    root, day = work_dir(spark, "batch_star"), _first_day(spark, sf_dir)
    run_batch(spark, trips(spark, sf_dir), root, day)
    store = run_batch(spark, trips(spark, sf_dir), root, day)
    return without_zone(store.read(spark, "fact_trips").select(*FACT_COLUMNS))


@query("batch_day_again", DAY_SQL)
def batch_day_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips loaded, then their first day again, which replaces its own rows."""
    root = work_dir(spark, "batch_star")
    run_batch(spark, trips(spark, sf_dir), root)
    store = run_batch(spark, trips(spark, sf_dir), root, _first_day(spark, sf_dir))
    return without_zone(store.read(spark, "fact_trips").select(*FACT_COLUMNS))


@query(
    "batch_star_day",
    f"""WITH {CLEAN_SQL}
    SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date, count(*) AS n_trips,
           count(DISTINCT datetime_hash) AS n_times,
           CAST(sum(CAST(fare_amount AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS fares
    FROM clean GROUP BY 1""",
)
def batch_star_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day loaded into stored star tables, then read back per day folder and joined to its times."""
    store = run_batch(spark, trips(spark, sf_dir), work_dir(spark, "batch_star"))
    times = store.read(spark, "dim_datetime").select("datetime_hash", "tpep_pickup_datetime")
    joined = star_join(packed_times(store.stored(spark, "fact_trips")), {"dim_datetime": packed_times(times)})
    daily = joined.groupBy("pickup_date").agg(
        F.count("tpep_pickup_datetime").alias("n_trips"),
        F.countDistinct("datetime_hash").alias("n_times"),
        F.sum(F.col("fare_amount").cast("decimal(12,2)")).cast("decimal(22,2)").alias("fares"),
    )
    return without_zone(daily)
