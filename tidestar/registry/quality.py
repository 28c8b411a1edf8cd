"""Filters, fills, duplicates and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.operators import (
    Gate,
    check_rules,
    dedup,
    distinct_dim,
    duplicate_keys,
    fill,
    require_non_negative,
    require_not_null,
    unknown_codes,
)
from tidestar.plans import run_batch
from tidestar.registry.base import ORACLE, query, table
from tidestar.registry.fixtures import PAYMENTS_SQL, RATES_SQL, TRIPS_SQL, trips
from tidestar.session import work_dir
from tidestar.sources import payment_types, rate_codes

CHECKED = ", ".join(schemas.NON_NEGATIVE)


@query(
    "filter_non_negative",
    f"""WITH {TRIPS_SQL} SELECT PULocationID, DOLocationID, {CHECKED} FROM trips
    WHERE passenger_count >= 0 AND trip_distance >= 0 AND fare_amount >= 0 AND tip_amount >= 0 AND tolls_amount >= 0""",
)
def filter_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = require_non_negative(trips(spark, sf_dir), schemas.NON_NEGATIVE)
    return kept.select("PULocationID", "DOLocationID", *schemas.NON_NEGATIVE)


@query("filter_balance", "SELECT * FROM customer WHERE c_acctbal >= 0")
def filter_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_non_negative(table(spark, sf_dir, "customer"), ["c_acctbal"])


@query(
    "filter_not_null",
    f"""WITH {TRIPS_SQL} SELECT PULocationID, DOLocationID, tpep_pickup_datetime, tpep_dropoff_datetime FROM trips
    WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL""",
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = require_not_null(trips(spark, sf_dir), schemas.EVENT_TIMES)
    return kept.select("PULocationID", "DOLocationID", *schemas.EVENT_TIMES)


@query(
    "fill_nulls",
    f"""WITH {TRIPS_SQL} SELECT PULocationID, DOLocationID, coalesce(tip_amount, 0) AS tip_amount,
      coalesce(tolls_amount, 0) AS tolls_amount, coalesce(fare_amount, 0) AS fare_amount FROM trips""",
)
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill(trips(spark, sf_dir), schemas.FILL_ZERO)
    return filled.select("PULocationID", "DOLocationID", *schemas.FILL_ZERO)


@query("dedup_rows", "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that was delivered twice."""
    items = table(spark, sf_dir, "lineitem")
    return dedup(items.unionByName(items))


@query(
    "dedup_keys",
    """SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)
    WHERE rn = 1""",
)
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least row of each key, by its other columns in their order."""
    return dedup(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_projection", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_dim(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"])


@query(
    "check_constraints",
    f"""WITH {TRIPS_SQL}
    """
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT ({rule})) AS violations FROM trips"
        for name, rule in schemas.TRIP_RULES.items()
    ),
)
def check_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_rules(trips(spark, sf_dir), schemas.TRIP_RULES)


@query("observed_constraints", ORACLE["check_constraints"])
def observed_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts out of a load of the star, which takes them while it reads."""
    found: dict[str, int] = {}
    run_batch(spark, trips(spark, sf_dir), work_dir(spark, "gated_star"), gate=Gate(schemas.TRIP_RULES), report=found.update)
    return spark.createDataFrame(list(found.items()), "rule string, violations bigint")


@query(
    "pk_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _unknown_sql(codes: str, key: str) -> str:
    return f"""SELECT '{key}' AS list, t.{key} AS code, count(*) AS n_rows FROM trips t
      WHERE NOT EXISTS (SELECT 1 FROM {codes} c WHERE c.{key} = t.{key}) GROUP BY t.{key}"""


@query(
    "unknown_codes",
    f"""WITH {TRIPS_SQL}, {PAYMENTS_SQL}, {RATES_SQL}
    {_unknown_sql("payment_types", "payment_type")} UNION ALL {_unknown_sql("rate_codes", "ratecode_id")}""",
)
def unknown_trip_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips(spark, sf_dir)

    def report(codes: DataFrame, key: str) -> DataFrame:
        return unknown_codes(rows, codes, key).select(F.lit(key).alias("list"), F.col(key).alias("code"), "n_rows")

    return report(payment_types(spark), "payment_type").unionByName(report(rate_codes(spark), "ratecode_id"))
