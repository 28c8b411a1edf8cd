"""From trip rows to the six tables of the star."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.functions.checked import REJECT, keeping_rejects
from tidestar.functions.derive import packed_digest
from tidestar.operators.enrich import star_join
from tidestar.operators.gates import Gate
from tidestar.operators.quality import fill, non_negative, not_null, require_non_negative, require_not_null
from tidestar.operators.star import build_dim, build_dim_datetime, build_fact
from tidestar.sources.codes import payment_types, rate_codes


def clean_trips(trips: DataFrame) -> DataFrame:
    """Filter, then fill: a null in a checked column drops the row before the fill could save it.

    A checked frame keeps its rejects.
    """
    if REJECT in trips.columns:
        kept = keeping_rejects(trips, [non_negative(schemas.NON_NEGATIVE), not_null(schemas.EVENT_TIMES)])
        return fill(kept, schemas.FILL_ZERO)
    kept = require_not_null(require_non_negative(trips, schemas.NON_NEGATIVE), schemas.EVENT_TIMES)
    return fill(kept, schemas.FILL_ZERO)


def gated_trips(
    trips: DataFrame, gate: Gate, report: Callable[[dict[str, int]], None] | None = None
) -> tuple[DataFrame, Callable[[], None]]:
    """Clean trips whose first pass counts the violations of all trips, and the check to make after that pass.

    The check raises where a rule is violated too often, and else gives the counts to ``report``.
    """
    rows, watched = gate.watch(trips)

    def check() -> None:
        counts = gate.check(watched)
        if report:
            report(counts)

    return clean_trips(rows), check


def code_dimensions(trips: DataFrame) -> dict[str, DataFrame]:
    """The four dimensions keyed by a value of the trip; descriptions are looked up per distinct code."""
    spark = trips.sparkSession
    return {
        "dim_passenger_count": build_dim(trips, "passenger_count"),
        "dim_payment_type": build_dim(trips, "payment_type", payment_types(spark)),
        "dim_ratecode": build_dim(trips, "ratecode_id", rate_codes(spark)),
        "dim_trip_distance": build_dim(trips, "trip_distance"),
    }


def star_tables(trips: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and fact of clean trips. The fact needs no description, so no lookup touches it."""
    return {"dim_datetime": build_dim_datetime(trips)} | code_dimensions(trips) | {"fact_trips": build_fact(trips)}


def packed_times(table: DataFrame) -> DataFrame:
    """The table with ``datetime_hash`` in half its bytes, for a join or a count that doesn't give it out."""
    return table.withColumn("datetime_hash", packed_digest("datetime_hash"))


def payment_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Trips, fares and active hours per payment type description, over the re-joined star."""
    dims = {"dim_datetime": packed_times(tables["dim_datetime"]), "dim_payment_type": tables["dim_payment_type"]}
    money = F.sum(F.col("fare_amount").cast("decimal(12,2)")).cast("decimal(22,2)")
    return (
        star_join(packed_times(tables["fact_trips"]), dims)
        .groupBy("payment_type_description")
        .agg(
            F.count(F.lit(1)).alias("n_trips"),
            money.alias("fares"),
            F.sum("pickup_hour").alias("pickup_hours"),
            F.min("pickup_year").alias("first_year"),
            F.max("dropoff_year").alias("last_year"),
        )
    )
