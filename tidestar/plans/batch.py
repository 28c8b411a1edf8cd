"""Daily batch run of the star load."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.operators.gates import Gate
from tidestar.plans.star import clean_trips, gated_trips
from tidestar.plans.store import StarStore


def trips_of_day(trips: DataFrame, day: date) -> DataFrame:
    """Trips picked up on a day, as a range on the time itself so that it reaches the parquet scan."""
    pickup = trips.schema["tpep_pickup_datetime"].dataType
    start, end = [F.lit(str(d)).cast(pickup) for d in (day, day + timedelta(days=1))]
    return trips.filter((F.col("tpep_pickup_datetime") >= start) & (F.col("tpep_pickup_datetime") < end))


def run_batch(
    spark: SparkSession,
    trips: DataFrame | str,
    root: str,
    day: date | None = None,
    gate: Gate | None = None,
    report: Callable[[dict[str, int]], None] | None = None,
) -> StarStore:
    """Load one day of trips (a frame or a parquet path), or all of them, into the star under ``root``.

    A day that is run again replaces its own rows, whichever load brought them, and a load of all trips replaces all
    days. A load of all trips makes a folder for each month, not for each day.

    The rules of a ``gate`` are counted over the unfiltered trips in the first pass that the load makes anyway; where one is
    violated too often the load ends before anything is written, and else ``report`` gets the counts.
    """
    if isinstance(trips, str):
        trips = spark.read.parquet(trips)
    store = StarStore(root)
    store.create(spark)
    wanted = trips if day is None else trips_of_day(trips, day)
    batch_id = None if day is None else int(day.strftime("%Y%m%d"))
    store.load(clean_trips(wanted), "daily", batch_id, gated_trips(wanted, gate, report) if gate else None)
    return store
