"""The streaming star load: one pass over the feed per micro-batch, fanned out to six tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidestar import schemas
from tidestar.functions.checked import REJECT, conform_checked, good_rows, parse_checked, rejects, unwrap_checked
from tidestar.functions.decode import conform, decode_value, micros_to_ts, parse_json, rename, unwrap_cdc
from tidestar.operators.changes import latest_per_key
from tidestar.operators.gates import Gate
from tidestar.plans.star import clean_trips, gated_trips
from tidestar.plans.catalog import CatalogStar
from tidestar.plans.store import StarStore
from tidestar.streaming.rejects import write_rejects
from tidestar.streaming.run import query_id, with_trigger


def decode_trips(records: DataFrame, schema: T.StructType = schemas.WIRE_TRIPS, checked: bool = False) -> DataFrame:
    """Topic records of flat JSON trips to typed rows; ``checked`` marks the records that are not such trips."""
    return parse_checked(records, schema) if checked else parse_json(decode_value(records), schema)


def decode_captured_trips(records: DataFrame, wrapped: bool = False, checked: bool = False) -> DataFrame:
    """Topic records of change envelopes around raw trips to the rows of :func:`decode_trips`.

    Raw names are mapped, times read as microseconds; deletes have no trip to load. ``checked`` marks the records that
    are no envelopes, or hold values that do not fit.
    """
    if checked:
        records = records.filter(F.col("value").isNotNull())
        rows = unwrap_checked(records, schemas.CAPTURED_TRIPS, wrapped=wrapped, before=[])
        kept = rows.filter(F.col(REJECT).isNotNull() | (F.col("__deleted") == "false"))
        return conform_checked(rename(micros_to_ts(kept, schemas.EVENT_TIMES), schemas.TRIP_NAMES), schemas.WIRE_TRIPS)
    rows = unwrap_cdc(records, schemas.CAPTURED_TRIPS, keep_tombstones=False, wrapped=wrapped, before=[])
    kept = micros_to_ts(rows.filter(F.col("__deleted") == "false"), schemas.EVENT_TIMES)
    return conform(rename(kept, schemas.TRIP_NAMES), schemas.WIRE_TRIPS)


def captured_state(records: DataFrame, wrapped: bool = False) -> DataFrame:
    """The trips that a captured feed, read as a batch, leaves: the last image of each trip, without deleted ones.

    Records need their ``offset``, which orders the changes of a trip.
    """
    row = schemas.CAPTURED_TRIPS
    changes = unwrap_cdc(records, row, keep_tombstones=False, keep=["offset"], wrapped=wrapped, before=["trip_id"])
    last = latest_per_key(changes.withColumnRenamed("offset", "__offset"), ["trip_id"], ["__offset"])
    kept = micros_to_ts(last.filter(F.col("__deleted") == "false"), schemas.EVENT_TIMES)
    return conform(rename(kept, schemas.TRIP_NAMES), schemas.WIRE_TRIPS)


def star_sink(
    store: StarStore | CatalogStar, rejected: str | None = None, gate: Gate | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loads clean trips into the store, and the rejects of checked ones into a folder.

    With a ``gate`` the trips come as decoded: the sink counts the gate's rules over the good ones, ends the query where one
    is violated too often, before the batch writes anything but its rejects, and cleans the trips itself.

    Six table writes cannot commit together; a failure between them is repaired
    by the replay of the batch, which finds the dimension rows already there
    and, in a ``StarStore``, overwrites its own part of the fact.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # Read three times: keep it, so that the feed is fetched and decoded once.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            run, good = query_id(batch.sparkSession), batch
            if REJECT in batch.columns:
                good = good_rows(batch)
                if rejected:
                    write_rejects(rejects(batch), rejected, run, batch_id)
            if gate:
                store.load(clean_trips(good), run, batch_id, gated_trips(good, gate))
            else:
                store.load(good, run, batch_id)
        finally:
            batch.unpersist()

    return load


def start_star(
    trips: DataFrame,
    store: StarStore | CatalogStar,
    checkpoint: str,
    every: str | None = None,
    mode: str = "update",
    rejected: str | None = None,
    gate: Gate | None = None,
) -> StreamingQuery:
    """Start the load of decoded trips; only the columns the star needs are kept per micro-batch.

    Of checked trips the good ones are loaded. The others go to the folder ``rejected``, which ``read_rejects``
    reads; good rows that the quality filters drop are no rejects. A ``gate`` stops the query at a batch that violates its rules too often.
    """
    store.create(trips.sparkSession)
    checked = REJECT in trips.columns
    plain = trips.schema == schemas.WIRE_TRIPS or checked and trips.drop(REJECT).schema == schemas.WIRE_TRIPS
    if rejected and not checked:
        raise ValueError("only checked trips have rejects")
    if checked and not plain:
        raise ValueError("checked trips must have the wire columns")
    needed = trips if plain else conform(trips, schemas.WIRE_TRIPS)
    rows = needed if gate else clean_trips(needed)
    writer = rows.writeStream.foreachBatch(star_sink(store, rejected, gate)).outputMode(mode)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()
