"""The loads as applications: ``spark-submit tidestar/app.py <load> ...`` or ``python -m tidestar.app``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidestar import schemas
from tidestar.functions import good_rows
from tidestar.operators import create_star, enrich, fill, require_non_negative
from tidestar.plans import CatalogStar, StarStore, replica_changes, run_batch
from tidestar.session import build_session
from tidestar.sources import append_load, file_topic, payment_types, rate_codes, read_topic
from tidestar.streaming import (
    append_star,
    decode_captured_trips,
    decode_trips,
    merge_replica,
    replica_sink,
    run,
    start_star,
    stream_rejects,
)
from tidestar.streaming.run import with_trigger

REPLICA_KEY, REPLICA_ORDER = ["trip_id"], ["__offset"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidestar", description=__doc__)
    loads = top.add_subparsers(dest="load", required=True)

    def feed(name: str, text: str) -> argparse.ArgumentParser:
        sub = loads.add_parser(name, help=text)
        source = sub.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="broker bootstrap servers")
        source.add_argument("--files", help="folder of parquet topic files, in place of a broker")
        sub.add_argument("--topic", help="topic to subscribe to")
        sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="source option")
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--rejected", required=True, help="folder for records that can't be loaded, with the reason")
        sub.add_argument("--every", help="micro-batch interval; without it, load what is there and stop")
        return sub

    star = feed("stream-star", "merge a trip topic into the star")
    target = star.add_mutually_exclusive_group(required=True)
    target.add_argument("--root", help="folder of the stored star")
    target.add_argument("--database", help="database of a catalog that supports MERGE")
    star.add_argument("--captured", action="store_true", help="the topic holds change envelopes, not flat trips")
    star.add_argument("--table-format", default="iceberg", help="format of the database's tables")
    feed("append-star", "append a trip topic to six plain tables").add_argument("--database", required=True)
    replica = feed("stream-replica", "replicate a captured trip table, last write wins")
    replica.add_argument("--root", required=True)
    replica.add_argument("--merge", action="store_true", help="fold the finished batches afterwards")

    batch = loads.add_parser("batch-star", help="load a day of trips, or all, into the stored star")
    batch.add_argument("--source", required=True, help="parquet path of trips")
    batch.add_argument("--root", required=True)
    batch.add_argument("--day", type=date.fromisoformat)
    tables = loads.add_parser("create-star", help="create the database and its tables")
    tables.add_argument("--database", required=True)
    tables.add_argument("--table-format", default="parquet")
    append = loads.add_parser("append", help="append parquet files to a table")
    append.add_argument("--source", required=True)
    append.add_argument("--table", required=True)
    return top


def subscribe(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = dict(option.split("=", 1) for option in args.option)
    if args.files:
        return file_topic(spark, args.files, **options)
    if not args.topic:
        raise SystemExit("--servers needs --topic")
    return read_topic(spark, args.servers, args.topic, **options)


def described_trips(trips: DataFrame) -> DataFrame:
    """Decoded trips for the append tables: described, filtered and filled, times not checked."""
    spark = trips.sparkSession
    trips = enrich(trips, payment_types(spark), "payment_type")
    trips = enrich(trips, rate_codes(spark), "ratecode_id")
    return fill(require_non_negative(trips, schemas.NON_NEGATIVE), schemas.FILL_ZERO)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(f"tidestar-{args.load}")
    if args.load == "stream-star":
        star = StarStore(args.root) if args.root else CatalogStar(args.database, args.table_format)
        records = subscribe(spark, args)
        trips = decode_captured_trips(records, wrapped=True, checked=True) if args.captured else decode_trips(records, checked=True)
        run(start_star(trips, star, args.checkpoint, args.every, rejected=args.rejected))
    elif args.load == "append-star":
        trips = decode_trips(subscribe(spark, args), checked=True)
        queries = append_star(described_trips(good_rows(trips)), args.database, args.checkpoint, args.every)
        bad = stream_rejects(trips, args.rejected, f"{args.checkpoint}/rejected", args.every)
        run([*queries.values(), bad])
    elif args.load == "stream-replica":
        records = subscribe(spark, args)
        changes = replica_changes(
            records, schemas.CAPTURED_TRIPS, schemas.REPLICA, REPLICA_KEY, schemas.EVENT_TIMES, wrapped=True, checked=True
        )
        writer = changes.writeStream.foreachBatch(replica_sink(args.root, REPLICA_KEY, REPLICA_ORDER, args.rejected))
        run(with_trigger(writer.option("checkpointLocation", args.checkpoint), args.every).start())
        if args.merge:
            merge_replica(spark, args.root, good_rows(changes).schema, REPLICA_KEY, REPLICA_ORDER)
    elif args.load == "batch-star":
        run_batch(spark, args.source, args.root, args.day)
    elif args.load == "create-star":
        create_star(spark, args.database, source=args.table_format)
    else:
        append_load(spark, args.source, args.table)


if __name__ == "__main__":
    main()
