"""Streaming loads: equal to the batch, safe to replay and to restart."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.operators import create_star, dedup, enrich, require_non_negative
from tidestar.plans import StarStore, clean_trips, replica_changes, run_batch, star_tables
from tidestar.registry.fixtures import USER_ROW, trip_feed, trips, user_feed
from tidestar.sources import append_load, file_topic, payment_types, rate_codes, read_topic
from tidestar.streaming import (
    append,
    append_star,
    decode_trips,
    merge_replica,
    query_id,
    read_replica,
    replica_sink,
    run,
    start_star,
    stream_append,
)


def lay(feed, path, files):
    """One topic file per piece, so that one file per trigger makes one batch per piece."""
    feed.repartition(files).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def trip_topic(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topic") / "trips")
    lay(trip_feed(spark, SMALL), path, 3)
    return path


def one_by_one(spark, path):
    return file_topic(spark, path, maxFilesPerTrigger="1")


def undo_last_commit(checkpoint):
    """Forget that the last batch finished, as after a crash between its writes and its commit."""
    commits = sorted((p for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    Path(checkpoint, "commits", f".{commits[-1].name}.crc").unlink(missing_ok=True)


def expected_star(spark):
    return {n: df for n, df in star_tables(clean_trips(trips(spark, SMALL))).items()}


def check_star(spark, store):
    for name, want in expected_star(spark).items():
        got = store.read(spark, name)
        assert got.schema == schemas.STAR_TABLES[name]
        plain = [F.col(f.name).cast("timestamp_ntz") if f.dataType == schemas.TS else F.col(f.name) for f in got.schema]
        assert rows(got.select(*plain)) == rows(want.select(*got.columns)), name


def test_stream_equals_batch_and_survives_replay_and_restart(spark, trip_topic, folder):
    store, checkpoint = StarStore(f"{folder}/star"), f"{folder}/checkpoint"
    query = start_star(decode_trips(one_by_one(spark, trip_topic)), store, checkpoint)
    run(query)
    assert query.lastProgress["batchId"] == 2
    check_star(spark, store)

    undo_last_commit(checkpoint)
    run(start_star(decode_trips(one_by_one(spark, trip_topic)), store, checkpoint))
    check_star(spark, store)

    run(start_star(decode_trips(one_by_one(spark, trip_topic)), store, checkpoint))
    check_star(spark, store)
    assert store.stored(spark, "fact_trips").select("run").distinct().count() == 1
    assert store.stored(spark, "fact_trips").select("batch_id").distinct().count() == 3


def test_failure_between_tables_is_repaired_by_the_replay(spark, trip_topic, folder, monkeypatch):
    store, checkpoint = StarStore(f"{folder}/star"), f"{folder}/checkpoint"

    def broken(*_):
        raise RuntimeError("lost the fact")

    with monkeypatch.context() as patch:
        patch.setattr(StarStore, "_write_fact", broken)
        with pytest.raises(Exception, match="lost the fact"):
            run(start_star(decode_trips(one_by_one(spark, trip_topic)), store, checkpoint))
    assert store.read(spark, "dim_datetime").count() > 0
    assert store.read(spark, "fact_trips").count() == 0
    run(start_star(decode_trips(one_by_one(spark, trip_topic)), store, checkpoint))
    check_star(spark, store)


def test_a_new_checkpoint_does_not_overwrite_the_batches_of_another(spark, trip_topic, folder):
    store = StarStore(f"{folder}/star")
    for name in ("first", "second"):
        run(start_star(decode_trips(file_topic(spark, trip_topic)), store, f"{folder}/{name}"))
    once = expected_star(spark)["fact_trips"].count()
    assert store.read(spark, "fact_trips").count() == 2 * once
    assert store.read(spark, "dim_datetime").count() == expected_star(spark)["dim_datetime"].count()


def test_query_id_is_known_only_inside_a_micro_batch(spark):
    with pytest.raises(RuntimeError, match="no streaming query"):
        query_id(spark)


def test_daily_batches_can_be_run_again(spark, folder):
    rows_of = clean_trips(trips(spark, SMALL)).withColumn("day", F.to_date("tpep_pickup_datetime"))
    days = [r.day for r in rows_of.groupBy("day").count().orderBy(F.desc("count"), "day").limit(2).collect()]
    for day in [*days, days[0]]:
        store = run_batch(spark, trips(spark, SMALL), f"{folder}/daily", day)
    want = rows_of.filter(F.col("day").isin(days))
    assert store.read(spark, "fact_trips").count() == want.count()
    one = store.stored(spark, "fact_trips", days[0], days[0])
    assert one.count() == rows_of.filter(F.col("day") == days[0]).count()
    times = store.stored(spark, "dim_datetime", days[0], days[0])
    assert rows(times.select(F.to_date("tpep_pickup_datetime")).distinct()) == [(days[0],)]


def test_a_day_run_again_without_its_trips_is_emptied(spark, folder):
    rows_of = clean_trips(trips(spark, SMALL)).withColumn("day", F.to_date("tpep_pickup_datetime"))
    first, second = [r.day for r in rows_of.select("day").distinct().orderBy("day").limit(2).collect()]
    for source in (trips(spark, SMALL), trips(spark, SMALL).filter(F.to_date("tpep_pickup_datetime") != second)):
        for day in (first, second):
            store = run_batch(spark, source, f"{folder}/star", day)
    assert rows(store.stored(spark, "fact_trips").select("pickup_date").distinct()) == [(first,)]


def test_days_and_whole_loads_replace_each_other(spark, folder):
    source = trips(spark, SMALL)
    rows_of = clean_trips(source).withColumn("day", F.to_date("tpep_pickup_datetime"))
    days = [r.day for r in rows_of.select("day").distinct().orderBy("day").limit(3).collect()]
    run_batch(spark, source, f"{folder}/star", days[0])
    store = run_batch(spark, source, f"{folder}/star")
    months = rows_of.select(F.date_trunc("month", "day")).distinct().count()
    assert len(list(Path(folder, "star", "fact_trips").glob("run=*/batch_id=*/*/*"))) == months
    run_batch(spark, source, f"{folder}/star", days[0])
    fewer = source.filter(F.to_date("tpep_pickup_datetime") != days[1])
    run_batch(spark, fewer, f"{folder}/star", days[1])
    got = store.stored(spark, "fact_trips")
    assert got.count() == rows_of.filter(F.col("day") != days[1]).count()
    assert got.filter(F.col("pickup_date") == days[0]).count() == rows_of.filter(F.col("day") == days[0]).count()
    run_batch(spark, source, f"{folder}/star")
    assert store.read(spark, "fact_trips").count() == rows_of.count()


def test_empty_batch_writes_nothing(spark, folder):
    none = trips(spark, SMALL).filter("false")
    store = run_batch(spark, none, f"{folder}/star")
    assert all(df.isEmpty() for df in store.tables(spark).values())


def test_store_is_visible_to_sql(spark, folder):
    store = run_batch(spark, trips(spark, SMALL), f"{folder}/star")
    store.register(spark)
    lost = spark.sql("SELECT count(*) FROM fact_trips f LEFT ANTI JOIN dim_datetime d ON f.datetime_hash = d.datetime_hash")
    assert rows(lost) == [(0,)]


def test_tables_are_created_once(spark):
    for _ in range(2):
        create_star(spark, "made_once")
    names = {r.tableName for r in spark.sql("SHOW TABLES IN made_once").collect()}
    assert names == set(schemas.STAR_TABLES)
    assert spark.table("made_once.fact_trips").schema == schemas.FACT_TRIPS


def test_six_append_queries_resume_from_their_checkpoints(spark, trip_topic, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS plain_appends")

    def described():
        decoded = require_non_negative(decode_trips(one_by_one(spark, trip_topic)), schemas.NON_NEGATIVE)
        return enrich(enrich(decoded, payment_types(spark), "payment_type"), rate_codes(spark), "ratecode_id")

    for _ in range(2):
        queries = append_star(described(), "plain_appends", f"{folder}/checkpoints")
        run(queries.values())
    kept = require_non_negative(trips(spark, SMALL), schemas.NON_NEGATIVE)
    for name in schemas.STAR_TABLES:
        assert spark.table(f"plain_appends.{name}").count() == kept.count(), name
    assert spark.table("plain_appends.fact_trips").columns == schemas.WIRE_TRIPS.fieldNames()


def test_stream_append_restarts_where_it_stopped(spark, folder):
    schema = "k int"
    source, location = f"{folder}/in", f"{folder}/out"
    spark.sql(f"CREATE TABLE restarted (k int) USING parquet LOCATION '{location}'")
    for wave in (range(0, 5), range(5, 8)):
        spark.createDataFrame([(k,) for k in wave], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        run(stream_append(stream, "restarted", f"{folder}/checkpoint"))
    assert rows(spark.read.parquet(location)) == [(k,) for k in range(8)]
    spark.sql("DROP TABLE restarted")


def test_batch_append_and_load_match_columns_by_name(spark, folder):
    spark.sql("CREATE TABLE by_name (a int, b string) USING parquet")
    frame = spark.createDataFrame([("x", 1)], "b string, a int")
    append(frame, "by_name")
    frame.write.parquet(f"{folder}/load")
    append_load(spark, f"{folder}/load", "by_name")
    assert rows(spark.table("by_name")) == [(1, "x"), (1, "x")]
    spark.sql("DROP TABLE by_name")


def test_replica_converges_over_batches_and_replay(spark, folder):
    topic, root, checkpoint = f"{folder}/topic", f"{folder}/replica", f"{folder}/checkpoint"
    lay(user_feed(spark, SMALL), topic, 4)

    def load():
        changes = replica_changes(one_by_one(spark, topic), USER_ROW, USER_ROW, ["user_id"])
        writer = changes.writeStream.foreachBatch(replica_sink(root, ["user_id"], ["__offset"]))
        run(writer.trigger(availableNow=True).option("checkpointLocation", checkpoint).start())
        return changes.schema

    load()
    undo_last_commit(checkpoint)
    schema = load()
    changes = replica_changes(spark.read.parquet(topic), USER_ROW, USER_ROW, ["user_id"])
    last = {}
    for r in sorted(changes.collect(), key=lambda r: r["__offset"]):
        last[r.user_id] = r
    live = {k: r for k, r in last.items() if r["__deleted"] == "false"}

    def check():
        for deletes, want in (("keep", last), ("apply", live)):
            got = read_replica(spark, root, schema, ["user_id"], ["__offset"], deletes).collect()
            assert sorted((r.user_id, r.event_id) for r in got) == sorted((k, r.event_id) for k, r in want.items())

    check()
    assert merge_replica(spark, root, schema, ["user_id"], ["__offset"]) == 4
    check()
    assert spark.read.schema(schema).parquet(root).count() == len(last)
    undo_last_commit(checkpoint)
    load()
    check()
    assert merge_replica(spark, root, schema, ["user_id"], ["__offset"]) == 2
    check()
    assert merge_replica(spark, root, schema, ["user_id"], ["__offset"]) == 0


def test_broker_source_needs_only_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "broker:9092", "trips", maxOffsetsPerTrigger="10")


def test_topic_records_round_trip_through_json(spark):
    record = trip_feed(spark, SMALL).select(F.col("value").cast("string")).first()[0]
    assert set(json.loads(record)) <= set(schemas.WIRE_TRIPS.fieldNames())


def test_stream_dedup_drops_repeats_across_batches(spark, folder):
    schema = "k int, t timestamp"
    row = spark.sql("SELECT 1 AS k, timestamp'2025-01-01 00:00:00' AS t UNION ALL SELECT 2, timestamp'2025-01-01 00:01:00'")
    spark.sql(f"CREATE TABLE once_each (k int, t timestamp) USING parquet LOCATION '{folder}/out'")
    for _ in range(2):
        row.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = dedup(spark.readStream.schema(schema).parquet(f"{folder}/in"), ["k"], "t", "1 hour")
        run(stream_append(stream, "once_each", f"{folder}/checkpoint"))
    assert rows(spark.read.parquet(f"{folder}/out").select("k")) == [(1,), (2,)]
    spark.sql("DROP TABLE once_each")
