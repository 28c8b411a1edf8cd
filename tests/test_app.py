from __future__ import annotations

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.app import main
from tidestar.plans import CatalogStar, StarStore, clean_trips
from tidestar.registry.fixtures import captured_trip_feed, trip_feed, trips
from tidestar.streaming import read_replica


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("app") / "topic")
    trip_feed(spark, SMALL).write.parquet(path)
    return path


def test_stream_star_loads_a_topic(spark, topic, folder):
    main(["stream-star", "--files", topic, "--root", f"{folder}/star", "--checkpoint", f"{folder}/c", "--rejected", f"{folder}/bad"], spark)
    want = clean_trips(trips(spark, SMALL)).count()
    assert StarStore(f"{folder}/star").read(spark, "fact_trips").count() == want


def test_append_star_keeps_trips_without_times(spark, topic, folder):
    main(["create-star", "--database", "app_star"], spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS app_plain")
    main(["append-star", "--files", topic, "--database", "app_plain", "--checkpoint", f"{folder}/c", "--rejected", f"{folder}/bad"], spark)
    fact = spark.table("app_plain.fact_trips")
    assert fact.filter("tpep_pickup_datetime IS NULL").count() > 0
    assert fact.count() == spark.table("app_plain.dim_payment_type").count() > 0


def test_append_star_refuses_the_merged_tables(spark, topic, folder):
    main(["create-star", "--database", "app_merged"], spark)
    with pytest.raises(ValueError, match="other columns"):
        main(["append-star", "--files", topic, "--database", "app_merged", "--checkpoint", f"{folder}/c", "--rejected", f"{folder}/bad"], spark)
    assert spark.table("app_merged.fact_trips").count() == 0


def test_replica_and_star_of_wrapped_envelopes(spark, folder):
    wrap = F.concat(F.lit('{"schema":{},"payload":'), F.col("value").cast("string"), F.lit("}")).cast("binary")
    key = F.concat(F.lit('{"schema":{},"payload":'), F.col("key").cast("string"), F.lit("}")).cast("binary")
    feed = captured_trip_feed(spark, SMALL).withColumns(
        {"key": key, "value": wrap, "topic": F.lit("t"), "partition": F.lit(0), "offset": F.monotonically_increasing_id()}
    )
    feed.withColumn("timestamp", F.lit(None).cast("timestamp")).write.parquet(f"{folder}/topic")
    args = ["--files", f"{folder}/topic", "--root", f"{folder}/replica", "--checkpoint", f"{folder}/c", "--rejected", f"{folder}/bad", "--merge"]
    main(["stream-replica", *args], spark)
    star = StarStore(f"{folder}/star")
    args = ["--files", f"{folder}/topic", "--root", star.root, "--checkpoint", f"{folder}/c2", "--rejected", f"{folder}/bad2", "--captured"]
    main(["stream-star", *args], spark)
    assert star.read(spark, "fact_trips").count() == clean_trips(trips(spark, SMALL)).count()
    marks = schemas.struct((schemas.TEXT, "__op __deleted"), (schemas.LONG, "__ts_ms __lsn __offset"))
    schema = type(marks)([*schemas.REPLICA, *marks])
    got = read_replica(spark, f"{folder}/replica", schema, ["trip_id"], ["__offset"])
    raw = trips(spark, SMALL)
    assert got.columns == schemas.REPLICA.fieldNames()
    assert got.count() == raw.count()
    assert rows(got.agg(F.min("tpep_pickup_datetime").cast("timestamp_ntz"))) == rows(raw.agg(F.min("tpep_pickup_datetime")))
    assert rows(got.agg(F.sum(F.col("fare_amount").cast("decimal(12,2)")))) == rows(
        raw.agg(F.sum(F.col("fare_amount").cast("decimal(12,2)")))
    )


def test_batch_star_takes_a_day(spark, folder):
    trips(spark, SMALL).write.parquet(f"{folder}/trips")
    day = clean_trips(trips(spark, SMALL)).select(F.to_date("tpep_pickup_datetime").alias("d")).first().d
    main(["batch-star", "--source", f"{folder}/trips", "--root", f"{folder}/star", "--day", str(day)], spark)
    got = StarStore(f"{folder}/star").stored(spark, "fact_trips").select("pickup_date").distinct()
    assert rows(got) == [(day,)]


def test_append_to_a_table(spark, folder):
    spark.sql("CREATE TABLE app_orders AS SELECT * FROM parquet.`%s/orders.parquet` LIMIT 0" % SMALL)
    main(["append", "--source", f"{SMALL}/orders.parquet", "--table", "app_orders"], spark)
    assert spark.table("app_orders").count() == 1500
    spark.sql("DROP TABLE app_orders")


def test_catalog_star_issues_merges(spark):
    """Plain tables refuse MERGE, which shows that one was issued; a row-level catalog is not at hand here."""
    star = CatalogStar("app_catalog", source="parquet")
    star.create(spark)
    with pytest.raises(Exception, match="(?i)merge"):
        star.load(clean_trips(trips(spark, SMALL)), "r", 0)
    assert set(star.tables(spark)) == set(schemas.STAR_TABLES)


def test_a_broker_needs_a_topic(spark, folder):
    with pytest.raises(SystemExit, match="topic"):
        main(["stream-star", "--servers", "b:9092", "--root", folder, "--checkpoint", f"{folder}/c", "--rejected", f"{folder}/bad"], spark)
