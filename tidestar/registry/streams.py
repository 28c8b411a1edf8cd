"""Streaming runs over topics laid down from the given tables; each runs to the end of its input, then is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestar.functions import record_key, unwrap_cdc
from tidestar.operators.changes import apply_changes
from tidestar.operators.star import FACT_COLUMNS
from tidestar.plans import StarStore, payment_summary, replica_changes
from tidestar.registry.base import query, table, without_zone
from tidestar.registry.changes import CURRENT_SQL, REPLICA_SQL
from tidestar.registry.fixtures import CLEAN_SQL, MESSY_TRIP_SQL, USER_KEY, USER_ROW, messy_trip_feed, trip_feed, user_feed
from tidestar.registry.scans import columns_of, scratch_table
from tidestar.registry.star import DIM_DATETIME_SQL, FACT_LIST, SUMMARY_SQL
from tidestar.session import work_dir
from tidestar.sources import file_topic, route
from tidestar.streaming import (
    decode_trips,
    read_handover,
    read_rejects,
    read_replica,
    read_routed,
    replica_sink,
    routed_sink,
    run,
    start_handover,
    start_latest,
    start_star,
    stream_append,
    take_snapshot,
)

# A few micro-batches over a small topic; over a large one as many as its files need, each of bounded size.
BATCHES, MAX_FILES = 3, 1000
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def lay_topic(spark: SparkSession, feed: DataFrame, label: str) -> DataFrame:
    """Write a feed by topic partition and subscribe to the files, in a few micro-batches."""
    path = work_dir(spark, label)
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, "64")  # a file is open for each topic partition, in place of a sort of the texts
    try:
        feed.write.option("compression", "zstd").partitionBy("topic", "partition").parquet(path)
    finally:
        spark.conf.set(WRITERS, before)
    files = len(spark.read.parquet(path).inputFiles())
    return file_topic(spark, path, maxFilesPerTrigger=str(min(-(-files // BATCHES), MAX_FILES)))


@query(
    "stream_file_source",
    """SELECT event_id AS feed_offset, concat('{"user_id":', user_id, '}') AS json,
      CASE WHEN event_type <> 'error' THEN props END AS props, event_type = 'error' AS deleted FROM events""",
)
def stream_file_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subscription to the user topic, its keys and values decoded and appended to a table."""
    topic = lay_topic(spark, user_feed(spark, sf_dir), "user_topic")
    text = topic.withColumn("json", F.col("key").cast("string"))
    changes = unwrap_cdc(text, USER_ROW, keep=["offset", "json"])
    rows = changes.select(F.col("offset").alias("feed_offset"), "json", "props", (F.col("__deleted") == "true").alias("deleted"))
    return _append(spark, rows, "stream_file_source")


def _append(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    name, location = scratch_table(spark, label, columns_of(rows))
    run(stream_append(rows, name, work_dir(spark, "checkpoint")))
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(rows.schema).parquet(location)


@query("stream_append", "SELECT * FROM events")
def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return _append(spark, spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet"), "stream_append")


def _stream_star(spark: SparkSession, sf_dir: str) -> StarStore:
    topic = lay_topic(spark, trip_feed(spark, sf_dir), "trip_topic")
    store = StarStore(work_dir(spark, "stream_star"))
    run(start_star(decode_trips(topic), store, work_dir(spark, "checkpoint")))
    return store


@query("stream_star_fact", f"WITH {CLEAN_SQL} SELECT {FACT_LIST} FROM clean")
def stream_star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(_stream_star(spark, sf_dir).read(spark, "fact_trips").select(*FACT_COLUMNS))


@query("stream_star_times", f"WITH {CLEAN_SQL} {DIM_DATETIME_SQL}")
def stream_star_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(_stream_star(spark, sf_dir).read(spark, "dim_datetime"))


@query("stream_star_summary", SUMMARY_SQL)
def stream_star_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed star joined back, dimension by dimension."""
    return payment_summary(_stream_star(spark, sf_dir).tables(spark))


def _stream_messy(spark: SparkSession, sf_dir: str) -> tuple[StarStore, DataFrame]:
    """The star of a feed with bad records, and the rejects that its load wrote beside it."""
    topic = lay_topic(spark, messy_trip_feed(spark, sf_dir), "messy_topic")
    store = StarStore(work_dir(spark, "messy_star"))
    bad = work_dir(spark, "rejected")
    run(start_star(decode_trips(topic, checked=True), store, work_dir(spark, "checkpoint"), rejected=bad))
    return store, read_rejects(spark, bad)


@query(
    "stream_bad_records",
    f"""SELECT CASE WHEN mess = 'null value' THEN 'no value' ELSE 'does not parse' END AS reason,
      CASE WHEN mess = 'oops' THEN mess END AS text, l_partkey AS feed_offset
    FROM (SELECT l_partkey, {MESSY_TRIP_SQL} AS mess FROM lineitem) WHERE mess IS NOT NULL""",
)
def stream_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load could not take, as its side output tells it."""
    bad = _stream_messy(spark, sf_dir)[1]
    text = F.when(F.col("value") == "oops", F.col("value"))
    return bad.select("reason", text.alias("text"), F.col("offset").alias("feed_offset"))


@query(
    "stream_good_records",
    f"WITH {CLEAN_SQL.replace('FROM lineitem', f'FROM lineitem WHERE {MESSY_TRIP_SQL} IS NULL')} SELECT {FACT_LIST} FROM clean",
)
def stream_good_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the same load: the good side, after the quality filters."""
    return without_zone(_stream_messy(spark, sf_dir)[0].read(spark, "fact_trips").select(*FACT_COLUMNS))


@query("stream_replica", REPLICA_SQL)
def stream_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user topic replicated: last write per key wins, deleted keys stay visible."""
    topic = lay_topic(spark, user_feed(spark, sf_dir), "user_topic")
    changes = replica_changes(topic, USER_ROW, USER_ROW, ["user_id"])
    root, keys, order = work_dir(spark, "replica"), ["user_id"], ["__offset"]
    writer = changes.writeStream.foreachBatch(replica_sink(root, keys, order)).trigger(availableNow=True)
    run(writer.option("checkpointLocation", work_dir(spark, "checkpoint")).start())
    return read_replica(spark, root, changes.schema, keys, order)


@query("stream_bootstrap", CURRENT_SQL)
def stream_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot read in two chunks at different positions, then the feed, which begins before either."""
    root, keys = work_dir(spark, "handover"), ["user_id"]
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    early, late = last // 2, last * 5 // 8
    feed = user_feed(spark, sf_dir)
    read_at = F.when(F.col("user_id") % 2 == 0, early).otherwise(late)
    past = unwrap_cdc(feed, USER_ROW, keep=["offset"]).withColumnRenamed("offset", "__offset").drop("source")
    snapshot = apply_changes(None, past.withColumn("at", read_at).filter("__offset <= at").drop("at"), keys, ["__offset"])
    changes = replica_changes(lay_topic(spark, feed.filter(F.col("offset") > last // 4), "user_topic"), USER_ROW, USER_ROW, keys)
    take_snapshot(snapshot.withColumn("__lsn", read_at), early, root, changes.schema)
    run(start_handover(changes, root, keys, work_dir(spark, "checkpoint")))
    return read_handover(spark, root, changes.schema, keys)


@query("stream_latest_per_key", REPLICA_SQL)
def stream_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change per user as the state of a streaming aggregate that emits the keys each batch touched."""
    changes = replica_changes(lay_topic(spark, user_feed(spark, sf_dir), "user_topic"), USER_ROW, USER_ROW, ["user_id"])
    root, keys, order = work_dir(spark, "latest"), ["user_id"], ["__offset"]
    run(start_latest(changes, keys, order, root, work_dir(spark, "checkpoint")))
    return read_replica(spark, root, changes.schema, keys, order)


@query(
    "stream_route",
    """SELECT CASE event_type WHEN 'purchase' THEN 'purchases' ELSE 'app.public.activity' END AS routed_to,
      event_id AS feed_offset, user_id, CASE WHEN event_type <> 'error' THEN props END AS props FROM events""",
)
def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics routed to table folders in one pass, whole records, then both tables read back."""
    records = lay_topic(spark, user_feed(spark, sf_dir), "user_topic").select("key", "value", "offset", "topic")
    routed, root = route(records, {"app.public.purchases": "purchases"}), work_dir(spark, "routed")
    writer = routed.writeStream.foreachBatch(routed_sink(root)).trigger(availableNow=True)
    run(writer.option("checkpointLocation", work_dir(spark, "checkpoint")).start())
    back = []
    for name in ("purchases", "app.public.activity"):
        rows = record_key(read_routed(spark, root, routed.schema, name), USER_KEY).withColumnRenamed("user_id", "key_user")
        images = unwrap_cdc(rows, USER_ROW, keep=["offset", "key_user"])
        back.append(images.select(F.lit(name).alias("routed_to"), F.col("offset").alias("feed_offset"), F.col("key_user").alias("user_id"), "props"))
    return back[0].unionByName(back[1])
