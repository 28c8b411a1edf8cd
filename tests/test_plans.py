"""The physical plans: what reaches the scan, what is broadcast, what is shuffled, and what hot keys do."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import SMALL, final_plan, plan, rows
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.operators import (
    apply_changes,
    build_dim,
    build_dim_datetime,
    build_fact,
    check_rules,
    diff_changes,
    duplicate_keys,
    enrich,
    latest_per_key,
    orphans,
    rows_to_insert,
    star_join,
    update_where_in,
)
from tidestar.plans import BucketedStar, clean_trips, run_batch, star_tables
from tidestar.plans.batch import trips_of_day
from tidestar.operators.star import describe_times, distinct_times
from tidestar.plans.star import code_dimensions, packed_times
from tidestar.plans.store import _by_month
from tidestar.functions import unwrap_cdc
from tidestar.registry import QUERIES
from tidestar.registry.fixtures import USER_ROW, trips, user_feed
from tidestar.session import stored
from tidestar.sources import payment_types


@contextmanager
def settings(spark, **conf):
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def small_trips(spark):
    return trips(spark, SMALL)


def test_filters_and_columns_reach_the_scan(spark, small_trips):
    text = plan(clean_trips(small_trips).select("fare_amount"))
    assert "GreaterThanOrEqual(l_extendedprice,0.0)" in text
    read = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "l_returnflag" not in read and "l_orderkey" not in read


def test_day_range_reaches_the_scan(spark, folder):
    run_batch(spark, trips(spark, SMALL), f"{folder}/star")
    rows = spark.read.parquet(f"{SMALL}/events.parquet").withColumnRenamed("ts", "tpep_pickup_datetime")
    text = plan(trips_of_day(rows, date(2024, 1, 2)))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in text and "LessThan(ts,2024-01-03T00:00)" in text


def test_stored_days_prune_folders_and_row_groups(spark, folder):
    store = run_batch(spark, trips(spark, SMALL), f"{folder}/star")
    text = plan(store.stored(spark, "dim_datetime", date(1998, 3, 1), date(1998, 3, 5)))
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_year", text)
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text
    assert len(store.stored(spark, "fact_trips", date(1998, 3, 1), date(1998, 3, 5)).inputFiles()) >= 1


def test_code_lists_are_broadcast_from_their_known_size(spark, small_trips):
    text = plan(enrich(small_trips, payment_types(spark), "payment_type"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_sides_are_broadcast_by_their_bytes_only(spark, small_trips):
    tables = star_tables(clean_trips(small_trips))
    codes = stored(tables["dim_ratecode"], "codes")
    assert "BroadcastHashJoin" in plan(star_join(tables["fact_trips"], {"dim_ratecode": codes}))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(star_join(tables["fact_trips"], {"dim_ratecode": codes, "dim_datetime": tables["dim_datetime"]}))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_nothing_runs_while_a_join_is_built(spark, small_trips):
    tables = star_tables(clean_trips(small_trips))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job")
    try:
        star_join(tables["fact_trips"], {k: v for k, v in tables.items() if k != "fact_trips"})
        update_where_in(small_trips, small_trips.select("DOLocationID"), "DOLocationID", {"fare_amount": 0.0})
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_many_codes_or_keys_are_shuffled(spark, small_trips):
    codes = build_dim(small_trips, "payment_type", payment_types(spark))
    places = small_trips.select("DOLocationID")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert "BroadcastExchange" not in plan(star_join(small_trips, {"dim_payment_type": stored(codes, "codes")}))
        many = update_where_in(small_trips, places, "DOLocationID", {"fare_amount": 0.0})
        text = plan(many)
        assert "LeftSemi" in text and "LeftAnti" in text and "Broadcast" not in text
    assert many.count() == small_trips.count() == many.filter("fare_amount = 0").count()


def test_attributeless_dimensions_are_not_joined(spark, small_trips):
    dims = {name: build_dim(small_trips, name.removeprefix("dim_")) for name in ("dim_passenger_count", "dim_trip_distance")}
    assert "Join" not in plan(star_join(small_trips, dims))


def test_latest_keeps_one_row_per_key_and_task_before_the_shuffle(spark):
    items = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    text = plan(latest_per_key(items, ["l_orderkey"], ["l_shipdate"]))
    assert "WindowGroupLimit" in text.split("Exchange")[1]


def test_counts_are_combined_before_the_shuffle(spark, small_trips):
    items = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    for df in (
        duplicate_keys(items, ["l_orderkey"]),
        check_rules(small_trips, schemas.TRIP_RULES),
        orphans(small_trips, payment_types(spark), ["payment_type"]),
        build_dim_datetime(clean_trips(small_trips)),
    ):
        assert re.search(r"Exchange.*?(partial_count|HashAggregate)", plan(df), re.S)


def test_distinct_times_are_shuffled_unhashed(spark, small_trips):
    text = plan(build_dim_datetime(clean_trips(small_trips)))
    assert re.findall(r"hashpartitioning\((\w+)#\d+, (\w+)#", text) == [tuple(schemas.EVENT_TIMES)]


def test_merge_of_distinct_times_shuffles_them_once_more(spark, small_trips):
    dim = build_dim_datetime(clean_trips(small_trips))
    target = spark.createDataFrame([("x",)], "datetime_hash string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(rows_to_insert(target, dim, ["datetime_hash"], null_safe=False, unique=True))
    assert text.count("Exchange hashpartitioning(tpep") == 1
    assert text.count("Exchange hashpartitioning(datetime_hash") == 2  # source and target
    assert "NestedLoop" not in text


def test_an_odd_date_adds_one_month_to_a_merge(spark, folder):
    store = run_batch(spark, trips(spark, SMALL), f"{folder}/star")
    odd = [12 * 1998 + 3, 12 * 2150 + 1]
    files = store.of_months(spark, "dim_datetime", odd)
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_year", plan(files))
    assert [tuple(r) for r in files.select("pickup_year", "pickup_month").distinct().collect()] == [(1998, 3)]


def test_merge_on_times_leaves_the_distinct_rows_where_they_are(spark, small_trips):
    dim = build_dim_datetime(clean_trips(small_trips))
    target = spark.createDataFrame([], dim.schema)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(rows_to_insert(target.repartition(3), dim, list(schemas.EVENT_TIMES), null_safe=False, unique=True))
    assert text.count("Exchange hashpartitioning(tpep") == 2 and "hashpartitioning(datetime_hash" not in text


def test_an_envelope_is_parsed_only_as_far_as_wanted(spark):
    changes = unwrap_cdc(user_feed(spark, SMALL), USER_ROW, keep=["offset"], fields=["user_id"], before=[])
    text = plan(changes)
    parsed = text[text.index("from_json") :].split("\n")[0]
    assert "props" not in parsed and "before" not in parsed and "user_id" in parsed


def test_applying_few_changes_does_not_shuffle_the_table(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    one = orders.limit(1).withColumns({"__op": F.lit("u"), "__deleted": F.lit("false")})
    text = final_plan(apply_changes(orders, one, ["o_orderkey"]))
    assert "BroadcastHashJoin" in text


def test_no_join_becomes_a_nested_loop(spark, small_trips):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    for df in (
        rows_to_insert(orders, orders, ["o_orderkey"]),
        diff_changes(orders, orders, ["o_orderkey"]),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


SPLIT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
}
HOT_TIME = "2025-01-05 10:00:00"


def skewed_trips(spark, share):
    """Trips of which a share has one and the same pickup and drop-off."""
    rows = trips(spark, SMALL).repartition(8)
    hot = F.expr(f"pmod(xxhash64(DOLocationID, fare_amount), 100) < {int(share * 100)}")
    same = {c: F.when(hot, F.lit(HOT_TIME).cast("timestamp_ntz")).otherwise(F.col(c)) for c in schemas.EVENT_TIMES}
    return rows.withColumns(same)


def test_a_hot_time_of_a_star_join_is_split(spark):
    with settings(spark, **SPLIT):
        tables = star_tables(clean_trips(skewed_trips(spark, 0.4)))
        fact = tables["fact_trips"]
        joined = star_join(fact, {"dim_datetime": tables["dim_datetime"]})
        assert "skew=true" in final_plan(joined)
        assert joined.filter("pickup_hour IS NOT NULL").count() == fact.count()


def test_a_hot_time_of_a_stored_star_is_split(spark, folder):
    store = run_batch(spark, skewed_trips(spark, 0.4), f"{folder}/star")
    with settings(spark, **SPLIT):
        fact = store.read(spark, "fact_trips").repartition(8)
        joined = star_join(fact, {"dim_datetime": store.read(spark, "dim_datetime")})
        assert "skew=true" in final_plan(joined)
        assert joined.filter("pickup_hour IS NOT NULL").count() == fact.count()


def test_a_hot_month_of_facts_is_split_on_write(spark, folder):
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB"):
        store = run_batch(spark, skewed_trips(spark, 1.0), f"{folder}/star")
    assert len(store.stored(spark, "fact_trips").inputFiles()) > 1


def test_a_bucketed_star_is_joined_without_a_shuffle(spark, folder):
    clean = clean_trips(skewed_trips(spark, 0.4))
    star = BucketedStar("default", "hot_", buckets=8)
    star.write(clean, folder)
    with settings(spark, **SPLIT):
        joined = star.joined(spark)
        assert "Exchange" not in final_plan(joined) and "SortMergeJoin" in plan(joined)
    want = star_tables(clean)
    assert rows(joined) == rows(star_join(want["fact_trips"], {"dim_datetime": want["dim_datetime"]}))
    assert rows(star.fact(spark)) == rows(want["fact_trips"])
    assert rows(star.dim_datetime(spark)) == rows(want["dim_datetime"])
    sizes = [r["n"] for r in spark.table("default.hot_fact_trips").groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 0.3 * sum(sizes)  # the hot time, 40 % of the trips, lies in several buckets
    assert rows(star.hot_times(clean).select("parts")) == [(4,)]
    star.write(clean.limit(0), f"{folder}/none")
    assert star.joined(spark).isEmpty()


def test_described_codes_are_broadcast_however_many_tasks_find_them(spark):
    many = clean_trips(trips(spark, SMALL)).repartition(64)
    codes = code_dimensions(many)
    dims = {name: codes[name] for name in ("dim_payment_type", "dim_ratecode")}
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="4KB"):
        text = final_plan(star_join(build_fact(many), dims)).split("Initial Plan")[0]
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_a_larger_star_gets_more_buckets(spark, folder):
    clean = clean_trips(trips(spark, SMALL))
    n = clean.count()
    star = BucketedStar("default", "more_", buckets=2, bucket_rows=n // 6)
    star.write(clean, folder)
    assert star.buckets_for(n) == len(spark.table("default.more_fact_trips").inputFiles()) >= 6
    joined = star.joined(spark)
    assert "Exchange" not in plan(joined) and joined.count() == n
    assert [BucketedStar("default").buckets_for(k) for k in (0, 10**6, 10**8)] == [64, 64, 200]


def test_a_bucketed_star_shuffles_times_and_stores_small(spark, folder):
    clean = clean_trips(skewed_trips(spark, 0.4))
    star = BucketedStar("default", "small_", buckets=8)
    for rows_of in star.laid(clean)[1].values():
        text = plan(rows_of)
        assert text.count("sha2(") == 1 and text.index("sha2(") < text.index("REPARTITION_BY_NUM")  # the plan's last step stands first
    star.write(clean, folder)
    for name in ("fact_trips", "dim_datetime"):
        for file in Path(folder, name).glob("*.parquet"):
            assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_a_bucketed_star_is_joined_to_its_codes_without_a_shuffle(spark):
    text = final_plan(QUERIES["star_join_bucketed"](spark, SMALL))
    assert "hashpartitioning" not in text and text.split("Initial Plan")[0].count("BroadcastHashJoin") == 2


def test_a_load_shuffles_times_and_hashes_afterwards(spark, folder):
    clean = clean_trips(trips(spark, SMALL))
    text = plan(describe_times(_by_month(distinct_times(clean))))
    assert text.index("sha2(") < text.index("REBALANCE") and text.count("sha2(") == 1
    store = run_batch(spark, trips(spark, SMALL), f"{folder}/star")
    for name in ("fact_trips", "dim_datetime"):
        files = store.stored(spark, name).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert rows(store.read(spark, "fact_trips").select("datetime_hash")) == rows(build_fact(clean).select("datetime_hash"))


def test_packed_digests_are_equal_only_for_equal_text(spark):
    digest = "0123456789abcdef" * 4
    texts = [digest, digest.upper(), f"{digest}\n", digest[:62], "", "a" * 32, bytes.fromhex(digest).decode("latin1"), None]
    df = spark.createDataFrame([(t,) for t in texts], "datetime_hash string")
    packed = packed_times(df)
    assert packed.distinct().count() == len(texts) and packed.filter("datetime_hash IS NULL").count() == 1
    assert packed.agg(F.min(F.length("datetime_hash"))).first()[0] == 32
