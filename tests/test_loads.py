"""Digests of versions, loads that can be repeated, and gates that stop a load."""

from __future__ import annotations

import os
import re
import uuid
from pathlib import Path

import pytest
from conftest import SMALL, plan, rows
from pyspark.sql import functions as F
from test_streams import one_by_one

from tidestar import schemas
from tidestar.operators import Gate, RulesViolated, bucket_digests, check_rules, diff_by_digest, diff_changes, differing_buckets
from tidestar.plans import DigestedVersions, StarStore, clean_trips, run_batch
from tidestar.registry.base import table
from tidestar.registry.fixtures import messy_trip_feed, orders_after, trips
from tidestar.sources import LedgerTable
from tidestar.streaming import decode_trips, read_rejects, run, start_star

ROW = "k bigint, a string, b string, c double"


def frame(spark, data, schema=ROW):
    return spark.createDataFrame(data, schema)


# --- Digests ---


def test_diff_by_digest_is_the_diff(spark):
    before, after = table(spark, SMALL, "orders"), orders_after(spark, SMALL)
    want = rows(diff_changes(before, after, ["o_orderkey"]))
    for buckets in (1, 7, 5000):
        assert rows(diff_by_digest(before, after, ["o_orderkey"], buckets)) == want
    assert rows(diff_by_digest(before, before, ["o_orderkey"])) == []
    assert len(rows(diff_by_digest(before.limit(0), before, ["o_orderkey"]))) == before.count()
    assert rows(diff_by_digest(before.limit(0), before.limit(0), ["o_orderkey"])) == []


@pytest.mark.parametrize(
    "one, other",
    [
        ((1, None, "x", 1.0), (1, "x", None, 1.0)),  # a null changes place
        ((1, "ab", "c", 1.0), (1, "a", "bc", 1.0)),  # a letter changes column
        ((1, "", None, 1.0), (1, None, "", 1.0)),
        ((1, "a", "b", None), (1, "a", "b", 0.0)),
        ((1, None, None, None), (2, None, None, None)),
    ],
)
def test_a_digest_tells_small_changes(spark, one, other):
    digests = [bucket_digests(frame(spark, [row]), ["k"], 1) for row in (one, other)]
    assert differing_buckets(*digests) == [0]
    assert differing_buckets(digests[0], digests[0]) == []


def test_digests_do_not_depend_on_order(spark):
    data = [(i, str(i), None, float(i)) for i in range(500)]
    one, other = [frame(spark, d).repartition(n) for d, n in ((data, 3), (data[::-1], 8))]
    assert rows(bucket_digests(one, ["k"], 16)) == rows(bucket_digests(other.select("c", "b", "a", "k"), ["k"], 16))


def test_pairs_of_equal_rows_do_not_cancel_out(spark):
    one, other = frame(spark, [(1, "a", None, None)] * 2), frame(spark, [(1, "b", None, None)] * 2)
    assert differing_buckets(bucket_digests(one, ["k"], 1), bucket_digests(other, ["k"], 1)) == [0]


def test_a_stored_diff_reads_only_buckets_that_differ(spark, folder):
    before = table(spark, SMALL, "orders")
    store = DigestedVersions(folder, before.schema, ["o_orderkey"], buckets=32)
    key = before.first()["o_orderkey"]
    after = before.withColumn("o_totalprice", F.col("o_totalprice") + (F.col("o_orderkey") == key).cast("int"))
    one, two, same = store.write(before), store.write(after), store.write(before.repartition(5))
    assert store.versions(spark) == [1, 2, 3]
    changes = store.diff(spark, one, two)
    assert rows(changes) == rows(diff_changes(before, after, ["o_orderkey"])) and changes.count() == 1
    [bucket] = differing_buckets(store.digests(spark, one), store.digests(spark, two))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(changes))
    assert len(scans) >= 2 and all(f"= {bucket})" in s for s in scans)
    assert differing_buckets(store.digests(spark, one), store.digests(spark, same)) == []
    assert rows(store.diff(spark, one, same)) == []
    assert rows(store.read(spark, two)) == rows(after)


def test_an_unfinished_version_is_not_read(spark, folder):
    orders = table(spark, SMALL, "orders")
    store = DigestedVersions(folder, orders.schema, ["o_orderkey"], buckets=4)
    assert store.write(orders) == 1
    orders.limit(3).withColumn("__bucket", F.lit(0)).write.partitionBy("__bucket").parquet(f"{folder}/rows/v=2")  # no digests
    assert store.versions(spark) == [1]
    with pytest.raises(ValueError, match="versions"):
        store.diff(spark, 1, 2)
    assert store.write(orders_after(spark, SMALL)) == 2
    assert rows(store.read(spark, 2)) == rows(orders_after(spark, SMALL))


def test_versions_of_no_rows(spark, folder):
    orders = table(spark, SMALL, "orders")
    store = DigestedVersions(folder, orders.schema, ["o_orderkey"], buckets=4)
    empty, full = store.write(orders.limit(0)), store.write(orders)
    assert {r["__op"] for r in store.diff(spark, empty, full).collect()} == {"c"}
    assert {r["__op"] for r in store.diff(spark, full, empty).collect()} == {"d"}
    assert rows(store.diff(spark, empty, empty)) == []


# --- The ledger ---


def test_each_file_is_loaded_once(spark, folder):
    orders = table(spark, SMALL, "orders")
    source, target = f"{folder}/in with space", LedgerTable(f"{folder}/out", orders.schema)
    orders.filter("o_orderkey % 3 = 0").repartition(2).write.parquet(source)
    assert rows(target.read(spark)) == [] and rows(target.ledger(spark)) == []
    assert (target.load(spark, source), target.load(spark, source)) == (2, 0)
    orders.filter("o_orderkey % 3 > 0").repartition(3).write.mode("append").parquet(source)
    assert (target.load(spark, source), target.load(spark, source)) == (3, 0)
    assert rows(target.read(spark)) == rows(orders)
    assert target.ledger(spark).count() == 5 and target.loads(spark) == [1, 2]


def test_known_files_are_not_opened(spark, folder):
    orders = table(spark, SMALL, "orders")
    target = LedgerTable(f"{folder}/out", orders.schema)
    orders.filter("o_orderkey % 2 = 0").coalesce(1).write.parquet(f"{folder}/in")
    target.load(spark, f"{folder}/in")
    [file] = Path(folder, "in").glob("*.parquet")
    told = file.stat()
    file.write_bytes(bytes(told.st_size))  # reading it would fail
    os.utime(file, ns=(told.st_atime_ns, told.st_mtime_ns))
    Path(folder, "in", f".{file.name}.crc").unlink(missing_ok=True)
    orders.filter("o_orderkey % 2 <> 0").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    assert target.load(spark, f"{folder}/in") == 1
    assert rows(target.read(spark)) == rows(orders)


def test_equal_files_are_two_files(spark, folder):
    orders = table(spark, SMALL, "orders").coalesce(1)
    target = LedgerTable(f"{folder}/out", orders.schema)
    for _ in range(2):
        orders.write.mode("append").parquet(f"{folder}/in")
    assert target.load(spark, f"{folder}/in") == 2
    assert target.read(spark).count() == 2 * orders.count()


def test_a_changed_file_is_refused(spark, folder):
    orders = table(spark, SMALL, "orders").coalesce(1)
    target = LedgerTable(f"{folder}/out", orders.schema)
    orders.write.parquet(f"{folder}/in")
    target.load(spark, f"{folder}/in")
    [file] = Path(folder, "in").glob("*.parquet")
    orders.limit(5).coalesce(1).write.parquet(f"{folder}/other")
    [other] = Path(folder, "other").glob("*.parquet")
    file.write_bytes(other.read_bytes())
    Path(folder, "in", f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="changed since"):
        target.load(spark, f"{folder}/in")
    assert rows(target.read(spark)) == rows(orders)


def test_a_load_that_failed_before_its_ledger_is_not_read(spark, folder):
    orders = table(spark, SMALL, "orders")
    target = LedgerTable(f"{folder}/out", orders.schema)
    orders.write.parquet(f"{folder}/in")
    orders.limit(7).write.parquet(f"{folder}/out/rows/load=1")
    assert rows(target.read(spark)) == []
    target.load(spark, f"{folder}/in")
    assert rows(target.read(spark)) == rows(orders)


def test_columns_are_matched_by_name(spark, folder):
    frame(spark, [(1, "a", None, 2.0)]).select("c", "a", "k").write.parquet(f"{folder}/in")
    target = LedgerTable(f"{folder}/out", frame(spark, []).schema)
    target.load(spark, f"{folder}/in")
    assert rows(target.read(spark)) == [(1, "a", None, 2.0)]


# --- Gates ---


def counted(df, rules):
    return {r["rule"]: r["violations"] for r in check_rules(df, rules).collect()}


def jobs(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    action()
    spark.sparkContext.setJobGroup("none", "none")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_come_with_the_load_and_cost_no_job(spark, folder):
    found = {}
    gated = jobs(spark, lambda: run_batch(spark, trips(spark, SMALL), f"{folder}/a", gate=Gate(schemas.TRIP_RULES), report=found.update))
    plain = jobs(spark, lambda: run_batch(spark, trips(spark, SMALL), f"{folder}/b"))
    assert gated == plain > 0
    assert found == counted(trips(spark, SMALL), schemas.TRIP_RULES) and any(found.values())
    one, two = [StarStore(f"{folder}/{name}").tables(spark) for name in "ab"]
    assert all(rows(one[name]) == rows(two[name]) for name in one)


def test_a_violated_rule_stops_the_load_before_it_writes(spark, folder):
    bad = trips(spark, SMALL)
    n, wrong = bad.count(), counted(bad, schemas.TRIP_RULES)["pickup_not_null"]
    strict = Gate(schemas.TRIP_RULES, shares={"pickup_not_null": (wrong - 1) / n})
    with pytest.raises(RulesViolated, match="pickup_not_null") as stopped:
        run_batch(spark, bad, folder, gate=strict)
    assert stopped.value.counts == counted(bad, schemas.TRIP_RULES) and stopped.value.n_rows == n
    assert list(Path(folder).rglob("*.parquet")) == []
    run_batch(spark, bad, folder, gate=Gate(schemas.TRIP_RULES, shares={"pickup_not_null": wrong / n}))
    assert StarStore(folder).read(spark, "fact_trips").count() > 0


def test_a_gate_before_no_rows(spark, folder):
    found = {}
    run_batch(spark, trips(spark, SMALL).limit(0), folder, gate=Gate(schemas.TRIP_RULES, share=0.0), report=found.update)
    assert found == dict.fromkeys(schemas.TRIP_RULES, 0)


def test_counts_are_whole_where_no_trip_is_left(spark, folder):
    found, bad = {}, trips(spark, SMALL).withColumn("trip_distance", F.lit(-1.0))
    run_batch(spark, bad, folder, gate=Gate(schemas.TRIP_RULES), report=found.update)
    assert found == counted(bad, schemas.TRIP_RULES) and found["distance_not_negative"] == bad.count()
    with pytest.raises(RulesViolated, match="distance_not_negative"):
        run_batch(spark, bad, folder, gate=Gate(schemas.TRIP_RULES, share=0.5))


def test_an_unknown_condition_passes(spark):
    df, rules = frame(spark, [(1, "a", None, None), (2, None, None, -1.0)]), {"positive": "c >= 0", "told": "a IS NOT NULL"}
    watched, seen = Gate(rules).watch(df)
    watched.collect()
    assert Gate(rules, share=0.5).check(seen) == {"positive": 1, "told": 1}
    with pytest.raises(RulesViolated):
        Gate(rules, share=0.4).check(seen)
    with pytest.raises(ValueError, match="unknown rules"):
        Gate(rules, shares={"other": 1.0})


def test_a_gate_stops_a_stream(spark, folder):
    messy_trip_feed(spark, SMALL).repartition(2).write.parquet(f"{folder}/topic")

    def topic():
        return decode_trips(one_by_one(spark, f"{folder}/topic"), checked=True)

    gate = Gate(schemas.TRIP_RULES)
    run(start_star(topic(), StarStore(f"{folder}/a"), f"{folder}/ca", rejected=f"{folder}/ra", gate=gate))
    run(start_star(topic(), StarStore(f"{folder}/b"), f"{folder}/cb", rejected=f"{folder}/rb"))
    for name in ("fact_trips", "dim_datetime"):
        assert rows(StarStore(f"{folder}/a").read(spark, name)) == rows(StarStore(f"{folder}/b").read(spark, name))
    assert read_rejects(spark, f"{folder}/ra").count() == read_rejects(spark, f"{folder}/rb").count() > 0
    with pytest.raises(Exception, match="too many violate"):
        run(start_star(topic(), StarStore(f"{folder}/c"), f"{folder}/cc", gate=Gate(schemas.TRIP_RULES, share=0.0)))
    assert list(Path(folder, "c").rglob("*.parquet")) == []


def test_kept_codes_have_no_more_partitions_than_run_at_once(spark, folder):
    tracker, before = spark.sparkContext.statusTracker(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.sparkContext.setJobGroup("kept codes", "a load")
    try:
        store = StarStore(f"{folder}/star")
        store.create(spark)
        store.load(clean_trips(trips(spark, SMALL)), "r", 0)
    finally:
        spark.sparkContext.setJobGroup("none", "none")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("kept codes")]
    tasks = [tracker.getStageInfo(k) for j in jobs for k in j.stageIds]
    assert jobs and max(t.numTasks for t in tasks if t) < 97
    assert store.read(spark, "dim_payment_type").count() == clean_trips(trips(spark, SMALL)).select("payment_type").distinct().count()
