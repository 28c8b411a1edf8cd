"""Current state in buckets, snapshot handover and streamed state against plain batch computation."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F
from test_streams import one_by_one, undo_last_commit

from tidestar import schemas
from tidestar.functions import unwrap_cdc
from tidestar.operators import latest_per_key
from tidestar.operators.changes import apply_changes
from tidestar.plans import BucketedState, replica_changes
from tidestar.registry.fixtures import USER_ROW, user_feed
from tidestar.session import stored
from tidestar.streaming import latest_rows, read_handover, read_replica, run, start_handover, start_latest, state_rows, take_snapshot
from tidestar.streaming.handover import handover_mark

KEYS = ["user_id"]


@pytest.fixture(scope="module")
def changes(spark):
    feed = unwrap_cdc(user_feed(spark, SMALL), USER_ROW, keep=["offset"]).drop("source")
    return stored(feed.withColumnRenamed("offset", "__offset"), "changes")


def current(changes):
    return rows(apply_changes(None, changes, KEYS, ["__offset"]))


def files(root):
    return sorted(str(p) for p in Path(root).glob("v=*/bucket=*/*.parquet"))


def test_a_fold_rewrites_the_buckets_it_touches(spark, folder, changes):
    state = BucketedState(folder, USER_ROW, KEYS, ["__offset"], buckets=100)
    late = changes.filter("__offset % 3 = 0")
    state.fold(changes.filter("__offset % 3 > 0"))
    state.fold(late)
    assert rows(state.read(spark)) == current(changes)
    before = state.current(spark)
    one = changes.filter(state.bucket_of() == min(before))
    assert one.count() > 0 and state.fold(one) == [min(before)]
    after = state.current(spark)
    assert {b for b in after if after[b] != before.get(b)} == {min(before)}
    assert len(list(Path(folder, "v=3").glob("bucket=*"))) == 1  # of a hundred
    assert rows(state.read(spark)) == current(changes)
    state.fold(late)  # once more
    assert rows(state.read(spark)) == current(changes)
    held = len(files(folder))
    assert state.vacuum(spark) > 0 and len(files(folder)) < held
    assert rows(state.read(spark)) == current(changes) and state.vacuum(spark) == 0


def test_an_unfinished_fold_is_not_read(spark, folder, changes):
    state = BucketedState(folder, USER_ROW, KEYS, ["__offset"], buckets=4)
    first, second = changes.filter("__offset < 50"), changes.filter("__offset >= 50")
    state.fold(first)
    state.fold(second)
    Path(folder, "v=2", "_SUCCESS").unlink()
    assert rows(state.read(spark)) == current(first)
    state.fold(second)  # overwrites what is there
    assert rows(state.read(spark)) == current(changes)


def test_awkward_keys_in_buckets(spark, folder):
    row = schemas.struct((schemas.LONG, "a"), (schemas.TEXT, "b x"))
    frame = "a bigint, b string, x string, __deleted string, __offset bigint"
    data = [(None, None, "n", "false", 1), (None, "b", "m", "false", 1), (1, None, "o", "false", 1), (1, None, "p", "false", 2), (1, "b", "q", "true", 3)]
    state = BucketedState(folder, row, ["a", "b"], ["__offset"], buckets=3)
    assert rows(state.read(spark)) == []
    assert state.fold(spark.createDataFrame([], frame)) == []
    state.fold(spark.createDataFrame(data, frame))
    state.fold(spark.createDataFrame([(1, "b", "late", "false", 2), (None, None, "z", "false", 9)], frame))
    assert rows(state.read(spark)) == sorted([(None, None, "z"), (None, "b", "m"), (1, None, "p")], key=repr)
    assert len(state.fold(spark.createDataFrame([(7, "hot", str(i), "false", i) for i in range(5000)], frame))) == 1
    assert ("4999",) in rows(state.read(spark).filter("a = 7").select("x"))


def test_handover_between_snapshot_and_feed(spark, folder):
    feed = user_feed(spark, SMALL)
    last = feed.agg(F.max("offset")).first()[0]
    early, late = last // 3, last // 2
    feed.filter(F.col("offset") > last // 6).repartition(3).write.parquet(f"{folder}/topic")
    whole = unwrap_cdc(feed, USER_ROW, keep=["offset"]).withColumnRenamed("offset", "__offset").drop("source")
    at = F.when(F.col("user_id") % 2 == 0, early).otherwise(late)
    snapshot = apply_changes(None, whole.withColumn("at", at).filter("__offset <= at").drop("at"), KEYS, ["__offset"]).withColumn("__lsn", at)
    root = f"{folder}/replica"

    def changes():  # noqa: ANN202
        return replica_changes(one_by_one(spark, f"{folder}/topic"), USER_ROW, USER_ROW, KEYS)

    schema = changes().schema
    with pytest.raises(RuntimeError, match="snapshot"):
        start_handover(changes(), root, KEYS, f"{folder}/c")
    assert handover_mark(spark, root) is None
    assert take_snapshot(snapshot, early, root, schema) == early
    # A restart before the feed has started: the table has moved on, but its snapshot stays.
    assert take_snapshot(snapshot.limit(0), early + 5, root, schema) == early
    assert rows(read_handover(spark, root, schema, KEYS)) == rows(snapshot.drop("__lsn"))
    want = rows(apply_changes(None, whole, KEYS, ["__offset"]))
    for _ in range(2):
        run(start_handover(changes(), root, KEYS, f"{folder}/c"))
        assert rows(read_handover(spark, root, schema, KEYS)) == want
        undo_last_commit(f"{folder}/c")
    low = spark.read.parquet(*[str(p) for p in Path(root).glob("run=*/batch_id=*") if "snapshot" not in str(p)]).agg(F.min("__lsn"))
    assert low.first()[0] > early  # nothing at or below the mark is taken from the feed


def test_a_change_at_the_snapshots_position_is_in_it(spark, folder):
    image = '{"after": {"user_id": %d, "event_id": %d}, "op": "u", "source": {"lsn": %d}}'
    data = [(1, 10, 100), (1, 11, 101), (2, 20, 102), (3, 30, 99)]
    feed = [(b'{"user_id": %d}' % k, (image % (k, e, at)).encode(), "t", 0, i, None) for i, (k, e, at) in enumerate(data)]
    spark.createDataFrame(feed, schemas.TOPIC).write.parquet(f"{folder}/topic")
    changes = replica_changes(one_by_one(spark, f"{folder}/topic"), USER_ROW, USER_ROW, KEYS)
    snapshot = spark.createDataFrame([(1, 5, 101), (2, 6, None)], "user_id bigint, event_id bigint, __lsn bigint")
    take_snapshot(snapshot, 100, f"{folder}/r", changes.schema)
    run(start_handover(changes, f"{folder}/r", KEYS, f"{folder}/c"))
    got = read_handover(spark, f"{folder}/r", changes.schema, KEYS).select("user_id", "event_id")
    assert rows(got) == [(1, 5), (2, 20)]


def test_streamed_state_emits_the_keys_of_a_batch(spark, folder):
    fields = "k bigint, v string, at bigint"
    batches = [[(1, "a", 1), (2, "b", 1), (1, "c", 3), (None, "n", None)], [(2, "d", 2)], [(1, "late", 2), (3, "e", 1), (None, "m", 0)]]
    first = None

    def load():  # noqa: ANN202
        stream = spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        query = start_latest(stream, ["k"], ["at"], f"{folder}/out", f"{folder}/c")
        run(query)
        return query

    for batch in batches:  # each load restarts the query from its checkpoint
        spark.createDataFrame(batch, fields).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = load()
        first = first or query.lastProgress["stateOperators"][0]["customMetrics"]
    assert any("rocksdb" in name for name in first)
    assert state_rows(query) == 4
    emitted = [rows(spark.read.parquet(str(p)).select("k", "v")) for b in range(3) for p in Path(folder, "out").glob(f"run=*/batch_id={b}")]
    assert emitted == [sorted([(1, "c"), (2, "b"), (None, "n")], key=repr), [(2, "d")], sorted([(1, "c"), (3, "e"), (None, "m")], key=repr)]
    every = spark.createDataFrame([r for b in batches for r in b], fields)
    want = rows(latest_per_key(every, ["k"], ["at"]))
    schema = every.withColumns({"__op": F.lit("u"), "__deleted": F.lit("false")}).schema
    assert rows(latest_rows(every, ["k"], ["at"])) == want
    undo_last_commit(f"{folder}/c")
    load()
    assert rows(read_replica(spark, f"{folder}/out", schema, ["k"], ["at"])) == want
