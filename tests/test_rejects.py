"""The side output of the loads: every record is loaded or rejected with a reason, once."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import SMALL, plan, rows
from pyspark.sql import functions as F
from test_streams import lay, one_by_one, undo_last_commit

from tidestar import schemas
from tidestar.functions import good_rows, parse_checked, rejects
from tidestar.plans import StarStore, clean_trips, replica_changes
from tidestar.registry.fixtures import messy_trip_feed
from tidestar.streaming import decode_captured_trips, decode_trips, read_rejects, read_replica, replica_sink, run, start_star, stream_rejects


def records(spark, values):  # noqa: ANN001, ANN201
    """Topic records of (key, value), offsets in order."""
    encoded = lambda x: None if x is None else x.encode()
    rows = [(encoded(k), encoded(v), "t", 0, i, None) for i, (k, v) in enumerate(values)]
    return spark.createDataFrame(rows, schemas.TOPIC)


def test_flat_json(spark):
    feed = records(spark, [(None, v) for v in ('{"k": 1}', '{"k": "x"}', "oops", None, "", "{}", '{"k": 1', "null")])
    checked = parse_checked(feed, schemas.struct((schemas.INT, "k")))
    assert rows(good_rows(checked)) == [(1,), (None,), (None,)]  # an empty object, and JSON's null, have no field
    told = {r.offset: (r.reason, r.value) for r in rejects(checked).collect()}
    assert told[1] == ("does not parse", '{"k": "x"}') and told[2][0] == "does not parse" and told[3] == ("no value", None)
    assert {1, 2, 3, 6} <= set(told) and good_rows(checked).count() + len(told) == 8
    assert plan(checked).count("from_json") == 1


def test_a_load_splits_its_feed_and_replays(spark, folder):
    lay(messy_trip_feed(spark, SMALL), f"{folder}/topic", 3)
    store, bad = StarStore(f"{folder}/star"), f"{folder}/bad"
    feed = spark.read.parquet(f"{folder}/topic")

    def load():  # noqa: ANN202
        run(start_star(decode_trips(one_by_one(spark, f"{folder}/topic"), checked=True), store, f"{folder}/c", rejected=bad))

    def check():  # noqa: ANN202
        got = read_rejects(spark, bad)
        whole = decode_trips(feed, checked=True)
        assert Counter(r.reason for r in got.collect()) == Counter(r.reason for r in rejects(whole).collect())
        assert got.count() + good_rows(whole).count() == feed.count()
        assert {r.batch_id for r in got.collect()} == {0, 1, 2}
        assert store.read(spark, "fact_trips").count() == clean_trips(good_rows(whole)).count()

    load()
    check()
    undo_last_commit(f"{folder}/c")
    load()
    check()


def test_a_batch_without_rejects_leaves_none(spark, folder):
    feed = messy_trip_feed(spark, SMALL).filter("value IS NOT NULL").limit(20)
    feed.filter(F.length("value") > 10).write.parquet(f"{folder}/topic")
    run(stream_rejects(decode_trips(one_by_one(spark, f"{folder}/topic"), checked=True).filter("fare_amount >= 0 AND passenger_count >= 0"), f"{folder}/bad", f"{folder}/c"))
    assert not list(__import__("pathlib").Path(folder, "bad").glob("run=*/batch_id=*"))


ROW = schemas.struct((schemas.LONG, "id n t"))
SMALL_ROW = schemas.struct((schemas.LONG, "id"), (schemas.INT, "n"), (schemas.TS, "t"))


def test_replica_rejects(spark, folder):
    image = '{"after": {"id": %d, "n": %d, "t": 5}, "op": "%s", "source": {"lsn": 1}}'
    feed = records(
        spark,
        [
            ('{"id": 1}', image % (1, 7, "c")),
            ('{"id": 2}', image % (2, 2**40, "c")),  # too large for the replica
            ('{"id": 3}', "{not json"),
            ('{"id": 4}', '{"after": {"id": 4}}'),
            ('{"id": 4}', image % (4, 1, "z")),
            (None, image % (5, 1, "c")),
            ('{"id": "x"}', image % (6, 1, "c")),
            ('{"id": 1}', None),  # a tombstone deletes
            ('{"id": 7}', '{"before": {"id": 7}, "op": "d"}'),
            ('{"id": 8}', '{"after": {"id": 8, "n": "many"}, "op": "u"}'),
        ],
    )
    feed.write.parquet(f"{folder}/topic")
    changes = replica_changes(one_by_one(spark, f"{folder}/topic"), ROW, SMALL_ROW, ["id"], ["t"], checked=True)
    sink = replica_sink(f"{folder}/replica", ["id"], ["__offset"], f"{folder}/bad")
    run(changes.writeStream.foreachBatch(sink).trigger(availableNow=True).option("checkpointLocation", f"{folder}/c").start())
    told = {r.offset: r.reason for r in read_rejects(spark, f"{folder}/bad").collect()}
    assert told == {1: "does not fit: n", 2: "does not parse", 3: "no operation", 4: "no operation", 5: "no key", 6: "no key", 9: "does not parse"}
    state = read_replica(spark, f"{folder}/replica", good_rows(changes).schema, ["id"], ["__offset"], deletes="keep")
    assert sorted(r.id for r in state.collect()) == [1, 7]


@pytest.mark.parametrize("wrapped", [False, True])
def test_captured_trips(spark, wrapped):
    wrap = (lambda v: v and '{"schema": {}, "payload": %s}' % v) if wrapped else lambda v: v
    good = '{"after": {"trip_id": 1, "VendorID": 2, "tpep_pickup_datetime": 1000000}, "op": "r"}'
    feed = records(spark, [(None, wrap(v)) for v in (good, '{"before": {"trip_id": 1}, "op": "d"}', good[:-3], good.replace("1000000", '"noon"'), '{"op": "c"}', None)])
    checked = decode_captured_trips(feed, wrapped=wrapped, checked=True)
    assert [r.vendor_id for r in good_rows(checked).collect()] == [2, None]
    assert {r.offset: r.reason for r in rejects(checked).collect()} == {2: "does not parse", 3: "does not parse"}
    assert checked.drop("__reject").schema == decode_captured_trips(feed, wrapped=wrapped).schema
    assert rows(good_rows(checked).limit(1)) == rows(decode_captured_trips(feed.limit(1), wrapped=wrapped))


def test_only_checked_trips_have_rejects(spark, folder):
    with pytest.raises(ValueError, match="checked"):
        start_star(decode_trips(one_by_one(spark, folder)), StarStore(f"{folder}/star"), f"{folder}/c", rejected=f"{folder}/bad")
