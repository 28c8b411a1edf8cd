"""Row types that come from the feed."""

from __future__ import annotations

import json

import pytest
from conftest import SMALL, rows
from pyspark.sql import types as T
from test_streams import undo_last_commit

from tidestar.functions.feed_schema import row_type, row_types, type_of, wider_type
from tidestar.plans import FeedTable
from tidestar.registry.fixtures import order_feed
from tidestar.streaming import run

BYTE, SHORT, INT, LONG, FLOAT, DOUBLE, TEXT = (
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType()
)


def block(**fields):
    image = [{"type": kind, "optional": True, "field": name} for name, kind in fields.items()]
    return {"type": "struct", "fields": [{"type": "struct", "fields": image, "field": "after"}]}


def records(spark, *changes):
    """Topic records from (offset, schema block, after, op)."""
    data = []
    for offset, schema, after, op in changes:
        payload = {"after": after if op != "d" else None, "before": after if op == "d" else None, "op": op}
        data.append((bytearray(json.dumps({"schema": schema, "payload": payload}).encode()), offset))
    return spark.createDataFrame(data, "value binary, offset bigint")


@pytest.mark.parametrize(
    "a, b, want",
    [(BYTE, SHORT, SHORT), (LONG, INT, LONG), (INT, DOUBLE, DOUBLE), (SHORT, FLOAT, DOUBLE), (FLOAT, DOUBLE, DOUBLE), (TEXT, TEXT, TEXT)],
)
def test_types_widen(a, b, want):
    assert wider_type(a, b) == wider_type(b, a) == want
    assert wider_type(T.ArrayType(a), T.ArrayType(b)) == T.ArrayType(want)


@pytest.mark.parametrize("a, b", [(INT, TEXT), (LONG, DOUBLE), (LONG, FLOAT), (T.BooleanType(), INT), (T.ArrayType(INT), INT)])
def test_types_that_do_not_hold_the_values_are_refused(a, b):
    for one, two in ((a, b), (b, a)):
        with pytest.raises(ValueError, match="changes from"):
            wider_type(one, two)


def test_structs_take_the_fields_of_both(spark):
    a, b = (T.StructType.fromDDL(t) for t in ("x int, y string, s struct<p: smallint>", "z double, x bigint, s struct<q: int, p: int>"))
    assert wider_type(a, b) == T.StructType.fromDDL("x bigint, y string, s struct<p: int, q: int>, z double")


def test_blocks_become_types(spark):
    nested = {"type": "struct", "fields": [{"type": "array", "items": {"type": "int16"}, "field": "a"}]}
    assert type_of(nested) == T.StructType([T.StructField("a", T.ArrayType(SHORT))])
    assert type_of({"type": "map", "keys": {"type": "string"}, "values": {"type": "float"}}) == T.MapType(TEXT, FLOAT)
    assert type_of({"type": "int64", "name": "io.debezium.time.MicroTimestamp"}) == LONG
    assert row_type(json.dumps(block(k="int64", v="bytes"))) == T.StructType.fromDDL("k bigint, v binary")
    for odd in ({"type": "int128"}, {"type": "bytes", "name": "org.apache.kafka.connect.data.Decimal"}, {}):
        with pytest.raises(ValueError):
            type_of(odd)
    with pytest.raises(ValueError, match="no row image"):
        row_type('{"type": "struct", "fields": []}')


def test_one_batch_may_hold_several_schemas(spark, folder):
    old, new = block(k="int32", v="int16"), block(k="int32", v="double", w="string")
    feed = records(spark, (1, old, {"k": 1, "v": 7}, "c"), (2, new, {"k": 2, "v": 0.5, "w": "x"}, "c"), (3, old, {"k": 3, "v": -1}, "c"))
    assert len(row_types(feed)) == 2
    table = FeedTable(folder, ["k"])
    assert table.load(feed, "r", 0) == T.StructType.fromDDL("k int, v double, w string")
    assert rows(table.read(spark)) == [(1, 7.0, None), (2, 0.5, "x"), (3, -1.0, None)]


def test_files_written_before_are_read_wider(spark, folder):
    table = FeedTable(folder, ["k"])
    table.load(records(spark, (1, block(k="int16", v="int32", f="float"), {"k": 1, "v": 2**31 - 1, "f": 0.5}, "c")), "r", 0)
    table.load(records(spark, (2, block(k="int64", v="double", f="double"), {"k": 2**40, "v": 0.25, "f": 1e300}, "c")), "r", 1)
    table.load(records(spark, (3, block(k="int32", v="int8"), {"k": 1, "v": 5}, "u")), "r", 2)  # narrower again, and a column less
    assert table.row(spark) == T.StructType.fromDDL("k bigint, v double, f double")
    assert rows(table.read(spark)) == [(1, 5.0, None), (2**40, 0.25, 1e300)]


def test_a_change_that_loses_values_is_refused_before_it_writes(spark, folder):
    table = FeedTable(folder, ["k"])
    table.load(records(spark, (1, block(k="int32", v="int32"), {"k": 1, "v": 2}, "c")), "r", 0)
    before = rows(table.read(spark))
    with pytest.raises(ValueError, match="v changes from int to string"):
        table.load(records(spark, (2, block(k="int32", v="string"), {"k": 2, "v": "two"}, "c")), "r", 1)
    with pytest.raises(ValueError, match="have no"):
        FeedTable(f"{folder}/other", ["id"]).load(records(spark, (1, block(k="int32"), {"k": 1}, "c")), "r", 0)
    assert rows(table.read(spark)) == before and table.row(spark) == T.StructType.fromDDL("k int, v int")


def test_records_without_a_change(spark, folder):
    table = FeedTable(folder, ["k"])
    nothing = spark.createDataFrame([(None, 5), (bytearray(b"oops"), 6), (bytearray(b""), 7)], "value binary, offset bigint")
    assert table.load(nothing, "r", 0) is None and table.load(nothing.limit(0), "r", 1) is None
    with pytest.raises(ValueError, match="no feed"):
        table.read(spark)
    table.load(records(spark, (1, block(k="int32"), {"k": None}, "c"), (2, block(k="int32"), {"k": 4}, "c")).unionByName(nothing), "r", 2)
    assert rows(table.read(spark)) == [(4,), (None,)]
    table.load(records(spark, (9, block(k="int32"), {"k": 4}, "d")), "r", 3)
    table.load(nothing, "r", 4)
    assert rows(table.read(spark)) == [(None,)]


def test_a_stream_lands_in_full_after_a_replay(spark, folder):
    for later in (False, True):
        order_feed(spark, SMALL, later).coalesce(1).write.mode("append").parquet(f"{folder}/topic")
    table = FeedTable(f"{folder}/t", ["o_orderkey"])
    feed = order_feed(spark, SMALL, False).unionByName(order_feed(spark, SMALL, True))
    FeedTable(f"{folder}/want", ["o_orderkey"]).load(feed, "r", 0)

    def go():
        topic = spark.readStream.schema("value binary, offset bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/topic")
        run(topic.writeStream.foreachBatch(table.sink()).option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start())

    go()
    want = FeedTable(f"{folder}/want", ["o_orderkey"]).read(spark)
    assert rows(table.read(spark).select(want.columns)) == rows(want)
    undo_last_commit(f"{folder}/c")
    go()
    assert rows(table.read(spark).select(want.columns)) == rows(want)
