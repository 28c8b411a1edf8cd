from __future__ import annotations

import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidestar import schemas
from tidestar.functions import (
    conform,
    decimals_as_double,
    decode_value,
    micros_to_ts,
    parse_json,
    record_key,
    rename,
    split_bad,
    unwrap_cdc,
)
from tidestar.plans import replica_changes
from tidestar.sources import bootstrap, include_tables, route

ROW = schemas.struct((schemas.LONG, "id"), (schemas.TEXT, "name"))
KEY = schemas.struct((schemas.LONG, "id"))


def record(offset, key, value):
    text = None if value is None else (value if isinstance(value, str) else json.dumps(value))
    return (bytearray(json.dumps(key).encode()), None if text is None else bytearray(text.encode()), offset)


def env(op, before=None, after=None, table="people", lsn=1):
    return {"before": before, "after": after, "op": op, "ts_ms": 7, "source": {"schema": "public", "table": table, "lsn": lsn}}


@pytest.fixture
def feed(spark):
    data = [
        record(0, {"id": 1}, env("r", after={"id": 1, "name": "a"})),
        record(1, {"id": 2}, env("c", after={"id": 2, "name": "b"})),
        record(2, {"id": 2}, env("u", before={"id": 2, "name": "b"}, after={"id": 2, "name": "c"}, table="pets")),
        record(3, {"id": 1}, env("d", before={"id": 1})),
        record(4, {"id": 2}, None),
        record(5, {"id": 3}, "oops"),
    ]
    return spark.createDataFrame(data, "key binary, value binary, offset long")


def test_unwrap_gives_row_images_with_delete_marks(feed):
    got = unwrap_cdc(feed, ROW, keep=["offset"]).select("offset", "id", "name", "__op", "__deleted")
    assert rows(got) == [
        (0, 1, "a", "r", "false"),
        (1, 2, "b", "c", "false"),
        (2, 2, "c", "u", "false"),
        (3, 1, None, "d", "true"),
        (4, None, None, None, None),
        (5, None, None, None, None),
    ]
    assert unwrap_cdc(feed, ROW, keep_tombstones=False).count() == 5


def test_unwrap_reads_schema_bearing_values(spark):
    value = {"schema": {"type": "struct"}, "payload": env("c", after={"id": 9, "name": "z"})}
    key = {"schema": {}, "payload": {"id": 9}}
    wrapped = spark.createDataFrame([record(0, key, value)], "key binary, value binary, offset long")
    assert rows(unwrap_cdc(wrapped, ROW, wrapped=True).select("id", "name")) == [(9, "z")]
    assert rows(record_key(wrapped, KEY, wrapped=True).select("id", "offset")) == [(9, 0)]


def test_replica_changes_take_the_key_from_the_record(feed):
    got = replica_changes(feed, ROW, ROW, ["id"]).select("id", "name", "__deleted", "__offset")
    assert rows(got) == [
        (1, "a", "false", 0),
        (1, None, "true", 3),
        (2, "b", "false", 1),
        (2, "c", "false", 2),
        (2, None, "true", 4),
    ]


def test_include_tables_and_route(feed, spark):
    changes = unwrap_cdc(feed, ROW, keep=["offset"])
    assert rows(include_tables(changes, ["public.pets"]).select("offset")) == [(2,)]
    topics = spark.createDataFrame([("a.b.c",), ("x",), (None,)], "topic string")
    assert rows(route(topics, {"a.b.c": "c"})) == [("a.b.c", "c"), ("x", "x"), (None, None)]


def test_bootstrap_puts_the_snapshot_before_the_changes(spark):
    snapshot = spark.createDataFrame([(1, "a")], "id long, name string")
    marks = "__op string, __deleted string, __offset long"
    changes = spark.createDataFrame([(1, "b", "u", "false", 5)], f"id long, name string, {marks}")
    got = bootstrap(snapshot, changes).select("id", "name", "__op", "__deleted", "__offset")
    assert rows(got) == [(1, "a", "r", "false", None), (1, "b", "u", "false", 5)]


def test_parse_json_is_permissive_and_case_sensitive(spark):
    text = ['{"vendor_id": 1}', '{"VendorID": 1}', "oops", None]
    df = spark.createDataFrame([(bytearray(t.encode()) if t else None,) for t in text], "value binary")
    parsed = parse_json(decode_value(df), schemas.struct((schemas.INT, "vendor_id")))
    assert rows(parsed) == [(1,), (None,), (None,), (None,)]


def test_split_bad_keeps_every_row_on_one_side(spark):
    text = ['{"k": 1}', "oops", '{"k": "x"}', None, '{"k": 2', "{}"]
    df = spark.createDataFrame(list(enumerate(text)), "n int, value string")
    good, bad = split_bad(df, schemas.struct((schemas.INT, "k")), keep=["n"])
    assert rows(good) == [(0, 1), (5, None)]
    assert rows(bad) == [(1, "oops"), (2, '{"k": "x"}'), (3, None), (4, '{"k": 2')]


def test_split_bad_sees_faults_when_only_the_text_is_read(spark):
    df = spark.createDataFrame([('{"k": "x"}',), ("oops",)], "value string")
    _, bad = split_bad(df, schemas.struct((schemas.INT, "k")))
    assert bad.count() == 2


def test_micros_are_not_read_as_seconds(spark):
    df = spark.createDataFrame([(1735689600123456,), (None,)], "t long")
    got = micros_to_ts(df, ["t"]).select(F.col("t").cast("string"))
    assert rows(got) == [("2025-01-01 00:00:00.123456",), (None,)]


def test_conform_reorders_casts_and_fills_in(spark):
    df = spark.createDataFrame([("7", "x", 1), ("seven", "y", 2)], "VendorID string, extra string, n int")
    target = schemas.struct((schemas.INT, "n vendor_id"), (schemas.DOUBLE, "fee"))
    got = conform(rename(df, schemas.TRIP_NAMES), target)
    assert got.schema == target
    assert rows(got) == [(1, 7, None), (2, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(rename(df, schemas.TRIP_NAMES), target, strict=True).collect()


def test_decimals_become_doubles(spark):
    df = spark.createDataFrame([(Decimal("1.25"), 1)], "a decimal(9,3), b int")
    got = decimals_as_double(df)
    assert got.dtypes == [("a", "double"), ("b", "int")]
    assert rows(got) == [(1.25, 1)]
