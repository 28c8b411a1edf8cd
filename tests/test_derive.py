from __future__ import annotations

import hashlib
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidestar.functions import (
    component_total,
    datetime_hash,
    flag_when,
    pg_element,
    pg_int_cast,
    series,
    shift_time,
    total_mismatch,
    with_datetime_hash,
)


def test_hash_text_with_and_without_fraction(spark):
    pair = (datetime(2025, 1, 2, 3, 4, 5), datetime(2025, 1, 2, 3, 4, 5, 60000))
    df = spark.createDataFrame([pair], "a timestamp_ntz, b timestamp_ntz")
    text = "2025-01-02 03:04:05||2025-01-02 03:04:05.06"
    assert rows(df.select(datetime_hash("a", "b"))) == [(hashlib.sha256(text.encode()).hexdigest(),)]


def test_hash_of_a_null_side_collides_so_nulls_go_first(spark):
    t = datetime(2025, 1, 2)
    df = spark.createDataFrame([(None, t), (t, None)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(datetime_hash("a", "b")).distinct().count() == 1


def test_hash_refuses_zoned_times_outside_utc(spark):
    df = spark.sql("SELECT timestamp'2025-01-01 00:00:00' AS a, timestamp'2025-01-01 00:00:00' AS b")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            with_datetime_hash(df, ["a", "b"])
        ntz = df.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in df.columns])
        assert with_datetime_hash(ntz, ["a", "b"]).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_component_total_is_exact_and_null_aware(spark):
    df = spark.createDataFrame([(0.1, 0.2, None), (1.005, None, 2.0)], "a double, b double, c double")
    got = df.select(component_total(["a", "b", "c"]).alias("t"), component_total(["a", "b", "c"], False).alias("n"))
    assert rows(got) == [(Decimal("0.30"), None), (Decimal("3.01"), None)]


def test_total_mismatch_reports_the_difference(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, 2.0, 4.5)], "a double, b double, total_amount double")
    assert rows(total_mismatch(df, ["a", "b"]).select("difference")) == [(Decimal("1.50"),)]


def test_shift_time_in_both_directions(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1), 3)], "t timestamp_ntz, n int")
    step = timedelta(minutes=10)
    got = df.select(shift_time(F.col("t"), -F.col("n"), step), shift_time(F.col("t"), F.col("n"), step))
    assert rows(got) == [(datetime(2024, 12, 31, 23, 30), datetime(2025, 1, 1, 0, 30))]


def test_flag_of_an_unknown_condition_is_no(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "a int")
    assert [r[0] for r in df.select(flag_when(F.col("a") < 5)).collect()] == ["Y", "N", "N"]


def test_subscripts_outside_the_array_are_null(spark):
    df = spark.createDataFrame([(i,) for i in (-1, 0, 1, 4, 5)], "i int")
    assert [r[0] for r in df.select(pg_element([1, 2, 6, 7], F.col("i"))).collect()] == [None, None, 1, 7, None]


def test_int_casts_round_by_type(spark):
    data = [(v, Decimal(str(v))) for v in (0.5, 1.5, 2.5, -0.5, -1.5)]
    got = pg_int_cast(spark.createDataFrame(data, "d double, m decimal(5,1)"), ["d", "m"])
    assert [tuple(r) for r in got.collect()] == [(0, 1), (2, 2), (2, 3), (0, -1), (-2, -2)]


def test_series_is_empty_below_its_start(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", None)], "k string, n int")
    assert rows(series(df, F.col("n")).select("k", "i")) == [("a", 1), ("a", 2), ("a", 3)]
