from __future__ import annotations

import math

import pytest
from conftest import rows

from tidestar import schemas
from tidestar.operators import (
    check_rules,
    dedup,
    duplicate_keys,
    enrich,
    fill,
    orphans,
    require_non_negative,
    require_not_null,
    star_join,
    unknown_codes,
)
from tidestar.sources import code_list, payment_types


def test_filter_then_fill_over_null_negative_and_nan(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (-0.0,), (math.nan,), (2.5,)], "v double")
    kept = require_non_negative(df, ["v"])
    assert len(rows(kept)) == 4
    assert sorted(v for (v,) in rows(fill(kept, {"v": 0}))) == [0.0, 0.0, 0.0, 2.5]
    assert fill(df, {"v": 0}).filter("v = 0").count() == 4


def test_all_columns_must_be_non_negative(spark):
    df = spark.createDataFrame([(1, 1), (1, -1), (-1, 1), (1, None)], "a int, b int")
    assert rows(require_non_negative(df, ["a", "b"])) == [(1, 1)]
    assert rows(require_not_null(df, ["b"])) == [(-1, 1), (1, -1), (1, 1)]


def test_dedup_by_row_and_by_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert rows(dedup(df)) == [(1, "a"), (1, "b"), (None, "c")]
    assert dedup(df, ["k"]).count() == 2


def test_stream_dedup_needs_a_bound(spark, folder):
    stream = spark.readStream.schema("k int, t timestamp").parquet(folder)
    with pytest.raises(ValueError, match="bound its state"):
        dedup(stream, ["k"])
    assert dedup(stream, ["k"], "t", "1 hour").isStreaming


def test_rules_count_false_but_not_unknown(spark):
    df = spark.createDataFrame([(1.0, "Y"), (-1.0, "X"), (None, None)], "d double, f string")
    got = check_rules(df, {"low": "d >= 0", "flag": "f IN ('Y','N')", "there": "d IS NOT NULL"})
    assert rows(got) == [("flag", 1), ("low", 1), ("there", 1)]


def test_duplicate_keys_counts_null_keys_too(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]


def test_code_list_keys_must_be_unique(spark):
    with pytest.raises(ValueError, match="unique"):
        code_list(spark, [(1, "a"), (1, "b")], schemas.DIM_PAYMENT_TYPE)


def test_enrich_keeps_unknown_and_null_codes(spark):
    df = spark.createDataFrame([(10, 1), (20, 0), (30, None)], "n int, payment_type int")
    got = enrich(df, payment_types(spark), "payment_type")
    assert got.columns == ["payment_type", "n", "payment_type_description"]
    assert rows(got) == [(0, 20, None), (1, 10, "Credit card"), (None, 30, None)]
    assert rows(unknown_codes(df, payment_types(spark), "payment_type")) == [(0, 1), (None, 1)]


def test_orphans_mark_null_keys_apart(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(orphans(fact, dim, ["k"])) == [(2, 2, False), (None, 1, True)]


def test_star_join_keeps_facts_without_a_dimension_row(spark):
    fact = spark.createDataFrame([(1, 5), (7, 6), (None, 7)], "payment_type int, n int")
    dims = {"dim_payment_type": payment_types(spark)}
    assert rows(star_join(fact, dims)) == [(1, 5, "Credit card"), (7, 6, None), (None, 7, None)]
