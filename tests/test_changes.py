from __future__ import annotations

from itertools import permutations

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidestar.operators import (
    affected,
    apply_changes,
    delete_where_in,
    diff_changes,
    latest_per_key,
    live_rows,
    merge_insert,
    merge_into,
    pick_keys,
    rows_to_insert,
    sample_n,
    sampling,
    update_where_in,
    where_in,
)
from tidestar.plans import current_version, read_versioned, write_version
from tidestar.session import stored


def test_latest_needs_an_order_and_takes_nulls_first(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 0, "d"), (None, 5, "e")], "k int, o int, v string")
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, 2, "b"), (2, 0, "d"), (None, 5, "e")]
    with pytest.raises(ValueError, match="order"):
        latest_per_key(df, ["k"], [])


def test_merging_twice_adds_nothing(spark):
    target = spark.createDataFrame([(1, "one")], "k int, d string")
    source = spark.createDataFrame([(1, "uno"), (2, "two"), (2, "dos"), (None, None)], "k int, d string")
    once = merge_insert(target, source, ["k"])
    assert rows(once) == [(1, "one"), (2, "dos"), (None, None)]
    assert rows(merge_insert(once, source, ["k"])) == rows(once)


def test_null_key_is_inserted_again_without_null_safety(spark):
    keys = spark.createDataFrame([(None,), (1,)], "k int")
    assert rows(rows_to_insert(keys, keys, ["k"])) == []
    assert rows(rows_to_insert(keys, keys, ["k"], null_safe=False)) == [(None,)]
    twice = merge_insert(merge_insert(keys, keys, ["k"], False), keys, ["k"], False)
    assert twice.filter("k IS NULL").count() == 3


def test_float_keys_merge_across_zero_signs_and_nan(spark):
    target = spark.createDataFrame([(0.0,), (float("nan"),)], "k double")
    source = spark.createDataFrame([(-0.0,), (float("nan"),), (1.5,)], "k double")
    assert rows(rows_to_insert(target, source, ["k"])) == [(1.5,)]


def test_merge_statement_needs_a_row_level_catalog(spark):
    spark.sql("CREATE TABLE merge_probe (k int) USING parquet")
    with pytest.raises(Exception, match="(?i)merge"):
        merge_into(spark.createDataFrame([(1,)], "k int"), "merge_probe", ["k"])
    spark.sql("DROP TABLE merge_probe")


CHANGES = "k int, v string, __op string, __deleted string, __o int"


@pytest.fixture
def changes(spark):
    data = [
        (1, "a2", "u", "false", 11),
        (2, None, "d", "true", 12),
        (3, "c", "c", "false", 10),
        (3, "c2", "u", "false", 13),
        (4, "d", "c", "false", 14),
        (4, None, "d", "true", 15),
    ]
    return spark.createDataFrame(data, CHANGES)


def test_changes_applied_with_and_without_deletes(spark, changes):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "k int, v string")
    got = apply_changes(target, changes, ["k"], ["__o"])
    assert rows(got) == [(1, "a2"), (3, "c2"), (9, "z")]
    kept = apply_changes(target, changes, ["k"], ["__o"], deletes="keep")
    assert rows(kept) == [(1, "a2"), (2, None), (3, "c2"), (4, None), (9, "z")]
    assert rows(apply_changes(None, changes, ["k"], ["__o"])) == [(1, "a2"), (3, "c2")]
    with pytest.raises(ValueError, match="deletes"):
        apply_changes(target, changes, ["k"], ["__o"], deletes="maybe")


def test_a_late_change_does_not_beat_a_newer_row(spark, changes):
    target = spark.createDataFrame([(1, "a", 99), (2, "b", 1), (9, "z", 5)], "k int, v string, __o int")
    got = apply_changes(target, changes, ["k"], ["__o"])
    assert rows(got) == [(1, "a", 99), (3, "c2", 13), (9, "z", 5)]
    assert rows(apply_changes(got, changes, ["k"], ["__o"])) == rows(got)


def test_diff_then_apply_restores_the_second_version(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 2), (3, None, 3)], "k int, v string, n int")
    after = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 4)], "k int, v string, n int")
    diff = diff_changes(before, after, ["k"])
    assert rows(diff.select("k", "v", "n", "__op")) == [(2, "b", None, "u"), (3, None, 3, "d"), (4, "d", 4, "c")]
    assert rows(apply_changes(before, diff, ["k"])) == rows(after)
    assert diff_changes(after, after, ["k"]).isEmpty()


def test_row_set_dml(spark):
    df = spark.createDataFrame([(1, "Y"), (2, "Y"), (None, "Y")], "k int, f string")
    keys = spark.createDataFrame([(1,), (1,), (7,), (None,)], "k int")
    assert rows(where_in(df, keys, "k")) == [(1, "Y")]
    assert rows(update_where_in(df, keys, "k", {"f": "N"})) == [(1, "N"), (2, "Y"), (None, "Y")]
    assert rows(update_where_in(df, keys, "k", {"f": F.lower("f")})) == [(1, "y"), (2, "Y"), (None, "Y")]
    assert rows(delete_where_in(df, keys, "k")) == [(2, "Y"), (None, "Y")]
    assert rows(affected(df, keys, "k")) == [(1,)]


def test_versions_are_written_beside_the_one_being_read(spark, folder):
    schema = spark.createDataFrame([(1, "a")], "k int, v string").schema
    assert current_version(spark, folder) is None
    assert read_versioned(spark, folder, schema).isEmpty()
    write_version(spark.createDataFrame([(1, "a")], schema), folder)
    first = read_versioned(spark, folder, schema)
    changes = spark.createDataFrame([(1, "b", "u", "false")], "k int, v string, __op string, __deleted string")
    assert write_version(apply_changes(first, changes, ["k"]), folder) == 2
    assert rows(first) == [(1, "a")]
    assert rows(read_versioned(spark, folder, schema)) == [(1, "b")]


def test_an_unfinished_version_is_not_read(spark, folder):
    df = spark.createDataFrame([(1,)], "k int")
    write_version(df, folder)
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/v=2")
    assert current_version(spark, folder) == 1
    assert write_version(df, folder) == 2


def test_picks_are_exact_and_repeatable(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    picked = rows(pick_keys(orders, "o_orderkey", 100, seed=1))
    assert len(set(picked)) == 100
    assert picked == rows(pick_keys(orders.repartition(5), "o_orderkey", 100, seed=1))
    assert picked != rows(pick_keys(orders, "o_orderkey", 100, seed=2))
    assert sample_n(orders, 37, seed=3).count() == 37
    assert sample_n(orders, 10**6, seed=3).count() == orders.count()


def test_picks_of_any_size_are_the_first_by_digest(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    digest = F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.lit("1")), 256)
    want = [r.o_orderkey for r in orders.select("o_orderkey", digest.alias("d")).orderBy("d").collect()]
    for n in (0, 1, 5, 400, 1499, 1500, 5000):
        assert [r.o_orderkey for r in pick_keys(orders, "o_orderkey", n, seed=1).collect()] == want[:n]
        assert sample_n(orders, n, seed=1).distinct().count() == min(n, 1500)


def test_picks_with_equal_order_values_stay_exact(spark):
    twins = spark.range(3000).select((F.col("id") % 30).alias("k"))
    for n in (1, 99, 250, 2999):
        picked = pick_keys(twins, "k", n, seed=1)
        assert picked.count() == n and picked.distinct().count() == -(-n // 100)


def test_no_task_holds_a_large_pick(spark):
    twins = spark.range(3000).select((F.col("id") % 30).alias("k"))
    for n in (10, 1500, 2990):
        text = pick_keys(twins, "k", n, seed=1)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in text and "GlobalLimit" not in text and "SinglePartition" not in text


@pytest.mark.parametrize("batches", list(permutations(range(3))))
def test_marked_states_do_not_depend_on_the_order_of_batches(spark, batches):
    rows_ = [(k, o, f"v{o}", d) for k, o, d in [(1, 1, "false"), (1, 5, "false"), (1, 10, "true"), (2, 2, "true"), (2, 3, "false"), (None, 4, "false"), (None, 7, "true"), (3, 6, "true"), (None, 8, "false")]]
    changes = spark.createDataFrame(rows_, "k int, __o int, v string, __deleted string")
    state = None
    for part in batches:
        state = apply_changes(state, changes.where(F.col("__o") % 3 == part), ["k"], ["__o"], "mark")
    assert rows(live_rows(state)) == rows(spark.createDataFrame([(2, "v3"), (None, "v8")], "k int, v string"))


def test_versions_of_different_columns_are_refused(spark):
    one, two = spark.createDataFrame([(1, 2)], "k int, a int"), spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    with pytest.raises(ValueError, match="different columns"):
        diff_changes(one, two, ["k"])


def test_a_sample_stores_its_own_rows_and_few_more(spark, monkeypatch):
    held = []

    def counted(df, label):
        frame = stored(df, label)
        held.append(frame.count())
        return frame

    monkeypatch.setattr(sampling, "stored", counted)
    one = spark.range(0, 200_000, 1, 7).select((F.col("id") % 3).alias("v"))  # nothing but copies
    for n in (1, 100, 5000, 199_999):
        held.clear()
        assert sampling.sample_n(one, n, seed=5).count() == n
        assert len(held) == 1 and n <= held[0] <= n + 14 * n**0.5 + 60
    shares = [r["count"] / 5000 for r in sampling.sample_n(one, 5000, seed=6).groupBy("v").count().collect()]
    assert all(abs(s - 1 / 3) < 0.04 for s in shares)
    monkeypatch.setattr(sampling, "SPARE", -6 * 10 + -90)  # a cut that holds too few is doubled
    held.clear()
    assert sampling.sample_n(one, 100, seed=7).count() == 100 and len(held) > 1
