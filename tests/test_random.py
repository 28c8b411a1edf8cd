"""Operators against brute force over random small frames with null, repeated and hot keys."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidestar.operators import apply_changes, diff_changes, latest_per_key, merge_insert, orphans, update_where_in

SEEDS = range(4)


def some_key(rng):
    """A third of the rows hold key 0, some none."""
    return 0 if rng.random() < 0.34 else rng.choice([None, *range(1, 9)])


@pytest.mark.parametrize("seed", SEEDS)
def test_latest(spark, seed):
    rng = random.Random(seed)
    data = [(some_key(rng), o, rng.choice("abc")) for o in rng.sample(range(1000), 60)]
    best = {}
    for row in sorted(data, key=lambda r: r[1]):
        best[row[0]] = row
    df = spark.createDataFrame(data, "k int, o int, v string").repartition(5)
    assert rows(latest_per_key(df, ["k"], ["o"])) == sorted(best.values(), key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_merge(spark, seed):
    rng = random.Random(seed)
    target = list({some_key(rng): None for _ in range(5)})
    source = [(some_key(rng), rng.choice("abc")) for _ in range(40)]
    t = spark.createDataFrame([(k, "t") for k in target], "k int, v string")
    s = spark.createDataFrame(source, "k int, v string").repartition(4)
    want = {k: "t" for k in target}
    for k, v in sorted(source, key=lambda r: r[1]):
        want.setdefault(k, v)
    assert rows(merge_insert(t, s, ["k"])) == sorted(want.items(), key=repr)
    plain = rows(merge_insert(t, s, ["k"], null_safe=False))
    nulls = int(None in target) + int(any(k is None for k, _ in source))
    assert sum(k is None for k, _ in plain) == nulls
    assert [r for r in plain if r[0] is not None] == sorted([r for r in want.items() if r[0] is not None], key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_apply_in_any_order_of_batches(spark, seed):
    """Changes split over two batches, applied late or early, end in the state of all at once."""
    rng = random.Random(seed)
    log = []
    for o in range(80):
        op = rng.choice("cuud")
        log.append((some_key(rng) or 0, None if op == "d" else f"v{o}", op, str(op == "d").lower(), o))
    want = {}
    for k, v, op, _, _ in log:
        want.pop(k, None)
        if op != "d":
            want[k] = v
    schema = "k int, v string, __op string, __deleted string, __o int"
    whole = spark.createDataFrame(log, schema).repartition(6)
    assert rows(apply_changes(None, whole, ["k"], ["__o"])) == sorted(want.items(), key=repr)
    first, second = spark.createDataFrame(log[:50], schema), spark.createDataFrame(log[50:], schema)
    state = apply_changes(apply_changes(None, first, ["k"], ["__o"]), second, ["k"], ["__o"])
    assert rows(state) == sorted(want.items(), key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_diff_and_apply(spark, seed):
    rng = random.Random(seed)

    def version():
        return [(k, rng.choice([None, "a", "b"]), rng.choice([None, 1.0, float("nan")])) for k in rng.sample(range(30), 20)]

    before, after = (spark.createDataFrame(version(), "k int, v string, d double") for _ in range(2))
    diff = diff_changes(before, after, ["k"])
    assert repr(rows(apply_changes(before, diff, ["k"]))) == repr(rows(after))  # as text, where NaN equals NaN
    assert diff.filter("__op = 'd'").count() == before.join(after, "k", "left_anti").count()


@pytest.mark.parametrize("seed", SEEDS)
def test_update_and_orphans(spark, seed):
    rng = random.Random(seed)
    data = [(some_key(rng), i) for i in range(50)]
    keys = [some_key(rng) for _ in range(6)]
    df = spark.createDataFrame(data, "k int, n int")
    k = spark.createDataFrame([(x,) for x in keys], "k int")
    hit = {x for x in keys if x is not None}
    want = sorted([(x, -1 if x in hit else n) for x, n in data], key=repr)
    assert rows(update_where_in(df, k, "k", {"n": -1})) == want
    lost = rows(orphans(df, k, ["k"]).select("k", F.col("n_rows").cast("int")))
    counts = {}
    for x, _ in data:
        if x not in hit:
            counts[x] = counts.get(x, 0) + 1
    assert lost == sorted(counts.items(), key=repr)
