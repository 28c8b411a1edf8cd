"""Keyed tables under change: latest rows, merges, change application, row-set DML and diffs.

A change frame holds row columns plus marks that start with ``__``: ``__op``
(r, c, u, d), ``__deleted`` ('true' or 'false') and any order columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns (nulls first), which must be total within a key.

    A rank filter of one makes Catalyst keep one row per key in every task before
    the shuffle, so a key with very many rows sends at most one row per task.
    """
    if not order:
        raise ValueError("last-write-wins needs an explicit order")
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key (the least by its other columns); partial aggregation folds hot keys before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return least.select(*keys, "__row.*").select(*df.columns)


def rows_to_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True, unique: bool = False
) -> DataFrame:
    """Source rows whose key the target lacks, one per key.

    With ``null_safe`` a null key matches a null key; without it, it never
    matches and is inserted again by every merge. ``unique`` says that the
    source has one row per key already, which spares a shuffle.
    """
    source = source if unique else one_per_key(source, keys)
    if not null_safe:
        return source.join(target.select(*keys), on=list(keys), how="left_anti")
    s, t = source.alias("s"), target.select(*keys).alias("t")
    return s.join(t, _all([F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]), "left_anti")


def merge_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """The target after an insert-only merge: existing rows are never changed."""
    return target.unionByName(rows_to_insert(target, source, keys, null_safe).select(*target.columns))


def merge_into(
    source: DataFrame, table: str, keys: Sequence[str], null_safe: bool = True, unique: bool = False
) -> None:
    """The same merge as a MERGE statement, for a catalog whose tables support row-level changes.

    It runs on the source's own session, which inside a micro-batch is not the caller's.
    """
    one_each = (source if unique else one_per_key(source, keys)).alias("s")
    same = Column.eqNullSafe if null_safe else Column.__eq__
    on = _all([same(F.col(f"s.{k}"), F.col(f"{table}.{k}")) for k in keys])
    one_each.mergeInto(table, on).whenNotMatched().insertAll().merge()


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    deletes: str = "apply",
) -> DataFrame:
    """The table after upserts and deletes by key.

    ``order`` says which change of a key is the last; leave it out only when
    each key changes once. ``deletes="keep"`` leaves a deleted key visible with
    its last image, as a replica without a delete mark does. A delete needs only
    its key columns.

    ``deletes="mark"`` gives a state that changes may reach in any order of batches: it keeps the order
    columns, and a deleted key stays as a row with ``__deleted``, so that an older change that comes later
    loses against the delete. It is given as the target of the next call, and read by ``live_rows``.

    Target rows that no change names are passed through an anti-join on the
    changed keys: for a small set of changes that is a broadcast, and the table
    is not shuffled. Target rows carrying the order columns are compared with the
    changes to their key, so a late, older change does not win. Null keys match each other.
    """
    if deletes not in ("apply", "keep", "mark"):
        raise ValueError(f"deletes must be 'apply', 'keep' or 'mark', not {deletes!r}")
    if deletes == "mark" and not order:
        raise ValueError("delete marks need an explicit order")
    last = latest_per_key(changes, keys, order) if order else changes
    marks = ["__deleted", *order] if deletes == "mark" else []
    if target is None:
        live = last.filter(F.col("__deleted") != "true") if deletes == "apply" else last
        return live.select(*[c for c in changes.columns if not c.startswith("__")], *[m for m in marks if m.startswith("__")])
    if not set(marks) <= set(target.columns):
        raise ValueError(f"a target without {marks} can't keep delete marks")
    t, s = target.alias("t"), last.select(*keys).alias("s")
    same = _all([F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    untouched = t.join(s, same, "left_anti")
    if order and set(order) <= set(target.columns):
        rivals = t.join(s, same, "left_semi")
        last = latest_per_key(last.unionByName(rivals, allowMissingColumns=True), keys, order)
        last = last.fillna({"__deleted": "false"})
    live = last.filter(F.col("__deleted") != "true") if deletes == "apply" else last
    return untouched.select(*target.columns).unionByName(live.select(*target.columns))


def live_rows(state: DataFrame) -> DataFrame:
    """The rows of a state with delete marks that are not deleted, without the marks."""
    return state.filter(F.col("__deleted") != "true").select([c for c in state.columns if not c.startswith("__")])


def diff_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes that turn one version of a keyed table into another.

    A row's image is the new one, or the old one for a delete. Keys must be
    unique and not null in both versions; see ``duplicate_keys``.
    """
    columns = before.columns
    if set(columns) != set(after.columns):
        raise ValueError(f"the versions have different columns: {sorted(set(columns) ^ set(after.columns))}")
    rest = [c for c in columns if c not in keys]
    b = before.select(*keys, F.struct(F.lit(1).alias("__in"), *rest).alias("b"))
    a = after.select(*keys, F.struct(F.lit(1).alias("__in"), *rest).alias("a"))
    op = (
        F.when(F.col("b").isNull(), "c")
        .when(F.col("a").isNull(), "d")
        .when(~F.col("a").eqNullSafe(F.col("b")), "u")
    )
    joined = b.join(a, on=list(keys), how="full_outer").withColumn("__op", op).filter("__op IS NOT NULL")
    return (
        joined.withColumn("image", F.coalesce("a", "b"))
        .select(*keys, *[F.col(f"image.{c}") for c in rest], "__op")
        .select(*columns, "__op", (F.col("__op") == "d").cast("string").alias("__deleted"))
    )


def where_in(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose column is among the keys, a frame rather than a literal list."""
    return df.join(keys.select(column), on=column, how="left_semi").select(*df.columns)


def update_where_in(df: DataFrame, keys: DataFrame, column: str, values: Mapping[str, object]) -> DataFrame:
    """The table with new values where its column is among the keys; other rows unchanged.

    A semi and an anti join instead of one join to the distinct keys: both split a hot value of
    the table, which a join to an aggregate would not, and AQE broadcasts the keys where it
    has measured them to be few.
    """

    def new(name: str, hit: Column) -> Column:
        if name not in values:
            return F.col(name)
        value = values[name]
        value = value if isinstance(value, Column) else F.lit(value)
        return F.when(hit, value).otherwise(F.col(name)).alias(name)

    hits = where_in(df, keys, column).select([new(c, F.lit(True)) for c in df.columns])
    return delete_where_in(df, keys, column).unionByName(hits)


def delete_where_in(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The table without the rows whose column is among the keys."""
    return df.join(keys.select(column), on=column, how="left_anti").select(*df.columns)


def affected(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """How many rows an update or delete by these keys touches."""
    return where_in(df.select(column), keys, column).agg(F.count(F.lit(1)).alias("n_rows"))
