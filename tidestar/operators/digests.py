"""Digests of a keyed table by bucket of its key, which tell where two versions differ without joining them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestar.operators.changes import diff_changes

BUCKET = "__bucket"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key; null keys have one like others."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash of a row. A hash passes over nulls, so each column comes with whether it is one."""
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts)


def bucket_digests(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """For each bucket that has rows: their number, the exclusive or of a 64-bit hash of each, and the sum of 32 bits of another.

    It aggregates before the shuffle, so a task sends one row for each bucket. Columns may have any type but map.
    """
    columns = sorted(df.columns)
    return (
        df.groupBy(key_bucket(keys, buckets).alias(BUCKET))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.bit_xor(_row_hash(columns, 1)).alias("xored"),
            F.sum(F.shiftrightunsigned(_row_hash(columns, 2), 32)).alias("summed"),
        )
    )


def differing_buckets(before: DataFrame, after: DataFrame) -> list[int]:
    """The buckets whose digests differ, or that one side lacks: at most one number for each bucket comes to the driver.

    Buckets of equal rows always have equal digests. Buckets of different rows have equal ones with a probability of about
    2^-96, as 96 bits of two hashes must agree, besides the number of rows.
    """
    b, a = before.alias("b"), after.alias("a")
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("n_rows", "xored", "summed")]
    joined = b.join(a, F.col(f"b.{BUCKET}") == F.col(f"a.{BUCKET}"), "full_outer").filter(~(same[0] & same[1] & same[2]))
    found = joined.select(F.coalesce(f"b.{BUCKET}", f"a.{BUCKET}").alias(BUCKET))
    return sorted(r[0] for r in found.collect())


def diff_by_digest(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = 1024) -> DataFrame:
    """The result of :func:`diff_changes`, of whose rows only those in differing buckets are shuffled.

    Both versions are read twice, once for the digests; ``DigestedVersions`` stores these and lays rows out by bucket, so
    that equal buckets are not read at all. Keys must be unique and not null, as there. The digests are computed when this
    is called.
    """
    if set(before.columns) != set(after.columns):
        raise ValueError(f"the versions have different columns: {sorted(set(before.columns) ^ set(after.columns))}")
    odd = differing_buckets(bucket_digests(before, keys, buckets), bucket_digests(after, keys, buckets))
    here = key_bucket(keys, buckets).isin(odd)
    return diff_changes(before.filter(here), after.filter(here), keys)
