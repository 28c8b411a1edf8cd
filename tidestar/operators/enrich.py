"""Lookups: code lists, star re-joins and their missing keys.

A code list is a local relation, so Catalyst knows its size and broadcasts it.
Other sides are left to Catalyst and AQE, which broadcast what they have measured
to be below the threshold; beyond that the join shuffles, and AQE splits the
partitions of a hot key on the fact side of a left join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar import schemas


def enrich(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Left outer join to a code list; the key comes first, unmatched codes get nulls."""
    return df.join(codes, on=key, how="left_outer")


def unknown_codes(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Values without a row in the code list, null among them, with their row counts.

    Counted before the join, so only distinct codes reach it.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(codes.select(key), on=key, how="left_anti")


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Every fact row with the attributes of its dimensions, joined left so none is lost.

    No side is broadcast but one whose bytes are known to be below the session's threshold, and
    nothing runs while the plan is built. A dimension that is only its key has
    nothing to add and is not joined.
    """
    joined, attributes = fact, []
    for name, dim in dims.items():
        key = schemas.DIM_KEYS[name]
        extra = [c for c in dim.columns if c != key]
        if extra:
            joined = joined.join(dim, on=key, how="left_outer")
            attributes += extra
    return joined.select(*fact.columns, *attributes)


def orphans(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Foreign keys without a dimension row and how many fact rows hold them; null keys are marked apart."""
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    lost = counts.join(dim.select(*keys), on=list(keys), how="left_anti")
    return lost.withColumn("null_key", reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
