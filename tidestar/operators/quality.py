"""Row filters, fills, duplicates and constraint checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestar.operators.changes import one_per_key


def non_negative(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in columns])


def not_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def require_non_negative(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows whose columns are all >= 0. Nulls are dropped with them; NaN counts as greater and stays."""
    return df.filter(non_negative(columns))


def require_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.filter(not_null(columns))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls, and NaN in numeric columns, by column."""
    return df.fillna(dict(values))


def dedup(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """One row per key, or per distinct row without keys; of a key's rows the least by its other columns stays.

    On a stream give ``event_time`` and ``delay``, so that the state kept to
    recognise repeats stays bounded by the watermark.
    """
    subset = list(keys) if keys else None
    if not df.isStreaming:
        return one_per_key(df, subset) if subset else df.dropDuplicates()
    if not (event_time and delay):
        raise ValueError("deduplicating a stream needs event_time and delay to bound its state")
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(subset)


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Violations of each SQL CHECK condition, all counted in one pass.

    As in SQL an unknown condition passes; write NOT NULL rules as ``c IS NOT NULL``.
    """
    names = list(rules)
    counts = df.agg(*[F.count_if(~F.expr(rules[n])).alias(f"c{i}") for i, n in enumerate(names)])
    rows = [F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
