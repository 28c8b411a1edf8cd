"""Derived columns: date parts, hash keys, money sums and SQL-dialect arithmetic."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import schemas
from tidestar.session import require_utc


def trip_dates(df: DataFrame) -> DataFrame:
    """Pickup and drop-off dates next to their timestamps."""
    return df.withColumns(
        {
            "tpep_pickup_date": F.to_date("tpep_pickup_datetime"),
            "tpep_dropoff_date": F.to_date("tpep_dropoff_datetime"),
        }
    )


def datetime_parts(columns: Mapping[str, str]) -> list[Column]:
    """Hour, day, month and year of each ``prefix: timestamp column``."""
    parts = {"hour": F.hour, "day": F.dayofmonth, "month": F.month, "year": F.year}
    return [part(src).alias(f"{prefix}_{name}") for prefix, src in columns.items() for name, part in parts.items()]


def datetime_hash(*columns: str) -> Column:
    """SHA-256 hex of the columns' text joined by ``||``.

    Nulls are skipped by the join, so filter them out first or keys can collide.
    """
    return F.sha2(F.concat_ws("||", *columns), 256)


def with_datetime_hash(df: DataFrame, columns: Sequence[str] = tuple(schemas.EVENT_TIMES)) -> DataFrame:
    """Add ``datetime_hash``; refuses zoned timestamps outside UTC, whose text would differ by session."""
    zoned = [c for c in columns if isinstance(df.schema[c].dataType, T.TimestampType)]
    if zoned:
        require_utc(df.sparkSession, f"a hash key over {zoned}")
    return df.withColumn("datetime_hash", datetime_hash(*columns))


def packed_digest(column: str) -> Column:
    """The 32 bytes of a SHA-256 hex text, to join or count by half the bytes; equal only for equal values, whatever the text.

    Other text is followed by 33 zero bytes, which no digest has room for.
    """
    text = F.col(column)
    other = F.concat(text.cast("binary"), F.lit(bytes(33)))
    return F.when(text.rlike("^[0-9a-f]{64}\\z"), F.unhex(text)).otherwise(other).alias(column)


def component_total(components: Iterable[str], null_as_zero: bool = True) -> Column:
    """Sum of money components, rounded to cents once, in decimals throughout.

    Doubles would make the result depend on the order of addition; rounding each part would
    lose fractions of a cent that add up.
    """
    money = T.DecimalType(18, 6)
    total = F.lit(0).cast(money)
    for name in components:
        part = F.col(name).cast(money)
        total = total + (F.coalesce(part, F.lit(0).cast(money)) if null_as_zero else part)
    return F.round(total, 2).cast(T.DecimalType(14, 2))


def total_mismatch(df: DataFrame, components: Iterable[str], stored: str = "total_amount") -> DataFrame:
    """Rows whose stored total is not the sum of its components, with the difference."""
    money = T.DecimalType(14, 2)
    gap = (F.col(stored).cast(money) - component_total(components)).cast(T.DecimalType(15, 2))
    return df.withColumn("difference", gap).filter(F.col("difference") != 0)


def shift_time(column: Column, count: Column, interval: timedelta) -> Column:
    """Timestamp plus ``count`` times an interval; ``count`` may be negative."""
    return column + F.lit(interval) * count


def flag_when(condition: Column, yes: str = "Y", no: str = "N") -> Column:
    """Two-way CASE; an unknown condition counts as no."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def pg_element(values: Sequence, index: Column) -> Column:
    """1-based array subscript, null outside the array as in Postgres."""
    return F.get(F.array(*[F.lit(v) for v in values]), index - 1)


def interval_text(column: Column, unit: str) -> Column:
    """``(count || ' unit')::interval``: text joined by ``||``, then read as an interval; null for a null count."""
    return F.concat(column.cast("string"), F.lit(f" {unit}")).cast("interval")


def pg_char_cast(column: Column, length: int) -> Column:
    """``CAST(text AS char(n))``: cut to ``n`` characters and padded with blanks."""
    return F.rpad(F.substring(column, 1, length), length, " ")


def pg_numeric_cast(column: Column, precision: int, scale: int) -> Column:
    """``CAST(x AS numeric(p, s))`` of a number's shortest text: rounds half away from zero, fails on overflow."""
    exact = column.cast("string").cast("decimal(38,18)")
    rounded = F.round(exact, scale)
    fits = F.abs(rounded) < F.lit(10 ** (precision - scale))
    return F.when(fits | rounded.isNull(), rounded.cast(f"decimal({precision},{scale})")).otherwise(F.raise_error(F.lit("numeric field overflow")))


def pg_int_cast(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast to int by Postgres rules: decimals round half away from zero, doubles half to even."""

    def rounded(name: str) -> Column:
        if isinstance(df.schema[name].dataType, T.DoubleType | T.FloatType):
            return F.rint(name)
        return F.round(name, 0)

    return df.withColumns({c: rounded(c).cast("int") for c in columns})


SERIES_CHUNK = 10_000


def series(df: DataFrame, stop: Column, name: str = "i", start: int = 1) -> DataFrame:
    """One row per integer from ``start`` to ``stop`` for each input row; none where ``stop`` is lower.

    A long series is unfolded in chunks, so no row ever holds more than ``SERIES_CHUNK`` numbers of it.
    """
    none = F.array().cast("array<int>")
    marked = df.withColumn("__last", stop.cast("int"))
    chunks = F.when(F.col("__last") >= start, F.sequence(F.lit(start), F.col("__last"), F.lit(SERIES_CHUNK))).otherwise(none)
    chunked = marked.withColumn("__chunk", F.explode(chunks))
    numbers = F.sequence("__chunk", F.least("__last", F.col("__chunk") + F.lit(SERIES_CHUNK - 1)))
    return chunked.withColumn(name, F.explode(numbers)).drop("__chunk", "__last")


def insert_select(spark: SparkSession, table: str, columns: Sequence[str], query: str, **frames: DataFrame) -> None:
    """``INSERT INTO table (columns) query``, where the query may use WITH and name the frames as ``{name}``.

    It runs on the session of the frames, which inside a micro-batch is not the caller's.
    """
    own = [f.sparkSession for f in frames.values()]
    if any(not s._jsparkSession.equals(own[0]._jsparkSession) for s in own):
        raise ValueError("the frames are of different sessions")
    spark = own[0] if own else spark
    spark.sql(f"INSERT INTO {table} ({', '.join(columns)}) {query}", **frames)
