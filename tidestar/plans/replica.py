"""The last-write-wins replica of a captured table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar.functions.checked import NO_KEY, conform_checked, mark, unwrap_checked
from tidestar.functions.decode import conform, micros_to_ts, record_key, unwrap_cdc
from tidestar.storage import folders_with

MARKS = ["__op", "__ts_ms", "__lsn", "__deleted", "__offset"]


def replica_changes(
    records: DataFrame,
    captured: T.StructType,
    replica: T.StructType,
    keys: Sequence[str],
    times: Sequence[str] = (),
    wrapped: bool = False,
    checked: bool = False,
) -> DataFrame:
    """Topic records to a change frame in the replica's types.

    The key comes from the record key, so a delete or a tombstone that carries
    nothing else still names its row. ``__offset`` orders the changes of a key,
    which a feed keyed by primary key keeps in one topic partition. Values that
    do not parse are no change; ``checked`` marks them, and those without a key or with values that do not fit.
    """
    if checked:
        return _checked_changes(records, captured, replica, keys, times, wrapped)
    names = {k: f"__key_{k}" for k in keys}
    fields = T.StructType([captured[k] for k in keys])
    keyed = record_key(records, fields, wrapped).withColumnsRenamed(names)
    keyed = keyed.withColumn("__tombstone", F.col("value").isNull())
    rows = unwrap_cdc(keyed, captured, keep=[*names.values(), "offset", "__tombstone"], wrapped=wrapped)
    rows = rows.drop(*keys).withColumnsRenamed({v: k for k, v in names.items()} | {"offset": "__offset"})
    rows = rows.withColumn("__deleted", F.when(F.col("__tombstone"), "true").otherwise(F.col("__deleted")))
    marks = [T.StructField(m, rows.schema[m].dataType) for m in MARKS]
    return conform(micros_to_ts(rows.filter("__deleted IS NOT NULL"), times), T.StructType([*replica.fields, *marks]))


def _checked_changes(
    records: DataFrame, captured: T.StructType, replica: T.StructType, keys: Sequence[str], times: Sequence[str], wrapped: bool
) -> DataFrame:
    """The changes as a checked frame. Columns of a reject other than its mark mean nothing."""
    names = {k: f"__key_{k}" for k in keys}
    keyed = record_key(records, T.StructType([captured[k] for k in keys]), wrapped).withColumnsRenamed(names)
    keyed = keyed.withColumn("__tombstone", F.col("value").isNull())
    rows = unwrap_checked(keyed, captured, [*names.values(), "offset", "__tombstone"], wrapped)
    keyless = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names.values()])
    rows = mark(rows, F.when(keyless, NO_KEY))
    rows = rows.drop(*keys).withColumnsRenamed({v: k for k, v in names.items()} | {"offset": "__offset"})
    rows = rows.withColumn("__deleted", F.when(F.col("__tombstone"), "true").otherwise(F.col("__deleted")))
    marks = [T.StructField(m, rows.schema[m].dataType) for m in MARKS]
    return conform_checked(micros_to_ts(rows, times), T.StructType([*replica.fields, *marks]))


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions under a folder: those whose write committed."""
    return sorted(int(folder.rsplit("=", 1)[1]) for folder in folders_with(spark, f"{root}/v=*/_SUCCESS"))


def current_version(spark: SparkSession, root: str) -> int | None:
    versions = _versions(spark, root)
    return versions[-1] if versions else None


def read_versioned(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest complete version, or no rows before the first."""
    version = current_version(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v={version}")


def write_version(df: DataFrame, root: str) -> int:
    """Write the frame as the next version.

    Readers keep the version they opened and see the new one only once it is
    complete, so a job may read the current version and write the next.
    """
    version = (current_version(df.sparkSession, root) or 0) + 1
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
    return version
