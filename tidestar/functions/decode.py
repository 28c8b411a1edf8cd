"""Decoding: topic bytes to typed rows, change envelopes to row images, names and types to a target."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import schemas

BAD = "_bad_record"


def decode_value(records: DataFrame, column: str = "value", name: str = "json") -> DataFrame:
    """Topic bytes as text, the only column kept."""
    return records.select(F.col(column).cast("string").alias(name))


def parse_json(df: DataFrame, schema: T.StructType, column: str = "json", keep: Iterable[str] = ()) -> DataFrame:
    """JSON text to the schema's columns; permissive, so what does not parse becomes nulls.

    Field names match case-sensitively: rename afterwards with :func:`rename`.
    """
    return df.select(*keep, _once(F.from_json(F.col(column).cast("string"), schema)))


def _once(parsed: Column) -> Column:
    """The fields of a parsed struct as columns, parsed once per row.

    Selected as ``data.*``, every later filter on a field would be pushed below
    the projection and parse the text again for each of its conditions; filters
    do not move below a generator.
    """
    return F.inline(F.array(parsed))


def _payload(column: str, schema: T.StructType, wrapped: bool) -> Column:
    """Parsed JSON, taken from under ``payload`` where the converter also ships the schema."""
    text = F.col(column).cast("string")
    if not wrapped:
        return F.from_json(text, schema)
    return F.from_json(text, T.StructType([T.StructField("payload", schema)]))["payload"]


def unwrap_cdc(
    records: DataFrame,
    row: T.StructType,
    keep_tombstones: bool = True,
    keep: Iterable[str] = (),
    wrapped: bool = False,
    fields: Iterable[str] | None = None,
    before: Iterable[str] | None = None,
) -> DataFrame:
    """Change envelopes to flat row images with delete marks.

    ``fields`` names the row's fields that are wanted, and ``before`` those that a delete's old image must
    give (none of them where deletes are dropped): the parser skips all others, which no
    optimizer rule would do behind the generator that keeps the text parsed once.

    The image is ``after``, or ``before`` for a delete, whose key fields are all
    it needs to hold. ``__deleted`` is 'true' or 'false'; ``__op``, ``__ts_ms``,
    ``__lsn`` and ``source`` carry the rest of the envelope. A tombstone (null
    value) becomes an all-null row, or is dropped when ``keep_tombstones`` is off.
    """
    if not keep_tombstones:
        records = records.filter(F.col("value").isNotNull())
    some = lambda names: T.StructType([f for f in row if names is None or f.name in set(names)])
    row = some(fields)
    old = some(before)
    envelopes = records.select(*keep, _once(_payload("value", schemas.envelope(row, old), wrapped)))
    return _images(envelopes, row, old, keep)


def _images(envelopes: DataFrame, row: T.StructType, old: T.StructType, keep: Iterable[str]) -> DataFrame:
    """Parsed envelopes to row images and marks."""
    is_delete = F.col("op") == "d"
    kept = set(old.fieldNames())
    gone = lambda name: F.col(f"before.{name}") if name in kept else F.lit(None)
    image = F.struct(*(F.when(is_delete, gone(n)).otherwise(F.col(f"after.{n}")).alias(n) for n in row.fieldNames()))
    return envelopes.select(
        *keep,
        image.alias("image"),
        F.col("op").alias("__op"),
        F.col("ts_ms").alias("__ts_ms"),
        F.col("source.lsn").alias("__lsn"),
        "source",
        is_delete.cast("string").alias("__deleted"),
    ).select(*keep, "image.*", "__op", "__ts_ms", "__lsn", "source", "__deleted")


def record_key(records: DataFrame, fields: T.StructType, wrapped: bool = False) -> DataFrame:
    """Primary-key columns parsed from the record key, in front of the record's columns."""
    parsed = records.select(*records.columns, _once(_payload("key", fields, wrapped)))
    return parsed.select(*fields.fieldNames(), *records.columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Exactly the schema's columns, in its order and types; columns that are missing become nulls.

    A value that does not fit its type becomes null, or fails the job when ``strict``.
    """
    have = set(df.columns)

    def target(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType)
        column = F.col(f"`{field.name}`")
        return column.cast(field.dataType) if strict else column.try_cast(field.dataType)

    return df.select([target(f).alias(f.name) for f in schema])


def micros_to_ts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Epoch microseconds to timestamps, exactly."""
    return df.withColumns({c: F.timestamp_micros(F.col(c)) for c in columns})


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, the rest untouched."""
    found = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in found})


def split_bad(
    df: DataFrame, schema: T.StructType, column: str = "value", keep: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows that parse to the schema, and the rest with their text for logging.

    Spark does not flag a null input as corrupt, so it is counted as bad here.
    """
    flagged = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    text = F.col(column).cast("string")
    data = F.from_json(text, flagged, {"columnNameOfCorruptRecord": BAD})
    parsed = df.select(*keep, text.alias("__text"), _once(data))
    is_bad = F.col("__text").isNull() | F.col(BAD).isNotNull()
    good = parsed.filter(~is_bad).select(*keep, *schema.fieldNames())
    bad = parsed.filter(is_bad).select(*keep, F.col("__text").alias("bad_value"))
    return good, bad
