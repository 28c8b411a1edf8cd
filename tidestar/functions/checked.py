"""Checked decoding: every record comes out once, as a row or as a reject with its text and a reason.

A checked frame has the decoded columns and ``__reject``, null for good rows. Good and bad rows so leave one parse,
and a load that keeps the frame writes both sides without reading the feed again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestar import schemas
from tidestar.functions.decode import BAD, _images

REJECT, RECORD = "__reject", "__record"
#: A reject: why, the record's text, and where in the feed it was (null where the feed doesn't say).
REJECTED = schemas.struct((schemas.TEXT, "reason key value topic"), (schemas.INT, "partition"), (schemas.LONG, "offset"))
NO_VALUE, NOT_PARSED, NO_OPERATION, NO_KEY = "no value", "does not parse", "no operation", "no key"


def with_record(records: DataFrame) -> DataFrame:
    """The records with ``__record``: what a reject tells of them."""
    have = set(records.columns)
    parts = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in REJECTED if f.name != "reason"]
    return records.withColumn(RECORD, F.struct(*parts))


def flagged_json(column: str, schema: T.StructType) -> Column:
    """Parsed JSON whose field ``_bad_record`` has the text where some of it does not parse to the schema."""
    flagged = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return F.from_json(F.col(column).cast("string"), flagged, {"columnNameOfCorruptRecord": BAD})


def mark(df: DataFrame, reason: Column) -> DataFrame:
    """``__reject`` in place of ``__record``, for rows with a reason or rejected before. Good rows keep no text."""
    told = F.when(reason.isNotNull(), F.struct(reason.alias("reason"), f"{RECORD}.*"))
    before = F.col(REJECT) if REJECT in df.columns else F.lit(None).cast(REJECTED)
    return df.withColumn(REJECT, F.coalesce(before, told.cast(REJECTED)))


def parse_checked(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Topic records of flat JSON to checked rows, parsed once."""
    parsed = with_record(records).select(RECORD, F.inline(F.array(flagged_json("value", schema))))
    reason = F.when(F.col(f"{RECORD}.value").isNull(), NO_VALUE).when(F.col(BAD).isNotNull(), NOT_PARSED)
    return mark(parsed, reason).select(*schema.fieldNames(), REJECT)


def conform_checked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``conform`` for a frame with ``__record``: values that do not fit their type reject the row, and the reason names them."""
    have = {f.name: f.dataType for f in df.schema}
    out, odd = [], []
    for field in schema:
        if field.name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{field.name}`")
        fitted = value.try_cast(field.dataType)
        out.append(fitted.alias(field.name))
        if have[field.name] != field.dataType:
            odd.append(F.when(value.isNotNull() & fitted.isNull(), F.lit(field.name)))
    misfits = F.concat_ws(", ", *odd) if odd else F.lit("")
    reason = F.when(misfits != "", F.concat(F.lit("does not fit: "), misfits))
    return mark(df, reason).select(*out, REJECT)


def unwrap_checked(
    records: DataFrame, row: T.StructType, keep: Iterable[str] = (), wrapped: bool = False, before: Iterable[str] | None = None
) -> DataFrame:
    """``unwrap_cdc`` as a checked frame that still has ``__record``: text that does not parse, or names no operation, is a reject.

    A tombstone (null value) is none; it becomes an all-null row.
    """
    old = T.StructType([f for f in row if before is None or f.name in set(before)])
    schema = schemas.envelope(row, old)
    fields = T.StructType([T.StructField("payload", schema)]) if wrapped else schema
    names = schema.fieldNames()
    parsed = with_record(records).select(*keep, RECORD, F.inline(F.array(flagged_json("value", fields))))
    parsed = parsed.select(*keep, RECORD, BAD, *([F.col(f"payload.{n}").alias(n) for n in names] if wrapped else names))
    told = F.col(f"{RECORD}.value").isNotNull()
    reason = F.when(F.col(BAD).isNotNull(), NOT_PARSED).when(told & ~F.coalesce(F.col("op").isin("r", "c", "u", "d"), F.lit(False)), NO_OPERATION)
    return _images(mark(parsed, reason), row, old, [*keep, RECORD, REJECT])


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejects(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT).isNotNull()).select(f"{REJECT}.*")


def keeping_rejects(df: DataFrame, kept: Iterable[Column]) -> DataFrame:
    """Rows that meet all conditions, and every reject: what a filter of good rows does to a checked frame."""
    condition = F.lit(True)
    for one in kept:
        condition = condition & one
    return df.filter(F.col(REJECT).isNotNull() | condition)
