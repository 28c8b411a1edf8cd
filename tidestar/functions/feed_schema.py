"""Row types taken from the schema block that a converter ships with each value."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The converter's names of plain types.
PLAIN = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}
#: Values of this type come as encoded bytes, which JSON parsing does not read as a number.
DECIMAL = "org.apache.kafka.connect.data.Decimal"
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: Schemas in one batch of a feed beyond which something else than a schema changes from record to record.
MOST = 1000


def type_of(block: dict) -> T.DataType:
    """The type that a schema block describes. Logical times keep the number they are sent as."""
    kind = block.get("type")
    if block.get("name") == DECIMAL:
        raise ValueError(f"{block.get('field', 'a value')} is a decimal in bytes; let the connector send decimals as double or text")
    if kind == "struct":
        return T.StructType([T.StructField(f["field"], type_of(f)) for f in block["fields"]])
    if kind == "array":
        return T.ArrayType(type_of(block["items"]))
    if kind == "map":
        return T.MapType(type_of(block["keys"]), type_of(block["values"]))
    if kind not in PLAIN:
        raise ValueError(f"unknown type {kind!r} in a feed's schema")
    return PLAIN[kind]


def row_type(text: str) -> T.StructType:
    """The type of the row images in an envelope's schema block."""
    for field in json.loads(text).get("fields", []):
        if field["field"] == "after":
            return type_of(field)
    raise ValueError("a feed's schema has no row image")


def row_types(records: DataFrame) -> list[T.StructType]:
    """The row types that occur in the values of topic records, in the order of their schemas' text.

    Schemas are made distinct before they are shuffled; the driver gets at most ``MOST`` of them. Values without a schema
    (tombstones, text that does not parse) have none.
    """
    blocks = records.select(F.get_json_object(F.col("value").cast("string"), "$.schema").alias("block"))
    found = blocks.filter("block IS NOT NULL").distinct().limit(MOST + 1).collect()
    if len(found) > MOST:
        raise ValueError(f"more than {MOST} schemas in one batch")
    return [row_type(text) for text in sorted(r["block"] for r in found)]


def wider_type(a: T.DataType, b: T.DataType, name: str = "value") -> T.DataType:
    """The type that holds every value of both without loss, or ValueError.

    Whole numbers widen among themselves, those of up to 32 bits and ``float`` widen to ``double``. Structs take the
    fields of both, those of the first in front.
    """
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        have, more = {f.name: f.dataType for f in a}, {f.name: f.dataType for f in b}
        both = {n: wider_type(t, more[n], n) if n in more else t for n, t in have.items()}
        return T.StructType([T.StructField(n, t) for n, t in (both | {n: t for n, t in more.items() if n not in have}).items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider_type(a.elementType, b.elementType, name))
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    exact = [*WHOLE[:3], T.FloatType(), T.DoubleType()]
    if a in exact and b in exact:
        return T.DoubleType()
    raise ValueError(f"{name} changes from {a.simpleString()} to {b.simpleString()}, which does not hold its values")
