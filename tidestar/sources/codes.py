"""Literal code lists."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidestar import schemas


def code_list(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small literal table whose first column is its unique key.

    Going through Arrow makes it a local relation with a known size, so Catalyst
    broadcasts it from its statistics; rows handed over as Python objects would
    have unknown size and plan as a shuffled join.
    """
    repeated = [k for k, n in Counter(r[0] for r in rows).items() if n > 1]
    if repeated:
        raise ValueError(f"code list keys must be unique, repeated: {repeated}")
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=schema)


def payment_types(spark: SparkSession) -> DataFrame:
    return code_list(spark, schemas.PAYMENT_TYPES, schemas.DIM_PAYMENT_TYPE)


def rate_codes(spark: SparkSession) -> DataFrame:
    return code_list(spark, schemas.RATE_CODES, schemas.DIM_RATECODE)
