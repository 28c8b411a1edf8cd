"""Helpers for tasks that take and give Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters that separate words; the same six that ``bytes.split()`` splits on.
SPACES = " \t\n\r\x0b\x0c"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: runs of anything but the six ASCII spaces. A null text has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


#: Bytes of a batch that a function gets at a time; Python objects take several times as much.
SLICE_BYTES = 4_000_000
#: Bytes of a batch on its way to and from Python; a session that has larger ones is set to this.
BATCH_BYTES = 8_000_000
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes for no column of the frame to have it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_ids(df: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``doc_id`` is not in ``gone``; null ids match, and any other columns may be there."""
    name = free_name(df, "gone_id")
    return df.join(gone.select(F.col("doc_id").alias(name)).distinct(), F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


def bounded_batches(df: DataFrame) -> DataFrame:
    """The frame, in a session whose batches on their way to Python are bounded in bytes."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_CONF).rstrip("b")) <= BATCH_BYTES:
        conf.set(BATCH_CONF, f"{BATCH_BYTES}b")
    return df


def map_slices(
    df: DataFrame, schema: str, run: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, Any]]], slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Apply a generator to the slices of each partition, given and returned as columns.

    Batches are bounded in bytes, and large ones are handed on in slices.
    """
    wanted = to_arrow_schema(T._parse_datatype_string(schema))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            step = max(1, batch.num_rows * slice_bytes // max(batch.nbytes, slice_bytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(slices(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in wanted], schema=wanted)

    return bounded_batches(df).mapInArrow(mapped, schema)


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict[str, list]], dict[str, Any]]]) -> DataFrame:
    """Apply a function to slices of rows, given and returned as columns.

    ``make`` is called once in each task and returns the function, so that caches and tables live
    as long as the task.
    """

    def run(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        function = make()
        yield from map(function, slices)

    return map_slices(df, schema, run)
