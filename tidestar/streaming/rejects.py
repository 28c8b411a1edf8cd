"""The side output of a load: records that it could not take, with the reason."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from tidestar import schemas
from tidestar.functions.checked import REJECTED, rejects
from tidestar.storage import remove_folder
from tidestar.streaming.run import query_id, with_trigger

BATCH = schemas.struct((schemas.TEXT, "run"), (schemas.LONG, "batch_id"))


def write_rejects(rows: DataFrame, root: str, run: str, batch_id: int) -> None:
    """Write the rejects of a micro-batch to its own folder, which a replay overwrites; a batch without any leaves no folder."""
    folder = f"{root}/run={run}/batch_id={batch_id}"
    if rows.isEmpty():
        remove_folder(rows.sparkSession, folder)
    else:
        rows.write.mode("overwrite").parquet(folder)


def rejects_sink(root: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the rejects of a checked stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bad = rejects(batch).persist()
        try:
            write_rejects(bad, root, query_id(batch.sparkSession), batch_id)
        finally:
            bad.unpersist()

    return write


def stream_rejects(checked: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a query that writes nothing but the rejects, beside queries that append the good rows."""
    writer = checked.writeStream.foreachBatch(rejects_sink(root)).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """All rejects with the run and batch that met them."""
    return spark.read.schema(type(REJECTED)([*REJECTED, *BATCH])).parquet(root)
