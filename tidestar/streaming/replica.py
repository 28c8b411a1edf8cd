"""Streaming replica: change batches are appended, and the last row per key is taken when read or merged."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidestar.functions.checked import REJECT, good_rows, rejects
from tidestar.operators.changes import apply_changes, latest_per_key
from tidestar.storage import folders_with, remove_folder
from tidestar.streaming.rejects import write_rejects
from tidestar.streaming.run import query_id


def replica_sink(
    root: str, keys: Sequence[str], order: Sequence[str], rejected: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch's last change per key to the batch's own folder.

    The rejects of checked changes go to the folder ``rejected``.

    Nothing stored is rewritten, so the cost of a batch does not grow with the
    replica, and a replayed batch overwrites itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = query_id(batch.sparkSession)
        folder, good = f"{root}/run={run}/batch_id={batch_id}", batch
        checked = REJECT in batch.columns
        if checked:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
            good = good_rows(batch)
        try:
            if checked and rejected:
                write_rejects(rejects(batch), rejected, run, batch_id)
            latest_per_key(good, keys, order).write.mode("overwrite").parquet(folder)
        finally:
            if checked:
                batch.unpersist()

    return write


def read_replica(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[str],
    deletes: str = "keep",
) -> DataFrame:
    """The replica's current rows; ``schema`` is that of the change frame."""
    stored = spark.read.schema(schema).parquet(root).select(*schema.fieldNames())
    return apply_changes(None, stored, keys, order, deletes)


def merge_replica(
    spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]
) -> int:
    """Fold the finished batches into one folder of last changes per key; gives the number of folders folded.

    Order and delete marks stay, so it does not matter if a folded batch is
    there again: after a failure before the old folders were removed, or when
    the stream replays it. Run it while no reader holds the old files.
    """
    folders = folders_with(spark, f"{root}/run=*/batch_id=*/_SUCCESS")
    if len(folders) < 2:
        return 0
    stored = spark.read.schema(schema).parquet(*folders)
    latest_per_key(stored, keys, order).write.parquet(f"{root}/run=merged-{uuid.uuid4().hex}/batch_id=0")
    for folder in folders:
        remove_folder(spark, folder)
    return len(folders)
