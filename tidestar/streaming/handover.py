"""Snapshot, then stream: a replica that starts with a snapshot of the table and goes on with its change feed.

The snapshot's rows are stored as a batch of the replica, each with the log position at which it was read. Then a mark is
written: the position at which the snapshot began. The feed is subscribed to from before the mark. Changes at or below
it are in the snapshot and are skipped, whatever their key; a later change of a key wins only if it is above the position
of the key's row, so rows may be read at different positions, in chunks, while the table goes on changing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidestar import schemas
from tidestar.functions.checked import REJECT
from tidestar.functions.decode import conform
from tidestar.storage import folders_with
from tidestar.streaming.replica import read_replica, replica_sink
from tidestar.streaming.run import with_trigger

#: The order of a key's changes; a snapshot's row comes after a change of its own position.
ORDER = ["__lsn", "__offset"]
AFTER_ALL = 2**63 - 1
MARK = schemas.struct((schemas.LONG, "position"))


def mark_path(root: str) -> str:
    return f"{root.rstrip('/')}_handover"


def handover_mark(spark: SparkSession, root: str) -> int | None:
    """The position at which the replica's snapshot began; none before the snapshot is complete."""
    path = mark_path(root)
    return spark.read.schema(MARK).parquet(path).first()["position"] if folders_with(spark, f"{path}/_SUCCESS") else None


def take_snapshot(snapshot: DataFrame, position: int, root: str, schema: T.StructType) -> int:
    """Store the snapshot as the replica's first batch, then its mark, and give the mark.

    ``position`` is the log position before the first row was read; rows read later may say so in ``__lsn``.
    ``schema`` is that of the change frame. A snapshot that is complete is never taken again: what the feed added to
    it since would be lost. One that was interrupted has no mark, and is overwritten.
    """
    spark = snapshot.sparkSession
    mark = handover_mark(spark, root)
    if mark is None:
        read_at = F.greatest("__lsn", F.lit(position)) if "__lsn" in snapshot.columns else F.lit(position)
        rows = snapshot.withColumns(
            {"__op": F.lit("r"), "__deleted": F.lit("false"), "__lsn": read_at.cast("bigint"), "__offset": F.lit(AFTER_ALL)}
        )
        conform(rows, schema, strict=True).write.mode("overwrite").parquet(f"{root}/run=snapshot/batch_id=0")
        spark.createDataFrame([(position,)], MARK).coalesce(1).write.mode("overwrite").parquet(mark_path(root))
        mark = position
    return mark


def start_handover(
    changes: DataFrame,
    root: str,
    keys: Sequence[str],
    checkpoint: str,
    every: str | None = None,
    rejected: str | None = None,
) -> StreamingQuery:
    """Start the feed behind a complete snapshot. Started again, before or after its first batch, it finds the same mark.

    Changes are those of ``replica_changes`` over a subscription that begins before the mark. Records without a position
    (tombstones, which follow a delete) are skipped; rejects of checked changes are kept.
    """
    mark = handover_mark(changes.sparkSession, root)
    if mark is None:
        raise RuntimeError(f"no complete snapshot under {root}")
    later = F.col("__lsn") > mark
    news = changes.filter(F.col(REJECT).isNotNull() | later if REJECT in changes.columns else later)
    writer = news.writeStream.foreachBatch(replica_sink(root, keys, ORDER, rejected))
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def read_handover(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], deletes: str = "apply") -> DataFrame:
    """The replica's current rows, from the snapshot and all batches of the feed."""
    return read_replica(spark, root, schema, keys, ORDER, deletes)
