"""The latest row of each key as the state of a streaming aggregate, of which each batch emits the keys it touched."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidestar.streaming.run import query_id, with_trigger

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_rows(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns (nulls first), as an aggregate that batches and streams share.

    Partial aggregates keep one row per key in every task, so a hot key sends one row a task. On a stream the state has
    one row for each key ever met, in the checkpoint and on the executors' disks; it grows with the keys, not with the changes.
    """
    if not order:
        raise ValueError("last-write-wins needs an explicit order")
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return changes.groupBy(*keys).agg(last).select(*keys, "__row.*").select(*changes.columns)


def changed_sink(root: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the rows a batch emits to the batch's own folder, which a replay overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/run={query_id(batch.sparkSession)}/batch_id={batch_id}")

    return write


def start_latest(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], root: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start the aggregate in update mode over a RocksDB state store.

    A batch writes the current row of each key it touched, and no other; ``read_replica`` gives the last one written of
    each key. A change older than the state of its key comes too late and leaves it as it is.
    """
    spark = changes.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS_DB)  # a query takes the session's settings when it starts
    try:
        writer = latest_rows(changes, keys, order).writeStream.outputMode("update").foreachBatch(changed_sink(root))
        return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()
    finally:
        spark.conf.set(PROVIDER, before)


def state_rows(query: StreamingQuery) -> int:
    """Rows in the state after the last batch."""
    return sum(int(s["numRowsTotal"]) for s in query.lastProgress["stateOperators"])
