"""Starting, naming and waiting for streaming queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.query import StreamingQuery


def with_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Micro-batches at an interval, or, without one, everything available now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query whose micro-batch is running.

    It comes from the checkpoint, so a restart keeps it and a new checkpoint,
    whose batches count from 0 again, gets another.
    """
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("no streaming query is running a micro-batch in this thread")
    return found


def run(queries: StreamingQuery | Iterable[StreamingQuery]) -> None:
    """Wait for one query, or for all of several; at the first failure the others are stopped, then it is raised."""
    waiting = [queries] if isinstance(queries, StreamingQuery) else list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(0.2)]
    except BaseException:
        for query in waiting:
            if query.isActive:
                query.stop()
        raise
