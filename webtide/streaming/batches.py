"""Micro-batches that know which query they belong to."""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_batches(
    stream: DataFrame, each: Callable[[DataFrame, str, int], None], checkpoint: str
) -> StreamingQuery:
    """Run each(batch, query id, batch id) over all that is there, then stop.

    Together the two ids name a batch for good: the query's id comes from the checkpoint, so it is the same after
    a restart and another one for every other checkpoint, where batch ids begin again.
    """
    started, query_id = Event(), []

    def run(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        each(batch, query_id[0], batch_id)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query_id.append(query.id)
    started.set()
    return query
