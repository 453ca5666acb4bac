"""Starting streaming queries: one query per result, always with a checkpoint."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BatchSink = Callable[[DataFrame, int], None]


def start(
    result: DataFrame,
    sinks: Sequence[BatchSink],
    checkpoint: str,
    mode: str = "update",
    available_now: bool = False,
    every: str = "1 minute",
    name: str | None = None,
) -> StreamingQuery:
    """Feed every micro-batch to all sinks from a single query.

    The source is read and the state kept once, however many sinks there are.
    With several sinks the micro-batch is kept until all have written it.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        if len(sinks) > 1:
            batch.persist()
        try:
            for sink in sinks:
                sink(batch, epoch_id)
        finally:
            if len(sinks) > 1:
                batch.unpersist()

    writer = result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).foreachBatch(write).start()


def console_sink(rows: int = 20) -> BatchSink:
    """Print the first ``rows`` rows of each micro-batch, and how many were left out."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        print(f"Batch: {epoch_id}")
        batch.persist()
        try:
            batch.show(rows, truncate=False)
            left_out = batch.count() - rows
        finally:
            batch.unpersist()
        if left_out > 0:
            print(f"{left_out} more rows are not shown")

    return write


def await_all(queries: Sequence[StreamingQuery], poll_seconds: int = 5) -> None:
    """Wait until all queries have ended.

    If any of them fails, the others are stopped and its error is raised.
    """
    streams = SparkSession.active().streams
    try:
        while any(query.isActive for query in queries):
            with contextlib.suppress(StreamingQueryException):
                # the error may be another query's; those of ours are looked up
                streams.awaitAnyTermination(poll_seconds)
            streams.resetTerminated()
            _raise_first(queries)
        _raise_first(queries)
    except BaseException:
        for query in queries:
            if query.isActive:
                query.stop()
        raise


def _raise_first(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        error = None if query.isActive else query.exception()
        if error is not None:
            raise error
