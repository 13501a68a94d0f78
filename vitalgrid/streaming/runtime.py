"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Triggers of the three streams.
SCORE_TRIGGER = "3 seconds"
TRAIN_TRIGGER = "10 seconds"
ENERGY_TRIGGER = "5 seconds"


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Runs `handle` per micro-batch; without a trigger interval all waiting data is processed
    and the query ends."""
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Processes all waiting data and returns; raises what the query raised."""
    start(stream, handle, checkpoint, mode=mode).awaitTermination()
