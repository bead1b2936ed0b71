"""Starting stream queries: triggers, checkpoints, file, console and batch-function sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

EVERY = "10 seconds"


def paced(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A micro-batch each ``every``, or with None all that is there now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_json_files(df: DataFrame, path: str, checkpoint: str, every: str | None = EVERY) -> StreamingQuery:
    writer = df.writeStream.format("json").outputMode("append")
    return paced(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()


def to_console(df: DataFrame, rows: int = 20, every: str | None = EVERY) -> StreamingQuery:
    writer = df.writeStream.format("console").option("truncate", False).option("numRows", rows)
    return paced(writer, every).start()


def to_function(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = EVERY, mode: str = "append"
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch. An error in it fails the query, so a batch
    counts as done only when its results are stored."""
    writer = df.writeStream.foreachBatch(handle).outputMode(mode)
    return paced(writer.option("checkpointLocation", checkpoint), every).start()
