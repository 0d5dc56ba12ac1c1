"""Incremental append as a stream: each micro-batch is deduplicated against the table and added to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from weft.operators.append import IndexedTable
from weft.session import ship


def append_stream(stream: DataFrame, path: str, checkpoint: str, within: bool = False, index: str | None = None, digits: int | None = None) -> StreamingQuery:
    """Append new rows of a stream to the Parquet table at `path`, by the hash index beside it: a micro-batch
    reads the buckets of its own hashes, never the table. A batch that runs again after a failure first ends what
    it had begun, finds all its hashes in the index and adds nothing."""
    ship(stream.sparkSession)

    def add(batch: DataFrame, _: int) -> None:
        IndexedTable(batch.sparkSession, path, index, digits).append(batch, within)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
