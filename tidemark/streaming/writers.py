"""Streaming sinks."""

from __future__ import annotations

import threading
from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import few_state_partitions
from tidemark.sources.additive import AdditiveTable
from tidemark.sources.tables import KeyedTable, Snapshot


def _start(spark: SparkSession, writer, checkpoint: str, trigger: str | None, name: str | None = None) -> StreamingQuery:
    """Start with a processing-time trigger, or read what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    with few_state_partitions(spark):
        return writer.start()


def _query_id(batch: DataFrame) -> str | None:
    """Identity of the running query, which a new checkpoint changes."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_upserts(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    lock: threading.Lock | None = None,
    after: Callable[[Snapshot | None, Snapshot | None], None] | None = None,
    output_mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Merge every micro-batch into a keyed table.

    ``after`` gets the table's snapshots before and after the batch. With a shared ``lock``
    the batches of several queries take turns.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        with lock or nullcontext():
            before = table.snapshot()
            committed = table.upsert(batch, _query_id(batch), batch_id)
            if after:
                after(before, committed)

    return _start(rows.sparkSession, rows.writeStream.outputMode(output_mode).foreachBatch(merge), checkpoint, trigger, name)


def start_counts(
    rows: DataFrame,
    table: AdditiveTable,
    counts: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    trigger: str | None = "10 seconds",
) -> StreamingQuery:
    """Add the counts of every micro-batch to a table of sums; the rows are not aggregated in state."""

    def add(batch: DataFrame, batch_id: int) -> None:
        table.add_batch(batch, _query_id(batch), batch_id, counts)

    return _start(rows.sparkSession, rows.writeStream.foreachBatch(add), checkpoint, trigger)


def start_append(
    rows: DataFrame, path: str, checkpoint: str, trigger: str | None = "10 seconds"
) -> StreamingQuery:
    """Append rows to Parquet files, each exactly once."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(rows.sparkSession, writer, checkpoint, trigger)
