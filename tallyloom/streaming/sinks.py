"""Stream runs and sinks for ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.merge import (
    CountingUpsert,
    insert_new_offsets,
    read_batches,
    replace_snapshot,
    split_valid,
    write_batch,
)
from tallyloom.session import state_partitions

BatchSink = Callable[[DataFrame, int], None]


@contextmanager
def _state_partitioning(spark: SparkSession):
    """A query keeps the partition count that is set when it first starts."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(state_partitions(spark)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start(
    stream: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    output_mode: str = "append",
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``sink``."""
    with _state_partitioning(stream.sparkSession):
        return (
            stream.writeStream.outputMode(output_mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .foreachBatch(sink)
            .start()
        )


def run_available(stream: DataFrame, sink: BatchSink, checkpoint: str, output_mode: str = "append") -> None:
    """Process all input that is there, then stop."""
    start(stream, sink, checkpoint, output_mode, {"availableNow": True}).awaitTermination()


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let a query run for a bounded time; stops it afterwards, fails if it failed."""
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


def console(stream: DataFrame, checkpoint: str, rows: int = 10) -> StreamingQuery:
    """Print the first rows of every micro-batch on the driver."""
    return (
        stream.writeStream.format("console")
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def updates_sink(path: str) -> BatchSink:
    """Keep the changed rows of each batch; read them with ``latest_updates``."""
    return lambda rows, batch_id: write_batch(rows, path, batch_id)


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str], value: str) -> DataFrame:
    """Last value per key of an update-mode sink."""
    return (
        read_batches(spark, path)
        .groupBy(*keys)
        .agg(F.max_by(value, "batch_id").alias(value))
    )


def append_sink(path: str) -> BatchSink:
    """Append documents; an empty batch writes nothing, a repeated one replaces itself."""
    return lambda rows, batch_id: write_batch(rows, path, batch_id)


def snapshot_sink(path: str, shape: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> BatchSink:
    def sink(rows: DataFrame, batch_id: int) -> None:
        replace_snapshot(shape(rows), path, batch_id)

    return sink


def counting_sink(
    store: CountingUpsert,
    valid=None,
    rejects: str | None = None,
    compact_every: int | None = None,
) -> BatchSink:
    """Counting upsert; rows that fail ``valid`` go to the ``rejects`` folder instead.

    Every ``compact_every`` batches the store is compacted before the batch is written.
    """

    def sink(rows: DataFrame, batch_id: int) -> None:
        if compact_every and batch_id and batch_id % compact_every == 0:
            store.compact(rows.sparkSession)
        if valid is None:
            store.write(rows, batch_id)
            return
        good, bad = split_valid(rows, valid)
        store.write(good, batch_id)
        if rejects is not None:
            write_batch(bad, rejects, batch_id)

    return sink


def offsets_sink(path: str) -> BatchSink:
    return lambda rows, _batch_id: insert_new_offsets(rows, path)
