"""Streaming sources: logs, table folders, ticking tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.files import is_folder


def starting_offsets(position: str | Mapping[str, Mapping[int, int]] = "latest") -> str:
    """Start position of a log: ``latest``, ``earliest`` or an offset per partition.

    In the map form -1 means latest and -2 earliest for that partition.
    """
    if isinstance(position, str):
        if position not in ("latest", "earliest"):
            raise ValueError(f"unknown start position {position!r}")
        return position
    return json.dumps(
        {topic: {str(p): int(o) for p, o in parts.items()} for topic, parts in position.items()}
    )


def kafka_options(
    servers: str,
    topics: str | list[str],
    position: str | Mapping[str, Mapping[int, int]] = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting_offsets(position),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_log(spark: SparkSession, as_text: bool = True, **options) -> DataFrame:
    """Records of Kafka topics; needs Spark's own Kafka module on the class path."""
    rows = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    if not as_text:
        return rows
    return rows.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def table_stream(
    spark: SparkSession,
    folder: str,
    file_name: str,
    schema: T.StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The tables of a folder as a stream; ``file_name`` is the name of one or a glob.

    A table is a parquet file or a folder of them, which may be partitioned: of a folder that
    is read by its own path, and not by a glob, Spark finds the partition columns. The braces
    make a plain name a glob too, as Spark streams a path that is no glob only if it is a folder.
    """
    path = f"{folder}/{file_name}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path if is_folder(spark, path) else f"{folder}/{{{file_name}}}")


def json_posts(spark: SparkSession, folder: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Posts dropped as JSON lines into a folder."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(folder)


def ticks(spark: SparkSession, seconds: int) -> DataFrame:
    """One row ``(tick, at)`` every ``seconds`` of the clock, whatever the trigger.

    A micro-batch that comes late gets all ticks since the one before.
    """
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1)
    at_tick = F.pmod("value", F.lit(seconds)) == 0
    return clock.load().where(at_tick).select(
        F.expr(f"value div {int(seconds)}").alias("tick"), F.col("timestamp").alias("at")
    )


def tick_batches(spark: SparkSession) -> DataFrame:
    """One row ``(tick, at)`` per micro-batch, for work that is paced by the trigger."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", 1)
        .option("numPartitions", 1)
        .load()
        .select(F.col("value").alias("tick"), F.col("timestamp").alias("at"))
    )


def stamped_now(rows: DataFrame, column: str = "timestamp") -> DataFrame:
    """Rows with the current time in epoch milliseconds, set per micro-batch."""
    return rows.withColumn(column, F.unix_millis(F.current_timestamp()))


def looped(table: DataFrame, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A sink for a tick stream that passes on all of ``table`` at every tick, stamped."""
    return lambda _tick, batch_id: sink(stamped_now(table), batch_id)
