"""Sinks: counting upsert, snapshots, appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.merge import CountingUpsert, read_batches, read_snapshot, replace_snapshot
from tallyloom.session import scratch_dir
from tallyloom.sources.cells import counter_cells
from tallyloom.sources.files import csv_table
from tallyloom.sources.tables import table
from tallyloom.streaming.sinks import append_sink, run_available
from tallyloom.streaming.sources import table_stream


def _batch(events: DataFrame, number: int) -> DataFrame:
    return events.where(F.pmod("event_id", F.lit(3)) == number)


def q_sighting_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of two runs, one of them repeated, one repeated without rows."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    events = table(spark, sf_dir, "events").withColumn("hour", hour)
    slim = events.select("user_id", "hour", "event_id", "event_type", "value")
    store = CountingUpsert(f"{scratch_dir(spark, 'sightings')}/table", ["user_id", "hour"], ["event_id"])
    store.write(_batch(slim, 0), 0, "first")
    store.write(_batch(slim, 1), 1, "first")
    store.write(_batch(slim, 1).limit(0), 1, "first")
    # A new checkpoint counts its batches from 0 again.
    store.write(_batch(slim, 1), 0, "second")
    store.write(_batch(slim, 1), 0, "second")
    store.compact(spark)
    store.write(_batch(slim, 1), 0, "second")
    store.write(_batch(slim, 2), 1, "second")
    return store.read(spark)


def q_snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots, one repeated without rows, and one of a new count of versions."""
    path = scratch_dir(spark, "snapshot")
    events = table(spark, sf_dir, "events")
    counts = events.groupBy(F.pmod("event_id", F.lit(3)).alias("batch"), "event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    for version, batch in [(0, 0), (1, 1), (1, None), (2, 1), (0, 2), (1, None)]:
        rows = counts.where(F.col("batch").eqNullSafe(F.lit(batch)))
        shaped = rows.withColumn("user", F.col("user_id").cast("string"))
        replace_snapshot(counter_cells(shaped, "user", "event_type", "n"), path, version)
    return read_snapshot(spark, path).drop("ts")


def q_append_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "append")
    schema = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").schema
    stream = table_stream(spark, sf_dir, "events.parquet", schema)
    run_available(stream, append_sink(f"{base}/table"), f"{base}/checkpoint")
    return read_batches(spark, f"{base}/table").drop("batch_id")


def q_pooled_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended by Spark's own writer, one of them twice."""
    folder = scratch_dir(spark, "batches")
    slim = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    sink = append_sink(folder)
    for number in (0, 1, 1, 2):
        sink(_batch(slim, number), number)
    return read_batches(spark, folder).drop("batch_id")


def q_partition_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All partitions appended by Spark's own writer."""
    folder = scratch_dir(spark, "partitions")
    slim = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    slim.write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def q_csv_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    orders.write.csv(path)
    return csv_table(spark, path, orders.schema)


QUERIES = {
    "sighting_upsert": q_sighting_upsert,
    "snapshot_replace": q_snapshot_replace,
    "append_documents": q_append_documents,
    "pooled_append": q_pooled_append,
    "partition_append": q_partition_append,
    "csv_bulk_load": q_csv_bulk_load,
}

_SLIM = "SELECT event_id, user_id, event_type FROM events"

ORACLES = {
    "sighting_upsert": """
        SELECT user_id, date_trunc('hour', ts) AS hour,
               arg_min(event_id, (event_id % 3, event_id)) AS event_id,
               arg_min(event_type, (event_id % 3, event_id)) AS event_type,
               arg_min(value, (event_id % 3, event_id)) AS value, count(*) AS hits
        FROM events GROUP BY 1, 2
    """,
    "snapshot_replace": """
        SELECT CAST(user_id AS VARCHAR) AS row_key, 'mentions' AS family,
               event_type AS qualifier, CAST(count(*) AS VARCHAR) AS value
        FROM events WHERE event_id % 3 = 2 GROUP BY user_id, event_type
    """,
    "append_documents": _SLIM,
    "pooled_append": _SLIM,
    "partition_append": _SLIM,
    "csv_bulk_load": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
}
