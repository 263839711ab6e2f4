"""Log records: offset ranges, idempotent inserts, payloads, ticking sources."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.merge import insert_new_offsets, read_batches, read_offsets
from tallyloom.operators.offsets import (
    batch_ranges,
    envelope,
    handle_messages,
    with_batch_offsets,
    with_record_offsets,
)
from tallyloom.operators.stages import python_stage
from tallyloom.operators.ticks import tick_times, ticked_places
from tallyloom.session import scratch_dir
from tallyloom.sources.payload import parse_payload
from tallyloom.sources.tables import PLACES, event_log, table
from tallyloom.streaming.sinks import append_sink, offsets_sink, run_available
from tallyloom.streaming.sources import looped, table_stream, tick_batches


def q_batch_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_ranges(event_log(spark, sf_dir), ["batch"])


def q_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_log(spark, sf_dir).drop("value", "key")
    return with_batch_offsets(records, ["batch"]).select(
        "event_id", "batch", "topic", "partition", "offset", "from_offset", "until_offset"
    )


def q_record_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranged = with_record_offsets(event_log(spark, sf_dir))
    place = F.concat_ws("-", "topic", "partition")
    return handle_messages(
        ranged, [F.col("key"), place.alias("topic_partition"), F.col("from_offset"), F.col("until_offset")]
    )


def q_idempotent_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'offsets')}/table"
    records = event_log(spark, sf_dir)
    for number in (0, 1, 1, 2):
        batch = records.where(F.pmod("batch", F.lit(3)) == number)
        insert_new_offsets(envelope(batch), path)
    return read_offsets(spark, path).select("topic", "partition", "offset", "key", "value")


def q_idempotent_insert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "offsets-stream")
    schema = table(spark, sf_dir, "events").schema
    # Two runs with checkpoints of their own deliver every record twice.
    for run in ("first", "second"):
        stream = table_stream(spark, sf_dir, "events.parquet", schema)
        records = stream.select(
            F.col("user_id").cast("string").alias("key"),
            F.col("props").alias("value"),
            F.lit("events").alias("topic"),
            F.pmod("event_id", F.lit(4)).cast("int").alias("partition"),
            F.expr("event_id div 4").alias("offset"),
        )
        run_available(records, offsets_sink(f"{base}/table"), f"{base}/checkpoint-{run}")
    return read_offsets(spark, f"{base}/table").select("topic", "partition", "offset", "key", "value")


def q_avro_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("value", F.col("value").cast("binary"))
    parsed = parse_payload(envelope(log), "k bigint", "json")
    return parsed.select("topic", "partition", "offset", "key", "k")


def q_ticked_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticked_places(tick_times(table(spark, sf_dir, "events"), "ts", 10), list(PLACES))


def q_loop_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents in each of two micro-batches, stamped with the current time."""
    base = scratch_dir(spark, "loop")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")

    sink = looped(docs, append_sink(f"{base}/table"))
    for _ in range(2):
        run_available(tick_batches(spark), sink, f"{base}/checkpoint")
    stored = read_batches(spark, f"{base}/table")
    return stored.groupBy("doc_id", "lang", "source").agg(
        F.count(F.lit(1)).alias("n"), F.count("timestamp").alias("stamped")
    )


class _EvenNumbers:
    """Stage state: how a record is read is settled once per task."""

    def __init__(self):
        self.parse = json.loads

    def __call__(self, record):
        number = self.parse(record["value"])["k"]
        if number % 2 == 0:
            yield record["partition"], record["offset"], number


def q_python_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).select("partition", "offset", "value")
    return python_stage(log, _EvenNumbers, "partition int, offset bigint, k bigint")


QUERIES = {
    "python_stage": q_python_stage,
    "batch_offset_ranges": q_batch_offset_ranges,
    "offset_ranges": q_offset_ranges,
    "record_offsets": q_record_offsets,
    "idempotent_insert": q_idempotent_insert,
    "idempotent_insert_stream": q_idempotent_insert_stream,
    "avro_envelope": q_avro_envelope,
    "ticked_places": q_ticked_places,
    "loop_documents": q_loop_documents,
}

_LOG = """
    SELECT CAST(user_id AS VARCHAR) AS key, props AS value, 'events' AS topic,
           CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
           event_id // 1000 AS batch, event_id
    FROM events
"""

ORACLES = {
    "python_stage": rf"""
        SELECT "partition", "offset", k FROM (
            SELECT *, CAST(regexp_extract(value, '"k": (-?\d+)', 1) AS BIGINT) AS k FROM ({_LOG}))
        WHERE k % 2 = 0
    """,
    "batch_offset_ranges": f"""
        SELECT batch, topic, "partition", min("offset") AS from_offset,
               max("offset") + 1 AS until_offset
        FROM ({_LOG}) GROUP BY batch, topic, "partition"
    """,
    "offset_ranges": f"""
        SELECT event_id, batch, topic, "partition", "offset",
               min("offset") OVER w AS from_offset, max("offset") OVER w + 1 AS until_offset
        FROM ({_LOG}) WINDOW w AS (PARTITION BY batch, topic, "partition")
    """,
    "record_offsets": f"""
        SELECT key, topic || '-' || "partition" AS topic_partition,
               "offset" AS from_offset, "offset" + 1 AS until_offset
        FROM ({_LOG})
    """,
    "idempotent_insert": f'SELECT topic, "partition", "offset", key, value FROM ({_LOG})',
    "idempotent_insert_stream": f'SELECT topic, "partition", "offset", key, value FROM ({_LOG})',
    "avro_envelope": rf"""
        SELECT topic, "partition", "offset", key,
               CAST(regexp_extract(value, '"k": (-?\d+)', 1) AS BIGINT) AS k
        FROM ({_LOG})
    """,
    "ticked_places": f"""
        SELECT t.tick, p.place
        FROM (SELECT unnest(generate_series(min(time_bucket(INTERVAL 10 seconds, ts)),
                     max(time_bucket(INTERVAL 10 seconds, ts)), INTERVAL 10 seconds)) AS tick
              FROM events) t,
             (VALUES {", ".join(f"('{name}')" for name in PLACES)}) p(place)
    """,
    "loop_documents": """
        SELECT doc_id, lang, source, CAST(2 AS BIGINT) AS n, CAST(2 AS BIGINT) AS stamped
        FROM documents
    """,
}
