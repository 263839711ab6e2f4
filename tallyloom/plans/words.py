"""Keyword mentions, word counts, map/combine/reduce."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import blank_tokens, space_tokens
from tallyloom.operators.keywords import table_mentions
from tallyloom.operators.mapreduce import (
    grouped_lists,
    key_sorted_lists,
    map_reduce,
    map_reduce_columns,
    regrouped,
    token_counts,
)
from tallyloom.operators.merge import read_batches
from tallyloom.operators.mentions import mention_counts, sliding_counts
from tallyloom.operators.pivot import cell_pivot
from tallyloom.session import scratch_dir
from tallyloom.sources.cells import counter_cells
from tallyloom.sources.tables import table, texts
from tallyloom.streaming.sinks import append_sink, run_available
from tallyloom.streaming.sources import table_stream
from tallyloom.streaming.windows import sliding_totals

KEYWORDS = ["The", "Que", "Der", "Les", "And"]
LANGS = ["de", "en", "es", "fr"]
FLUSH = "flush"


def q_mention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mention_counts(table(spark, sf_dir, "documents"), KEYWORDS)


def q_table_mention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts per language that mention a word of the benchmark's items."""
    words = _words_of(table(spark, sf_dir, "benchmark"))
    found = table_mentions(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id", words)
    return found.groupBy("word", "lang").agg(F.count(F.lit(1)).alias("n"))


def _words_of(items: DataFrame) -> DataFrame:
    return items.select(F.explode(F.split("text", " ")).alias("word"))


def q_mention_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mention_counts(table(spark, sf_dir, "documents"), KEYWORDS)
    return cell_pivot(counter_cells(counts, "word", "lang", "n"), LANGS, family="mentions")


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(texts(spark, sf_dir, "text"), space_tokens("text"))


def q_word_count_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(texts(spark, sf_dir, "text"), blank_tokens("text"))


def _type_and_cents(_event_id, event):
    yield event["event_type"], round(event["value"] * 100)


def _total(key, values):
    yield key, sum(values)


def q_mr_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    pairs = events.select("event_id", F.struct("event_type", "value"))
    return map_reduce(
        pairs,
        _type_and_cents,
        _total,
        _total,
        mapped_schema="event_type string, total_cents bigint",
        # The scan may be one part; mappers get random parts of it.
        num_mappers=spark.sparkContext.defaultParallelism,
    )


def q_mr_sum_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.struct(F.col("event_type"), F.round(F.col("value") * 100).cast("bigint"))
    summed = map_reduce_columns(
        table(spark, sf_dir, "events"), F.array(pair), total_cents=F.sum("value")
    )
    return summed.withColumnRenamed("key", "event_type")


def q_mr_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regrouped(table(spark, sf_dir, "events").select("event_type", "event_id"))


def q_mr_key_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of event ids per user, cut to ten per row, in key order."""
    pairs = table(spark, sf_dir, "events").select("user_id", "event_id")
    return key_sorted_lists(pairs, 10).select(
        F.col("key").alias("user_id"), "chunk", F.array_join("values", ",").alias("ids")
    )


def _count_and_first(n, groups):
    words, first = 0, []
    for group in groups:
        words += group["words"]
        first = heapq.nsmallest(5, first + group["first"])
    yield n, {"words": words, "first": first}


def _word_by_count(word, n):
    yield n, {"words": 1, "first": [word]}


def q_mr_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(texts(spark, sf_dir, "text"), space_tokens("text"))
    grouped = map_reduce(
        counts,
        _word_by_count,
        _count_and_first,
        _count_and_first,
        mapped_schema="n bigint, found struct<words: bigint, first: array<string>>",
    )
    return grouped.select(
        "n", "found.words", F.array_join("found.first", " ").alias("first_words")
    )


def q_mr_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "events").select("user_id", "event_id")
    sums = F.aggregate("values", F.lit(0).cast("bigint"), lambda total, x: total + x)
    return (
        grouped_lists(pairs)
        .select("key", F.size("values").alias("size"), sums.alias("total"))
        .groupBy(F.col("key").alias("user_id"))
        .agg(F.sum("size").alias("n_values"), F.sum("total").alias("id_total"))
        .orderBy("user_id")
    )


def q_sliding_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_counts(table(spark, sf_dir, "events"), "ts", ["event_type"])


def q_sliding_mentions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows appended once they are closed; a last event a day on closes them all."""
    base = scratch_dir(spark, "sliding-mentions")
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    flush = events.agg((F.max("ts") + F.make_dt_interval(days=F.lit(1))).alias("ts"))
    flush.withColumn("event_type", F.lit(FLUSH)).write.parquet(f"{base}/flush")
    streams = [
        table_stream(spark, folder, name, events.schema)
        for folder, name in ((sf_dir, "events.parquet"), (f"{base}/flush", "*.parquet"))
    ]
    timed = streams[0].unionByName(streams[1]).withColumn("ts", F.col("ts").cast("timestamp"))
    counted = sliding_counts(timed, "ts", ["event_type"], watermark="1 minute")
    run_available(counted, append_sink(f"{base}/closed"), f"{base}/checkpoint")
    closed = read_batches(spark, f"{base}/closed").where(F.col("event_type") != FLUSH)
    return closed.select(F.col("win_start").cast("timestamp_ntz").alias("win_start"), "event_type", "n")


def q_sliding_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from pane totals in state; a tick a day on ends them all."""
    base = scratch_dir(spark, "sliding-totals")
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    last = events.agg((F.max("ts") + F.make_dt_interval(days=F.lit(1))).cast("timestamp").alias("at"))
    last.write.parquet(f"{base}/ticks")
    rows = table_stream(spark, sf_dir, "events.parquet", events.schema)
    clock = table_stream(spark, f"{base}/ticks", "*.parquet", last.schema)
    stamped = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    totals = sliding_totals(stamped, "ts", ["event_type"], clock=clock)
    run_available(totals, append_sink(f"{base}/ended"), f"{base}/checkpoint")
    return read_batches(spark, f"{base}/ended").select(
        F.col("win_start").cast("timestamp_ntz").alias("win_start"), "event_type", "n"
    )


QUERIES = {
    "mention_counts": q_mention_counts,
    "table_mention_counts": q_table_mention_counts,
    "mention_chart": q_mention_chart,
    "word_count": q_word_count,
    "word_count_ws": q_word_count_ws,
    "mr_sum": q_mr_sum,
    "mr_sum_columns": q_mr_sum_columns,
    "mr_identity": q_mr_identity,
    "mr_key_sorted": q_mr_key_sorted,
    "mr_regroup": q_mr_regroup,
    "mr_grouped": q_mr_grouped,
    "sliding_mentions": q_sliding_mentions,
    "sliding_mentions_stream": q_sliding_mentions_stream,
    "sliding_totals_stream": q_sliding_totals_stream,
}

_MENTIONS = """
    SELECT w.word AS word, d.lang AS lang, count(*) AS n
    FROM documents d, (VALUES ('The'), ('Que'), ('Der'), ('Les'), ('And')) w(word)
    WHERE contains(d.text, w.word) OR contains(d.text, lower(w.word))
    GROUP BY w.word, d.lang
"""

_WORDS = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"

_SUM = """
    SELECT event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
    FROM events GROUP BY event_type
"""

_SLIDING = """
    SELECT time_bucket(INTERVAL 20 seconds, ts) - INTERVAL 20 seconds * r.k AS win_start,
           event_type, count(*) AS n
    FROM events, range(3) r(k)
    GROUP BY 1, 2
"""

ORACLES = {
    "mention_counts": _MENTIONS,
    "table_mention_counts": """
        SELECT w.word AS word, d.lang AS lang, count(*) AS n
        FROM documents d
        JOIN (SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark)
              WHERE word <> '') w
          ON contains(d.text, w.word) OR contains(d.text, lower(w.word))
        GROUP BY w.word, d.lang
    """,
    "mention_chart": f"""
        SELECT word AS row_key,
               CAST(max(n) FILTER (WHERE lang = 'de') AS DOUBLE) AS de,
               CAST(max(n) FILTER (WHERE lang = 'en') AS DOUBLE) AS en,
               CAST(max(n) FILTER (WHERE lang = 'es') AS DOUBLE) AS es,
               CAST(max(n) FILTER (WHERE lang = 'fr') AS DOUBLE) AS fr
        FROM ({_MENTIONS}) GROUP BY word
    """,
    "word_count": f"SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY word",
    "word_count_ws": r"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_split_to_array(text, '[\s\x0b\p{Zs}]+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word
    """,
    "mr_sum": _SUM,
    "mr_sum_columns": _SUM,
    "mr_identity": "SELECT event_type, event_id FROM events",
    "mr_key_sorted": """
        SELECT user_id, CAST((rn - 1) // 10 AS INTEGER) AS chunk,
               string_agg(event_id, ',' ORDER BY event_id) AS ids
        FROM (SELECT user_id, event_id,
                     row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
        GROUP BY user_id, chunk
    """,
    "mr_regroup": f"""
        SELECT n, count(*) AS words,
               array_to_string(list_slice(list_sort(list(word)), 1, 5), ' ') AS first_words
        FROM (SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY word) GROUP BY n
    """,
    "mr_grouped": """
        SELECT user_id, count(*) AS n_values, CAST(sum(event_id) AS BIGINT) AS id_total
        FROM events GROUP BY user_id
    """,
    "sliding_mentions": _SLIDING,
    "sliding_mentions_stream": _SLIDING,
    "sliding_totals_stream": _SLIDING,
}
