"""Posts: flat rows, popular posts per topic, places with their posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.commits import BatchLog
from tallyloom.operators.mentions import track_posts
from tallyloom.operators.merge import CountingUpsert, read_batches, split_valid
from tallyloom.operators.posts import (
    bind_types,
    nest_posts,
    popular_posts,
    post_tuple,
    posts_of_places,
    project_post,
    short_post,
    trend_names,
)
from tallyloom.operators.toplists import TopLists
from tallyloom.session import scratch_dir
from tallyloom.sources.tables import as_posts, posts, table
from tallyloom.streaming.sinks import append_sink, counting_sink, run_available
from tallyloom.streaming.sources import table_stream
from tallyloom.streaming.topics import place_posts_stream

def _arrival():
    return [F.col("doc_id")]


def _place_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is a place, each language it writes in one of its trends."""
    doc = table(spark, sf_dir, "documents")
    return doc.select(F.col("source").alias("place"), F.col("lang").alias("topic_name")).distinct()


def _topic_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).withColumn("topic_name", F.col("lang"))


def q_popular_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = _topic_posts(spark, sf_dir).select("topic_name", "doc_id", "favorite_count")
    return popular_posts(slim, "topic_name", _arrival())


def q_popular_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    return popular_posts(doc, "source", _arrival(), favs="n_chars", count=5, key=["doc_id"])


def q_popular_posts_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = _topic_posts(spark, sf_dir).select("source", "doc_id", "favorite_count", "lang")
    return popular_posts(slim, "source", _arrival(), count=5, where={"lang": "es"})


def q_short_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return short_post(posts(spark, sf_dir))


def q_nested_topic_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    trends = (
        doc.select(F.explode(F.array("lang", "source")).alias("topic_name")).distinct()
    )
    slim = _topic_posts(spark, sf_dir).select("topic_name", "doc_id", "favorite_count")
    best = popular_posts(slim, "topic_name", _arrival())
    nested = nest_posts(trends, best, "topic_name", ["doc_id", "favorite_count"])
    shown = F.transform("tweets", lambda t: F.concat_ws(":", t["rank"], t["doc_id"], t["favorite_count"]))
    return nested.select("topic_name", F.array_join(shown, ",").alias("tweets"))


def _tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = project_post(posts(spark, sf_dir), keep=["doc_id"])
    return bind_types(post_tuple(flat, F.col("source"), F.col("lang"), ["doc_id"]), ["doc_id"])


def q_post_tuple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tuples(spark, sf_dir)


def q_post_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = project_post(posts(spark, sf_dir), as_list=True, keep=["doc_id"])
    tags = F.array_join("hashtags_texts", "|").alias("hashtags_texts")
    return flat.select(
        "doc_id", "text", "author_screen_name", "created_at", tags, "place_full_name", "retweeted"
    )


def _storable():
    """Column limits of the stored table."""
    return (
        (F.length("text") <= 200)
        & F.col("created_at").isNotNull()
        & (F.length("author_screen_name") <= 50)
        & (F.length("hashtags_texts") <= 300)
        & F.coalesce(F.col("favorite_count") >= 0, F.lit(True))
    )


def q_stored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_valid(_tuples(spark, sf_dir), _storable())
    return good.select("doc_id", "text")


def q_rejected_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_valid(_tuples(spark, sf_dir), _storable())
    return bad.select("doc_id", F.length("text").alias("text_length"))


def q_place_topic_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = _place_trends(spark, sf_dir)
    places = trends.select("place").distinct()
    slim = _topic_posts(spark, sf_dir).select("topic_name", "doc_id", "favorite_count")
    return posts_of_places(
        places, trends, slim, "topic_name", tie_break=_arrival(), count=3
    ).select("place", "topic_name", "doc_id", "favorite_count", "rank")


def q_place_posts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "place-posts")
    doc = table(spark, sf_dir, "documents")
    lists = TopLists(f"{base}/lists", "topic_name", "favorite_count", ["doc_id"], 3, key=["doc_id"])
    written = table_stream(spark, sf_dir, "documents.parquet", doc.schema)
    arrived = as_posts(written).withColumn("topic_name", F.col("lang")).drop("place")
    run_available(arrived, lists.write, f"{base}/lists-checkpoint")
    stream = table_stream(spark, sf_dir, "documents.parquet", doc.select("source").schema)
    enriched = place_posts_stream(
        places=stream.select(F.col("source").alias("place")),
        trends=_place_trends(spark, sf_dir),
        posts=lists.read,
        topic="topic_name",
        tie_break=["doc_id"],
        count=3,
    )
    store = CountingUpsert(f"{base}/table", ["author_screen_name", "created_at"], ["place", "topic_name"])
    run_available(enriched.stream, enriched.into(counting_sink(store)), f"{base}/checkpoint")
    return store.read(spark).select(
        "author_screen_name", "created_at", "place", "topic_name", "favorite_count", "hits"
    )


def q_place_rejects_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places without trends and topics without posts, kept by the flow in a table."""
    base = scratch_dir(spark, "place-rejects")
    doc = table(spark, sf_dir, "documents")
    stream = table_stream(spark, sf_dir, "documents.parquet", doc.select("source", "lang").schema)
    flow = place_posts_stream(
        places=stream.select(F.explode(F.array("source", "lang")).alias("place")),
        trends=_place_trends(spark, sf_dir),
        posts=_topic_posts(spark, sf_dir).where(F.col("lang") != "es").drop("place"),
        topic="topic_name",
        tie_break=["doc_id"],
        count=3,
        key=["doc_id"],
    )
    log = BatchLog(f"{base}/log")
    sink = flow.into_tables(log, f"{base}/posts", f"{base}/rejects")
    run_available(flow.stream, sink, f"{base}/checkpoint")
    return log.read(spark, f"{base}/rejects").select("place", "topic_name")


def q_trend_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and query of the trends that each source writes in."""
    trend = F.struct(F.col("lang").alias("name"), F.upper("lang").alias("query"), F.lit(1).alias("rank"))
    trends = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.array_sort(F.collect_set(trend)).alias("trends")
    )
    shown = F.transform(trend_names(F.col("trends")), lambda t: F.concat_ws(":", t["name"], t["query"]))
    return trends.select("source", F.array_join(shown, ",").alias("trends"))


def q_tracked_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate-limited stream of posts that mention a keyword."""
    base = scratch_dir(spark, "tracked")
    schema = table(spark, sf_dir, "documents").select("doc_id", "text").schema
    stream = table_stream(spark, sf_dir, "documents.parquet", schema, max_files_per_trigger=1)
    tracked = track_posts(stream, ["Que", "Der"]).select("doc_id")
    run_available(tracked, append_sink(f"{base}/table"), f"{base}/checkpoint")
    return read_batches(spark, f"{base}/table").drop("batch_id")


QUERIES = {
    "popular_posts": q_popular_posts,
    "popular_posts_where": q_popular_posts_where,
    "popular_texts": q_popular_texts,
    "short_posts": q_short_posts,
    "nested_topic_posts": q_nested_topic_posts,
    "post_tuple": q_post_tuple,
    "post_projection": q_post_projection,
    "stored_posts": q_stored_posts,
    "rejected_posts": q_rejected_posts,
    "place_topic_posts": q_place_topic_posts,
    "place_posts_stream": q_place_posts_stream,
    "place_rejects_stream": q_place_rejects_stream,
    "trend_picks": q_trend_picks,
    "tracked_stream": q_tracked_stream,
}

_CREATED = "TIMESTAMP '2014-03-02 00:00:00' + INTERVAL 1 day * (doc_id % 28)"
_TAGS = "list_filter(string_split(text, ' '), lambda word: regexp_matches(word, '^[A-Z]'))"


def _ranked(topic: str, count: int, where: str = "true") -> str:
    return f"""
        SELECT * FROM (
            SELECT {topic} AS topic, source, lang, doc_id, n_chars AS favorite_count,
                   CAST(row_number() OVER (PARTITION BY {topic}
                        ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank
            FROM documents WHERE {where})
        WHERE rank <= {count}
    """


_TUPLE = f"""
    SELECT doc_id, 'author' || doc_id AS author_screen_name, {_CREATED} AS created_at,
           CAST(n_chars AS INTEGER) AS favorite_count,
           array_to_string(list_sort({_TAGS}), '|') AS hashtags_texts,
           CAST(NULL AS VARCHAR) AS in_reply_to_screen_name, lang,
           CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 7 AS INTEGER) END AS retweet_count,
           doc_id % 2 = 0 AS retweeted, source, source AS place,
           CAST(NULL AS BOOLEAN) AS possibly_sensitive, text, lang AS topic_name
    FROM documents
"""

ORACLES = {
    "popular_posts": f"""
        SELECT topic AS topic_name, doc_id, favorite_count, rank FROM ({_ranked("lang", 15)})
    """,
    "popular_posts_where": f"""
        SELECT source, doc_id, favorite_count, lang, rank
        FROM ({_ranked("source", 5, "lang = 'es'")})
    """,
    "popular_texts": """
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY source
                           ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank FROM documents)
        WHERE rank <= 5
    """,
    "short_posts": f"""
        SELECT text, n_chars AS favorite_count, {_CREATED} AS created_at FROM documents
    """,
    "nested_topic_posts": f"""
        SELECT t.topic_name,
               coalesce(string_agg(rank || ':' || doc_id || ':' || favorite_count, ','
                                   ORDER BY rank), '') AS tweets
        FROM (SELECT lang AS topic_name FROM documents
              UNION SELECT source FROM documents) t
        LEFT JOIN ({_ranked("lang", 15)}) p ON p.topic = t.topic_name
        GROUP BY t.topic_name
    """,
    "post_tuple": _TUPLE,
    "post_projection": f"""
        SELECT doc_id, text, 'author' || doc_id AS author_screen_name,
               {_CREATED} AS created_at, array_to_string({_TAGS}, '|') AS hashtags_texts,
               CASE WHEN doc_id % 3 <> 0 THEN source END AS place_full_name,
               doc_id % 2 = 0 AS retweeted
        FROM documents
    """,
    "stored_posts": f"""
        SELECT doc_id, text FROM ({_TUPLE})
        WHERE length(text) <= 200 AND length(hashtags_texts) <= 300
    """,
    "rejected_posts": f"""
        SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length FROM ({_TUPLE})
        WHERE NOT (length(text) <= 200 AND length(hashtags_texts) <= 300)
    """,
    "place_topic_posts": f"""
        SELECT t.place, t.topic_name, p.doc_id, p.favorite_count, p.rank
        FROM (SELECT DISTINCT source AS place, lang AS topic_name FROM documents) t
        JOIN ({_ranked("lang", 3)}) p ON p.topic = t.topic_name
    """,
    "place_posts_stream": f"""
        SELECT 'author' || p.doc_id AS author_screen_name, {_CREATED} AS created_at,
               min(t.place) AS place, min(t.topic_name) AS topic_name,
               CAST(min(p.favorite_count) AS INTEGER) AS favorite_count, count(*) AS hits
        FROM (SELECT DISTINCT source AS place, lang AS topic_name FROM documents) t
        JOIN ({_ranked("lang", 3)}) p ON p.topic = t.topic_name
        GROUP BY p.doc_id
    """,
    "place_rejects_stream": """
        SELECT DISTINCT source AS place, lang AS topic_name FROM documents WHERE lang = 'es'
        UNION ALL SELECT DISTINCT lang, CAST(NULL AS VARCHAR) FROM documents
    """,
    "trend_picks": """
        SELECT source, string_agg(lang || ':' || upper(lang), ',' ORDER BY lang) AS trends
        FROM (SELECT DISTINCT source, lang FROM documents) GROUP BY source
    """,
    "tracked_stream": """
        SELECT doc_id FROM documents
        WHERE contains(text, 'Que') OR contains(text, 'que') OR contains(text, 'Der') OR contains(text, 'der')
    """,
}
