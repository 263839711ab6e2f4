"""Social posts: projection to flat rows, posts per topic, popularity reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import hashtag_list, hashtags_text
from tallyloom.functions.times import from_second_text, to_second_text
from tallyloom.operators.merge import join_or_reject
from tallyloom.operators.topk import top_k_per_group, top_k_wide_rows

# The top-level post fields that the projection copies.
SHALLOW_FIELDS = [
    "text",
    "favorite_count",
    "retweeted",
    "in_reply_to_screen_name",
    "retweet_count",
    "possibly_sensitive",
    "lang",
    "created_at",
    "source",
]

# The fields of a flat post row, in their order.
TUPLE_FIELDS = [
    "author_screen_name",
    "created_at",
    "favorite_count",
    "hashtags_texts",
    "in_reply_to_screen_name",
    "lang",
    "retweet_count",
    "retweeted",
    "source",
    "place",
    "possibly_sensitive",
    "text",
    "topic_name",
]

POSTS_PER_TOPIC = 15

NESTED_POST_SCHEMA = """
    text string, favorite_count bigint, retweeted boolean, in_reply_to_screen_name string,
    retweet_count bigint, possibly_sensitive boolean, lang string, created_at timestamp_ntz,
    source string, author struct<screen_name: string>,
    entities struct<hashtags: array<struct<text: string>>>, place struct<full_name: string>
"""


def _field(posts: DataFrame, name: str) -> Column:
    """A top-level field, or a null of its type if these posts do not have it."""
    if name in posts.columns:
        return F.col(name)
    return F.lit(None).cast(T.StructType.fromDDL(NESTED_POST_SCHEMA)[name].dataType).alias(name)


def short_post(posts: DataFrame) -> DataFrame:
    """The projection used when none is given: text, favorite_count, created_at."""
    return posts.select("text", "favorite_count", "created_at")


def project_post(posts: DataFrame, as_list: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten nested posts; absent fields and an absent place become null.

    Hashtags become one sorted text, or an array in their own order with
    ``as_list``, which also leaves ``created_at`` a timestamp.
    """
    fields = [_field(posts, name) for name in SHALLOW_FIELDS if name != "created_at"]
    created = F.col("created_at") if as_list else to_second_text(F.col("created_at"))
    tags = F.col("entities.hashtags")
    return posts.select(
        *keep,
        *fields,
        created.alias("created_at"),
        F.col("author.screen_name").alias("author_screen_name"),
        (hashtag_list(tags) if as_list else hashtags_text(tags)).alias("hashtags_texts"),
        F.col("place.full_name").alias("place_full_name"),
    )


def post_tuple(projected: DataFrame, place: Column, topic: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The 13 flat fields; the searched place replaces the post's own place."""
    named = projected.withColumn("place", place).withColumn("topic_name", topic)
    return named.select(*keep, *TUPLE_FIELDS)


def bind_types(tuples: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Column types of the stored table: created_at as timestamp, counts as INT.

    A null count or flag stays null.
    """
    return tuples.withColumns(
        {
            "created_at": from_second_text(F.col("created_at")),
            "favorite_count": F.col("favorite_count").cast("int"),
            "retweet_count": F.col("retweet_count").cast("int"),
        }
    ).select(*keep, *TUPLE_FIELDS)


def trend_names(trends: Column) -> Column:
    """Keep name and query of each trend in an array of trend structs."""
    return F.transform(trends, lambda t: F.struct(t["name"].alias("name"), t["query"].alias("query")))


def popular_posts(
    posts: DataFrame,
    topic: str,
    tie_break: Sequence[Column],
    favs: str = "favorite_count",
    count: int = POSTS_PER_TOPIC,
    where: Mapping[str, object] | None = None,
    key: Sequence[str] = (),
) -> DataFrame:
    """The ``count`` posts with most favs of each topic, numbered in ``rank``.

    ``where`` are equality filters on the posts, for example ``{"lang": "es"}``.
    Name a ``key`` of the posts if they hold their texts: the texts are then only
    read for the posts chosen (see ``top_k_wide_rows``).
    """
    source = posts
    for column, wanted in (where or {}).items():
        source = source.where(F.col(column) == F.lit(wanted))
    order = [F.desc(favs), *tie_break]
    if key:
        return top_k_wide_rows(source, [topic], order, count, key)
    return top_k_per_group(source, [topic], order, count)


def posts_of_places(
    places: DataFrame, trends: DataFrame, posts: DataFrame, topic: str, **popular
) -> DataFrame:
    """Place -> its trends -> their popular posts, place and topic carried along.

    Only posts of the places' topics are looked at. The posts of a topic do not depend on
    the place, so they are cut to the popular ones before they are joined to the places.
    """
    wanted = places.join(trends, "place")
    asked = posts.join(wanted.select(topic).distinct(), topic, "left_semi")
    return wanted.join(popular_posts(asked, topic, **popular), topic)


def unmatched_places(places: DataFrame, trends: DataFrame, posts: DataFrame, topic: str) -> DataFrame:
    """``(place, topic)`` that lead to no post: places without trends, with a null topic,
    and topics of the places without posts."""
    found, without_trends = join_or_reject(places, trends, "place")
    _, without_posts = join_or_reject(found, posts.select(topic).distinct(), topic)
    no_topic = F.lit(None).cast(trends.schema[topic].dataType).alias(topic)
    return without_trends.select("place", no_topic).unionByName(without_posts.select("place", topic))


def nest_posts(
    trends: DataFrame, popular: DataFrame, topic: str, fields: Sequence[str], name: str = "tweets"
) -> DataFrame:
    """Trends with an array of their posts in rank order; ``[]`` without posts.

    ``popular`` holds a bounded number of posts per topic (see ``popular_posts``).
    """
    nested = popular.groupBy(topic).agg(
        F.array_sort(F.collect_list(F.struct("rank", *fields))).alias(name)
    )
    empty = F.array().cast(nested.schema[name].dataType)
    return trends.join(nested, topic, "left").withColumn(name, F.coalesce(name, empty))


def favs_by(posts: DataFrame, keys: Sequence[str], favs: str = "favorite_count") -> DataFrame:
    """Sum of favs per key; nulls are ignored."""
    return posts.groupBy(*keys).agg(F.sum(favs).alias("sum_favs"))
