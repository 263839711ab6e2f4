"""Continuous flow: places -> their trends -> popular posts -> flat rows for a store."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.commits import BatchLog
from tallyloom.operators.merge import write_batch
from tallyloom.operators.posts import (
    POSTS_PER_TOPIC,
    bind_types,
    post_tuple,
    posts_of_places,
    project_post,
    unmatched_places,
)
from tallyloom.streaming.sinks import BatchSink


@dataclass(frozen=True)
class PlacePosts:
    """A stream of places and the lookups that each micro-batch of it is joined to.

    ``posts`` may be a function of the session, called anew for each micro-batch: with
    ``TopLists.read`` a micro-batch reads the lists of its topics instead of all posts.
    """

    stream: DataFrame
    trends: DataFrame
    posts: DataFrame | Callable[[SparkSession], DataFrame]
    topic: str
    tie_break: Sequence[str]
    count: int
    key: Sequence[str]

    def _posts(self, spark: SparkSession) -> DataFrame:
        return self.posts(spark).drop("rank") if callable(self.posts) else self.posts

    def rows(self, places: DataFrame) -> DataFrame:
        """Flat post rows of the places of one micro-batch, each place taken once.

        A place or topic without a match gives no row here; see ``rejected``.
        """
        found = posts_of_places(
            places.select("place").distinct(),
            self.trends,
            self._posts(places.sparkSession),
            self.topic,
            tie_break=[F.col(name) for name in self.tie_break],
            count=self.count,
            key=self.key,
        )
        searched = found.withColumnsRenamed({"place": "_place", self.topic: "_topic"})
        shaped = searched.withColumn("place", F.lit(None).cast("struct<full_name: string>"))
        flat = project_post(shaped, keep=["_place", "_topic"])
        return bind_types(post_tuple(flat, F.col("_place"), F.col("_topic")))

    def rejected(self, places: DataFrame) -> DataFrame:
        """The places, and topics of places, of one micro-batch that have no posts."""
        once = places.select("place").distinct()
        return unmatched_places(once, self.trends, self._posts(places.sparkSession), self.topic)

    def into(self, sink: BatchSink, rejects: str | None = None) -> BatchSink:
        """Hand rows to ``sink`` and what is rejected to the table in ``rejects``."""

        def both(places: DataFrame, batch_id: int) -> None:
            sink(self.rows(places), batch_id)
            if rejects is not None:
                write_batch(self.rejected(places), rejects, batch_id)

        return both

    def into_tables(self, log: BatchLog, posts: str, rejects: str) -> BatchSink:
        """Keep rows and what is rejected in two tables that show a batch at the same time."""

        def both(places: DataFrame, batch_id: int) -> None:
            tables = {posts: self.rows(places), rejects: self.rejected(places)}
            log.commit(places.sparkSession, batch_id, tables)

        return both


def place_posts_stream(
    places: DataFrame,
    trends: DataFrame,
    posts: DataFrame | Callable[[SparkSession], DataFrame],
    topic: str,
    tie_break: Sequence[str],
    count: int = POSTS_PER_TOPIC,
    key: Sequence[str] = (),
) -> PlacePosts:
    """``places`` is a stream with a column ``place``; ``trends`` has place and topic.

    ``posts`` are nested posts with the topic column and without ``place``, or a function
    that gives them (lists of at least ``count`` posts per topic will do); ``key``
    tells them apart, so that texts are only read for the posts chosen.
    """
    return PlacePosts(places, trends, posts, topic, tie_break, count, key)
