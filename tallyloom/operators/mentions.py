"""Keyword mentions and their counts, whole or per sliding window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import keyword_hits, mentioned_words

# Windows per row from which a batch is counted by pane first.
PANE_OVERLAP = 6


def explode_mentions(
    posts: DataFrame, words: Sequence[str], text: str = "text", word: str = "word"
) -> DataFrame:
    """One row per post and keyword that it mentions; the other columns stay."""
    # Nulls are dropped after the explode, where generated code does it.
    return posts.withColumn(word, F.explode(keyword_hits(text, words))).where(F.col(word).isNotNull())


def track_posts(posts: DataFrame, words: Sequence[str], text: str = "text") -> DataFrame:
    """Posts that mention at least one of the keywords, batch or stream."""
    return posts.where(F.size(mentioned_words(text, words)) > 0)


def mention_counts(
    posts: DataFrame, words: Sequence[str], text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Number of posts per keyword and language: ``(word, lang, n)``."""
    slim = posts.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = explode_mentions(slim, words)
    return found.groupBy("word", "lang").agg(F.count(F.lit(1)).alias("n"))


def sliding_counts(
    rows: DataFrame,
    ts: str,
    keys: Sequence[str],
    window_seconds: int = 60,
    slide_seconds: int = 20,
    weight: Column | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Counts per key and window ``[win_start, win_start + window)``, batch or stream.

    Windows start at multiples of the slide since the epoch. Where many windows
    overlap, a batch is first counted per slide-wide pane, so that pane totals are
    copied into the windows that cover them and not every row. With few windows
    the copies merge in the partial aggregation and one shuffle is cheaper. A
    stream keeps one aggregation, as update mode allows no second one after it. With a
    ``watermark`` the state is bounded: a window is dropped, and appended once in append
    mode, when the latest time is that much past its end. ``ts`` is then a TIMESTAMP.
    """
    if watermark is not None:
        rows = rows.withWatermark(ts, watermark)
    amount = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    window, slide = f"{window_seconds} seconds", f"{slide_seconds} seconds"
    key_columns = [F.col(key) for key in keys]
    overlap, rest = divmod(window_seconds, slide_seconds)
    if rows.isStreaming or rest or overlap < PANE_OVERLAP:
        return (
            rows.groupBy(F.window(ts, window, slide).alias("win"), *key_columns)
            .agg(F.sum(amount).alias("n"))
            .select(F.col("win.start").alias("win_start"), *keys, "n")
        )
    panes = (
        rows.groupBy(F.window(ts, slide).alias("pane"), *key_columns)
        .agg(F.sum(amount).alias("n"))
        .select(F.col("pane.start").alias("pane_start"), *keys, "n")
    )
    shifted = F.array(
        *[
            F.col("pane_start") - F.make_dt_interval(secs=F.lit(step * slide_seconds))
            for step in range(overlap)
        ]
    )
    return (
        panes.select(F.explode(shifted).alias("win_start"), *keys, "n")
        .groupBy("win_start", *keys)
        .agg(F.sum("n").alias("n"))
    )
