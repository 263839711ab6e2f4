"""A short list of places emitted at every tick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tick_times(rows: DataFrame, ts: str, seconds: int, tick: str = "tick") -> DataFrame:
    """All ticks of ``seconds`` from the first row's to the last row's, empty ones too.

    Ticks are written out day by day, so that no row holds those of a long span.
    """
    start = F.window(ts, f"{seconds} seconds")["start"]
    kind = rows.select(start.alias(tick)).schema[tick].dataType
    span = rows.select(start.cast("timestamp").cast("long").alias("at")).agg(
        F.min("at").alias("low"), F.max("at").alias("high")
    )
    run = seconds * max(86_400 // seconds, 1)
    days = span.where("low IS NOT NULL").select(
        "high", F.explode(F.sequence("low", "high", F.lit(run).cast("long"))).alias("day")
    )
    last = F.least("high", F.col("day") + run - seconds)
    ticks = days.select(F.explode(F.sequence("day", last, F.lit(seconds).cast("long"))).alias("at"))
    return ticks.select(F.timestamp_seconds("at").cast(kind).alias(tick))


def ticked_places(ticks: DataFrame, places: Sequence[str], place: str = "place") -> DataFrame:
    """Every place at every tick, batch or stream; the configured list is a literal."""
    return ticks.withColumn(place, F.explode(F.array(*[F.lit(name) for name in places])))
