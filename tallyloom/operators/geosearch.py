"""Search by geohash cell."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.geohash import box_intervals, geohash_bits, in_cell, in_intervals

# Key intervals that a search reads at most.
INTERVALS = 64


def cell_of(
    spark, ranges: Sequence[tuple[float, float]], digits: int, point: Sequence[float]
) -> str:
    """Bit string of one point's cell."""
    value = [F.lit(float(x)) for x in point]
    return spark.range(1).select(geohash_bits(ranges, digits, value)).first()[0]


def points_in_cell(points: DataFrame, bits: str, prefix: str) -> DataFrame:
    """Points whose bit string starts with the cell's bits."""
    return points.where(in_cell(F.col(bits), prefix))


def points_in_box(
    points: DataFrame,
    bits: str,
    coordinates: Sequence[Column],
    ranges: Sequence[tuple[float, float]],
    digits: int,
    low: Sequence[float],
    high: Sequence[float],
    limit: int = INTERVALS,
) -> DataFrame:
    """Points with every coordinate from ``low`` to ``high``, both included.

    ``points`` is a table sorted by ``bits``, of which at most ``limit`` key intervals are
    read; they hold the box, and the coordinates decide.
    """
    near = points.where(in_intervals(F.col(bits), box_intervals(ranges, digits, low, high, limit)))
    for x, a, b in zip(coordinates, low, high, strict=True):
        near = near.where((x >= F.lit(float(a))) & (x <= F.lit(float(b))))
    return near


def nearest_points(
    points: DataFrame,
    bits: str,
    coordinates: Sequence[Column],
    ranges: Sequence[tuple[float, float]],
    digits: int,
    target: Sequence[float],
    k: int,
    tie_break: Sequence[Column],
    limit: int = INTERVALS,
) -> DataFrame:
    """The k points closest to ``target``, numbered in ``rank``; exact.

    ``points`` is a table sorted by ``bits``. The cell around the target grows, by halving
    its bits, until it holds k points; the k-th distance there bounds the search, and only
    the box of that size around the target is read, by key intervals.
    """
    offsets = [c - F.lit(float(t)) for c, t in zip(coordinates, target, strict=True)]
    squares = [d * d for d in offsets]
    distance = sum(squares[1:], squares[0])
    own, far, length = cell_of(points.sparkSession, ranges, digits, target), None, len(ranges) * digits
    while far is None and length:
        near = points_in_cell(points, bits, own[:length]).select(distance.alias("d")).orderBy("d").limit(k)
        known = near.agg(F.max("d").alias("far"), F.count("d").alias("n")).first()
        far = known["far"] if known["n"] == k else None
        length //= 2
    candidates = points
    if far is not None:
        # A little wider than the distance, as its square is rounded.
        reach = math.sqrt(far) * (1 + 1e-9)
        low, high = [t - reach for t in target], [t + reach for t in target]
        candidates = points_in_box(points, bits, coordinates, ranges, digits, low, high, limit)
    best = candidates.withColumn("distance", distance).orderBy("distance", *tie_break).limit(k)
    # At most k rows are left, so one array of them can be sorted and numbered.
    row = F.struct("distance", *tie_break, F.struct("*").alias("row"))
    return (
        best.agg(F.array_sort(F.collect_list(row)).alias("rows"))
        .select(F.posexplode("rows").alias("pos", "item"))
        .select("item.row.*", (F.col("pos") + 1).alias("rank"))
    )
