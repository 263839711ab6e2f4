"""Distance on the sphere and the closest of a short list of places."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_long = F.sin(F.radians(long2 - long1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (
        half_long * half_long
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def nearest_place(
    places: Mapping[str, Mapping[str, float]], lat: Column, long: Column
) -> Column:
    """Name of the place closest to a point; equal distances go to the first name.

    ``places`` is a configured list, so it is part of the expression: each row is
    ranked where it is read and nothing is joined or shuffled.
    """
    if not places:
        raise ValueError("no places given")
    ranked = F.array(
        *[
            F.struct(
                haversine_km(lat, long, F.lit(float(at["lat"])), F.lit(float(at["long"]))).alias(
                    "km"
                ),
                F.lit(name).alias("name"),
            )
            for name, at in sorted(places.items())
        ]
    )
    known = lat.isNotNull() & long.isNotNull()
    return F.when(known, F.array_min(ranked)["name"])
