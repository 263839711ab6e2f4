"""Nearest location of a table, by going down a tree of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.geo import haversine_km
from tallyloom.session import stored

# Locations that a cell may hold before it is split, and splits at most (a cell is then 6 cm wide).
LEAF = 32
MAX_LEVEL = 13
SPLIT = 4
AXES = "xyz"


def nearest_location(
    points: DataFrame,
    locations: DataFrame,
    name: str,
    lat: str = "lat",
    long: str = "long",
    leaf: int = LEAF,
) -> DataFrame:
    """The points with the ``name`` and distance ``km`` of the location closest to each.

    ``locations`` is a table of any length with columns ``lat`` and ``long`` in degrees.
    Both sides become points of the unit sphere, so poles and the date line need no care,
    and locations lie in cubes that are cut into 4 x 4 x 4 until none holds over ``leaf``.
    Level by level a point meets the parts of its open cells. A part stays open if its box
    may be closer than some location of the parts is for certain, so a point looks at a few
    cells a level, be the locations near, far or all in one spot. What is in the last cells
    is compared exactly.

    Equal distances go to the least name, equal coordinates are looked up once. A point or
    location without a coordinate (null, NaN) is left out of the search; such points, and
    all points where there is no location, have nulls. Nothing is collected but one number
    a level.
    """
    known = locations.where(_known(F.col(lat)) & _known(F.col(long)) & F.col(name).isNotNull())
    sites = stored(
        known.groupBy((F.col(lat) + 0.0).alias("_slat"), (F.col(long) + 0.0).alias("_slong"))
        .agg(F.min(name).alias("_name"))
        .select("*", *_on_sphere("_slat", "_slong", "s")),
        "sites",
    )
    asked = points.where(_known(F.col(lat)) & _known(F.col(long))).select(
        F.col(lat).alias("_plat"), F.col(long).alias("_plong")
    )
    open_cells = asked.distinct().select("*", *_on_sphere("_plat", "_plong", "p"), F.lit(0).alias("_in"))
    level = 0
    while True:
        cells = stored(_cells(sites, level), "cells")
        fullest = cells.agg(F.max("_n")).first()[0] or 0
        met = open_cells.join(cells, "_in").withColumn("_sure", _squares([F.col(f"_p{a}") - F.col(f"_rep.{a}") for a in AXES]))
        gap = [
            F.greatest(F.col(f"_lo{a}") - F.col(f"_p{a}"), F.col(f"_p{a}") - F.col(f"_hi{a}"), F.lit(0.0)) for a in AXES
        ]
        sure = F.min("_sure").over(Window.partitionBy("_plat", "_plong"))
        # The margin is far above what rounding may add, so ties stay open.
        kept = met.withColumn("_least", _squares(gap)).withColumn("_sure", sure).where(
            F.col("_least") <= F.col("_sure") * (1 + 1e-9) + 1e-15
        )
        if fullest <= leaf or level == MAX_LEVEL:
            break
        narrow = kept.select("_plat", "_plong", *[f"_p{a}" for a in AXES], F.col("_cell").alias("_in"))
        open_cells = stored(narrow, "open-cells")
        level += 1
    inside = sites.select("_slat", "_slong", "_name", _cell_id(level).alias("_cell"))
    km = haversine_km(F.col("_plat"), F.col("_plong"), F.col("_slat"), F.col("_slong"))
    closest = (
        kept.select("_plat", "_plong", "_cell")
        .join(inside, "_cell")
        .groupBy("_plat", "_plong")
        .agg(F.min(F.struct(km.alias("km"), F.col("_name").alias("name"))).alias("_best"))
    )
    rows = points.select(F.struct("*").alias("_point"), F.col(lat).alias("_plat"), F.col(long).alias("_plong"))
    found = rows.join(stored(closest, "nearest"), ["_plat", "_plong"], "left")
    return found.select("_point.*", F.col("_best.name").alias(name), F.col("_best.km").alias("km"))


def _known(degrees: Column) -> Column:
    return degrees.isNotNull() & ~F.isnan(degrees)


def _on_sphere(lat: str, long: str, side: str) -> list[Column]:
    up, around = F.radians(lat), F.radians(long)
    return [
        (F.cos(up) * F.cos(around)).alias(f"_{side}x"),
        (F.cos(up) * F.sin(around)).alias(f"_{side}y"),
        F.sin(up).alias(f"_{side}z"),
    ]


def _squares(parts: list[Column]) -> Column:
    return sum((part * part for part in parts), F.lit(0.0))


def _cell_id(level: int) -> Column:
    """Numbers of a site's cell on the three axes; level 0 has a whole axis in two cells."""
    numbers = [F.floor(F.col(f"_s{a}") * float(SPLIT**level)) for a in AXES]
    return F.concat_ws(",", *[number.cast("string") for number in numbers])


def _cells(sites: DataFrame, level: int) -> DataFrame:
    """Cells of a level with the cell above, the box around their sites and one of the sites."""
    above = F.lit(0) if level == 0 else _cell_id(level - 1)
    boxes = [f(f"_s{a}").alias(f"_{side}{a}") for a in AXES for f, side in ((F.min, "lo"), (F.max, "hi"))]
    site = F.struct(*[F.col(f"_s{a}").alias(a) for a in AXES])
    return (
        sites.groupBy(above.alias("_in"), _cell_id(level).alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(site).alias("_rep"), *boxes)
    )
