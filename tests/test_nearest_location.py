from __future__ import annotations

import math
import random

import pytest

from tallyloom.functions.geo import EARTH_RADIUS_KM
from tallyloom.operators import nearest
from tallyloom.operators.nearest import nearest_location


def km(a, b):
    lat1, long1, lat2, long2 = (math.radians(x) for x in (*a, *b))
    chord = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((long2 - long1) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(min(chord, 1.0)))


def check(spark, points, sites, **options):
    asked = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lat double, long double")
    places = spark.createDataFrame([(f"s{i:04}", *s) for i, s in enumerate(sites)], "name string, lat double, long double")
    rows = nearest_location(asked, places, "name", **options).collect()
    assert len(rows) == len(points)
    for row in rows:
        best = min(km(points[row["id"]], s) for s in sites)
        # The name is that of a location at the least distance, up to rounding.
        assert abs(row["km"] - best) < 1e-5
        assert abs(km(points[row["id"]], sites[int(row["name"][1:])]) - best) < 1e-5


def test_everywhere_on_the_globe(spark):
    pick = random.Random(1)
    spot = lambda: (math.degrees(math.asin(pick.uniform(-1, 1))), pick.uniform(-180, 180))
    check(spark, [spot() for _ in range(150)] + [(90.0, 0.0), (-90.0, 12.0), (0.0, 180.0), (0.0, -180.0)], [spot() for _ in range(400)], leaf=4)


def test_poles_and_date_line(spark):
    sites = [(89.0, 170.0), (89.5, -100.0), (-89.9, 0.0), (10.0, 179.9), (10.0, -179.0), (0.0, 0.0)]
    check(spark, [(89.9, 0.0), (90.0, 77.0), (10.0, -179.9), (10.0, 179.0), (-80.0, 30.0), (0.0, 90.0)], sites, leaf=1)


def test_locations_in_one_spot_far_from_the_points(spark):
    pick = random.Random(2)
    sites = [(40.0 + pick.random() / 1000, -3.0 + pick.random() / 1000) for _ in range(300)]
    check(spark, [(-41.0 + pick.random(), 174.0) for _ in range(40)] + [(40.0005, -3.0005)], sites, leaf=8)


def test_ties_repeats_and_unknown_coordinates(spark, monkeypatch):
    shape = "lat double, long double, name string"
    points = spark.createDataFrame([(1.0, 1.0, "a"), (1.0, 1.0, "b"), (None, 1.0, "c"), (float("nan"), 1.0, "d"), (0.0, -0.0, "e")], "lat double, long double, _name string")
    places = spark.createDataFrame([(1.0, 1.0, "y"), (1.0, 1.0, "x"), (None, 1.0, "n"), (-0.0, 0.0, "z"), (1.0, 1.0, None)], shape)
    # Equal coordinates never part, so the search ends at the last level.
    monkeypatch.setattr(nearest, "MAX_LEVEL", 2)
    got = {r["_name"]: (r["name"], r["km"]) for r in nearest_location(points, places, "name", leaf=0).collect()}
    assert got == {"a": ("x", 0.0), "b": ("x", 0.0), "c": (None, None), "d": (None, None), "e": ("z", 0.0)}
    empty = nearest_location(points, places.where("false"), "name").collect()
    assert [r["name"] for r in empty] == [None] * 5


def test_a_point_meets_few_cells(spark, monkeypatch):
    pick = random.Random(4)
    seen = {}
    keep = nearest.stored

    def counted(rows, purpose):
        table = keep(rows, purpose)
        if purpose == "open-cells":
            seen[len(seen)] = table.count()
        return table

    monkeypatch.setattr(nearest, "stored", counted)
    sites = [(pick.uniform(30, 50), pick.uniform(-10, 10)) for _ in range(2000)]
    check(spark, [(pick.uniform(30, 50), pick.uniform(-10, 10)) for _ in range(100)], sites, leaf=8)
    assert len(seen) >= 3 and max(seen.values()) < 100 * 12
