from __future__ import annotations

import base64
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.encoding import base16_bits, base32_bits
from tallyloom.functions.geo import haversine_km, nearest_place
from tallyloom.functions.geohash import box_intervals, geohash_bits, in_cell, in_intervals
from tallyloom.operators.geosearch import cell_of, nearest_points, points_in_box, points_in_cell
from tallyloom.sources.tables import PLACES
from tests.conftest import rows_of

WORLD = [(-180, 180), (-90, 90)]
POINT = (-73.97, 40.78)


def cell_of_one(x: float, low: float, high: float, digits: int) -> int:
    """Number of the cell of one dimension: in which half, and where within that half."""
    if not digits:
        return 0
    middle, below = (low + high) / 2, 2 ** (digits - 1)
    if x < middle:
        return cell_of_one(x, low, middle, digits - 1)
    return below + cell_of_one(x, middle, high, digits - 1)


def woven(ranges, digits, value):
    cells = [cell_of_one(x, float(r[0]), float(r[1]), digits) for r, x in zip(ranges, value)]
    return "".join("".join(bits) for bits in zip(*[f"{cell:0{digits}b}" for cell in cells]))


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "digits, bits, b16, b32",
    [
        (3, "011001", "64", "MQ======"),
        (4, "01100101", "65", "MU======"),
        (5, "0110010111", "65C0", "MXAA===="),
        (8, "0110010111001011", "65CB", "MXFQ===="),
    ],
)
def test_golden(spark, digits, bits, b16, b32):
    column = geohash_bits(WORLD, digits, [F.lit(x) for x in POINT])
    row = spark.range(1).select(column, base16_bits(column), base32_bits(column)).first()
    assert tuple(row) == (bits, b16, b32)


@pytest.mark.parametrize(
    "ranges",
    [
        [(-1.0, 1.0), (0, 7), (-3.5, 2.25)],
        [(0.1, 0.7), (-1 / 3, 5.0)],
        [(-180, 180)],
        [(-1e-300, 1e300), (0.1, 7.7)],
    ],
)
def test_random_points(spark, ranges):
    draw = random.Random(3)
    points = [[draw.uniform(-4, 8) for _ in ranges] for _ in range(200)]
    # Points on the edges of cells and next to them.
    for digits in (1, 3, 6):
        edges = [lo + (hi - lo) * draw.randint(0, 2**digits) / 2**digits for lo, hi in ranges]
        points += [edges, [math.nextafter(x, -9) for x in edges], [math.nextafter(x, 9) for x in edges]]
    frame = spark.createDataFrame([(p,) for p in points], "v array<double>")
    for digits in (1, 7, 13, 40):
        hashed = frame.select("v", geohash_bits(ranges, digits, F.col("v")).alias("bits"))
        bits, length = F.col("bits"), digits * len(ranges)
        encoded = [base16_bits(bits), base32_bits(bits), base16_bits(bits, length), base32_bits(bits, length)]
        for value, got, b16, b32, *fixed in hashed.select("v", "bits", *encoded).collect():
            assert fixed == [b16, b32]
            want = woven(ranges, digits, value)
            assert got == want
            padded = want.ljust(-(-len(want) // 8) * 8, "0")
            raw = int(padded, 2).to_bytes(len(padded) // 8, "big")
            assert (b16, b32) == (raw.hex().upper(), base64.b32encode(raw).decode())


@pytest.mark.parametrize("size", [3, 63, 64, 130])
def test_many_dimensions_need_no_python(spark, size):
    draw = random.Random(size)
    points = [[draw.uniform(-1.2, 1.2) for _ in range(size)] for _ in range(20)]
    frame = spark.createDataFrame([(p,) for p in points], "v array<double>")
    for ranges in ([(-1.0, 1.0)] * size, [(-1.0, 1.0 / 3)] * size):
        hashed = frame.select("v", geohash_bits(ranges, 3, F.col("v")).alias("bits"))
        assert "Python" not in hashed._jdf.queryExecution().executedPlan().toString()
        assert all(got == woven(ranges, 3, value) for value, got in hashed.collect())


@pytest.mark.parametrize("limit", [1, 7, 64, 10_000])
def test_intervals_hold_the_box(limit):
    draw = random.Random(limit)
    ranges, digits = [(-1.0, 1.0), (0.1, 7.7), (0, 8)], 4
    every = [f"{n:012b}" for n in range(1 << 12)]
    for _ in range(15):
        corners = [sorted(draw.uniform(lo - 1, hi + 1) for _ in range(2)) for lo, hi in ranges]
        low, high = [c[0] for c in corners], [c[1] for c in corners]
        intervals = box_intervals(ranges, digits, low, high, limit)
        assert 1 <= len(intervals) <= limit
        held = {bits for bits in every if any(a <= bits < b for a, b in intervals)}
        first, last = ([cell_of_one(x, float(r[0]), float(r[1]), digits) for x, r in zip(c, ranges)] for c in (low, high))
        cells = [[int(bits[d::3], 2) for d in range(3)] for bits in every]
        box = {b for b, own in zip(every, cells) if all(x <= c <= y for x, c, y in zip(first, own, last))}
        assert box <= held and (limit < 10_000 or box == held)
        assert all(a[1] < b[0] for a, b in zip(intervals, intervals[1:]))


def test_box_and_nearest_read_few_row_groups(spark, tmp_path):
    draw = random.Random(9)
    points = [(i, draw.uniform(-180, 180), draw.uniform(-90, 90)) for i in range(4000)]
    frame = spark.createDataFrame(points, "id int, x double, y double")
    hashed = frame.withColumn("bits", geohash_bits(WORLD, 12, [F.col("x"), F.col("y")]))
    folder = str(tmp_path / "points")
    hashed.repartitionByRange(40, "bits").sortWithinPartitions("bits").write.parquet(folder)
    stored, at = spark.read.parquet(folder), [F.col("x"), F.col("y")]
    low, high = (-80.0, 35.0), (-60.0, 47.5)
    found = points_in_box(stored, "bits", at, WORLD, 12, low, high)
    want = {p[0] for p in points if all(a <= x <= b for a, x, b in zip(low, p[1:], high))}
    assert {r["id"] for r in found.collect()} == want and len(want) > 5
    assert "And(GreaterThanOrEqu" in found._jdf.queryExecution().executedPlan().toString()
    intervals = box_intervals(WORLD, 12, low, high)
    read = stored.where(in_intervals(F.col("bits"), intervals)).select(F.input_file_name()).distinct().count()
    assert read < 12
    for target in (POINT, (0.0, 0.0), (180.0, 90.0), (-400.0, 3.0)):
        best = nearest_points(stored, "bits", at, WORLD, 12, target, 7, [F.col("id")])
        distance = lambda p: ((p[1] - target[0]) ** 2 + (p[2] - target[1]) ** 2, p[0])  # noqa: E731, B023
        assert [r["id"] for r in best.orderBy("rank").collect()] == [p[0] for p in sorted(points, key=distance)[:7]]
    assert nearest_points(stored, "bits", at, WORLD, 12, POINT, 5000, [F.col("id")]).count() == 4000


def test_preconditions(spark):
    with pytest.raises(ValueError):
        geohash_bits([(1, 1)], 3, [F.lit(0.0)])
    with pytest.raises(ValueError):
        geohash_bits(WORLD, 3, [F.lit(0.0)])
    with pytest.raises(Exception, match="dimensions"):
        one(spark, geohash_bits(WORLD, 3, F.array(F.lit(1.0))))
    bad = spark.createDataFrame([(2.0, 1.0)], "lo double, hi double")
    with pytest.raises(Exception, match="empty or unitary"):
        bad.select(geohash_bits([(F.col("lo"), F.col("hi"))], 2, [F.lit(0.0)])).collect()


def test_outside_null_and_nan(spark):
    bits = lambda x: one(spark, geohash_bits([(0, 1)], 3, [F.lit(x).cast("double")]))
    assert (bits(-5.0), bits(5.0), bits(float("nan")), bits(None)) == ("000", "111", "111", None)


def test_prefix_search_and_nearest(spark):
    draw = random.Random(5)
    points = [(i, draw.uniform(-180, 180), draw.uniform(-90, 90)) for i in range(300)]
    frame = spark.createDataFrame(points, "id int, x double, y double")
    hashed = frame.withColumn("bits", geohash_bits(WORLD, 6, [F.col("x"), F.col("y")]))
    prefix = cell_of(spark, WORLD, 1, POINT)
    found = points_in_cell(hashed, "bits", prefix)
    inside = [p for p in points if woven(WORLD, 1, p[1:]) == prefix]
    assert {r["id"] for r in found.collect()} == {p[0] for p in inside}
    at = [F.col("x"), F.col("y")]
    best = nearest_points(hashed, "bits", at, WORLD, 6, POINT, 4, [F.col("id")])
    distance = lambda p: (p[1] - POINT[0]) ** 2 + (p[2] - POINT[1]) ** 2
    want = sorted(points, key=distance)[:4]
    assert [r["id"] for r in best.orderBy("rank").collect()] == [p[0] for p in want]
    assert one(spark, in_cell(F.lit("0110"), "01")) and not one(spark, in_cell(F.lit("10"), "01"))


def test_prefix_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("0101",), ("1100",)], "bits string").write.parquet(str(tmp_path / "p"))
    plan = points_in_cell(spark.read.parquet(str(tmp_path / "p")), "bits", "01")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(bits,01)" in text and "LessThan(bits,012)" in text
    assert rows_of(plan) == [("0101",)]


def test_nearest_place(spark):
    near = [("a", 40.0, -4.0, "Madrid"), ("b", 41.0, 2.0, "Barcelona"), ("c", 43.0, -2.0, "Donostia")]
    frame = spark.createDataFrame(near, "id string, lat double, long double, want string")
    got = frame.select("want", nearest_place(PLACES, F.col("lat"), F.col("long")))
    assert all(a == b for a, b in got.collect())
    assert one(spark, nearest_place(PLACES, F.lit(None).cast("double"), F.lit(1.0))) is None
    km = one(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert km == pytest.approx(20015.1, abs=1)
    with pytest.raises(ValueError):
        nearest_place({}, F.lit(1.0), F.lit(1.0))


def test_cells_are_worked_out_once_not_per_digit(spark):
    at = [F.col("id") * 1.5, F.col("id") * -2.5]
    bits = geohash_bits([(-90.0, 90.0), (-180.0, 180.0)], 16, at)
    frames = [spark.range(9).select(hashed) for hashed in (bits, geohash_bits([(-90.0, 90.0), (-180.0, 180.0)], 1, at))]
    sizes = [f._jdf.queryExecution().optimizedPlan().toString().count("FLOOR(") for f in frames]
    assert sizes[0] == sizes[1] > 0
