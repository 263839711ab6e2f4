"""Geohash keys, cells, nearest points and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.encoding import base16_bits, base32_bits
from tallyloom.functions.geo import nearest_place
from tallyloom.functions.geohash import geohash_bits
from tallyloom.operators.geosearch import cell_of, nearest_points, points_in_box, points_in_cell
from tallyloom.operators.nearest import nearest_location
from tallyloom.session import stored_table
from tallyloom.sources.files import places_rows
from tallyloom.sources.tables import PLACES, VECTOR_SIZE, customer_points, table, vectors

DIMENSIONS = VECTOR_SIZE
DIGITS = 4
RANGES = [(-1.0, 1.0)] * DIMENSIONS
AXES = [f"x{i}" for i in range(DIMENSIONS)]


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = geohash_bits(RANGES, DIGITS, [F.col(axis) for axis in AXES])
    return vectors(spark, sf_dir).withColumn("bits", bits)


def _first_point(spark: SparkSession, sf_dir: str) -> list[float]:
    row = vectors(spark, sf_dir).where(F.col("vec_id") == 0).first()
    return [row[axis] for axis in AXES]


def q_geohash_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir).select("vec_id", "bits")


def q_geohash_b16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir).select("vec_id", base16_bits(F.col("bits"), DIMENSIONS * DIGITS).alias("hash"))


def q_geohash_b32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir).select("vec_id", base32_bits(F.col("bits"), DIMENSIONS * DIGITS).alias("hash"))


def q_geohash_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = cell_of(spark, RANGES, 1, _first_point(spark, sf_dir))
    return points_in_cell(_stored_hashes(spark, sf_dir), "bits", prefix).select("vec_id", "bits")


def _stored_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed points as a table in the order of their bits, so that a cell is a few row groups."""
    rows = _hashed(spark, sf_dir).select("vec_id", "bits", *AXES)
    path = stored_table(spark, "points", f"{sf_dir}/embeddings.parquet", lambda path: _write_sorted(rows, path))
    return spark.read.schema(rows.schema).parquet(path)


def _write_sorted(rows: DataFrame, path: str) -> None:
    # The second key deals a cell of very many points to several files.
    rows.repartitionByRange("bits", rows.columns[0]).sortWithinPartitions("bits").write.parquet(path)


def q_geohash_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, axes = _stored_hashes(spark, sf_dir), [F.col(axis) for axis in AXES]
    target = _first_point(spark, sf_dir)
    found = nearest_points(points, "bits", axes, RANGES, DIGITS, target, 5, [F.col("vec_id")])
    return found.select("vec_id", "rank")


EARTH = [(-90.0, 90.0), (-180.0, 180.0)]
EARTH_DIGITS = 16


def _stored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' places with geohash bits, as a table in the order of the bits."""
    points = customer_points(spark, sf_dir).select("c_custkey", "lat", "long")
    # The scan may be one part; hashes are worked out by all cores.
    points = points.repartition(spark.sparkContext.defaultParallelism, "c_custkey")
    rows = points.withColumn("bits", geohash_bits(EARTH, EARTH_DIGITS, [F.col("lat"), F.col("long")]))
    path = stored_table(spark, "places", f"{sf_dir}/customer.parquet", lambda path: _write_sorted(rows, path))
    return spark.read.schema(rows.schema).parquet(path)


def q_geohash_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in a box of latitudes and longitudes, read by key intervals."""
    at = [F.col("lat"), F.col("long")]
    points = _stored_customers(spark, sf_dir)
    return points_in_box(points, "bits", at, EARTH, EARTH_DIGITS, *BOX).select("c_custkey", "lat", "long")


def q_geohash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten customers nearest to a point, by the angles' plain distance."""
    at = [F.col("lat"), F.col("long")]
    points = _stored_customers(spark, sf_dir)
    found = nearest_points(points, "bits", at, EARTH, EARTH_DIGITS, NEAR, 10, [F.col("c_custkey")])
    return found.select("c_custkey", "rank")


BOX = (38.05, -7.05), (39.95, -4.85)
NEAR = (38.43, -6.77)


def q_geohash_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.substr("bits", F.lit(1), F.lit(DIMENSIONS * 2)).alias("cell")
    return _hashed(spark, sf_dir).groupBy(cell).agg(F.count(F.lit(1)).alias("n"))


def q_geohash_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash of the whole array; an array of another length is refused."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    bits = geohash_bits(RANGES, 2, whole)
    return table(spark, sf_dir, "embeddings").select("vec_id", bits.alias("bits"))


def q_nearest_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = nearest_place(PLACES, F.col("lat"), F.col("long")).alias("place")
    return customer_points(spark, sf_dir).select("c_custkey", place)


def q_nearest_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closest supplier of each customer; suppliers are spread over the customers' area."""
    key = F.col("s_suppkey")
    sites = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.lit(36.0) + key * 7919 % 7993 / 1000.0).alias("lat"),
        (F.lit(-9.0) + key * 104729 % 11987 / 1000.0).alias("long"),
    )
    return nearest_location(customer_points(spark, sf_dir), sites, "s_suppkey").select("c_custkey", "s_suppkey")


def q_place_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("lat", "long")
    configs = customer_points(spark, sf_dir).select(
        F.to_json(F.create_map(F.col("c_name"), at)).alias("config")
    )
    return places_rows(configs)


QUERIES = {
    "geohash_bits": q_geohash_bits,
    "geohash_b16": q_geohash_b16,
    "geohash_b32": q_geohash_b32,
    "geohash_prefix": q_geohash_prefix,
    "geohash_knn": q_geohash_knn,
    "geohash_box": q_geohash_box,
    "geohash_near": q_geohash_near,
    "geohash_cells": q_geohash_cells,
    "geohash_checked": q_geohash_checked,
    "nearest_place": q_nearest_place,
    "nearest_supplier": q_nearest_supplier,
    "place_rows": q_place_rows,
}


def _halving_sql(digits: int = 4) -> str:
    """Chain of subselects, one halving of every dimension per level."""
    sql = "SELECT vec_id, " + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}, "
        f"CAST(-1 AS DOUBLE) AS lo{i}, CAST(1 AS DOUBLE) AS hi{i}"
        for i in range(DIMENSIONS)
    )
    sql += ", '' AS bits FROM embeddings"
    for _ in range(digits):
        columns = ["vec_id"]
        bits = ["bits"]
        for i in range(DIMENSIONS):
            below = f"x{i} < (lo{i} + hi{i}) / 2"
            columns.append(f"x{i}")
            columns.append(f"CASE WHEN {below} THEN lo{i} ELSE (lo{i} + hi{i}) / 2 END AS lo{i}")
            columns.append(f"CASE WHEN {below} THEN (lo{i} + hi{i}) / 2 ELSE hi{i} END AS hi{i}")
            bits.append(f"CASE WHEN {below} THEN '0' ELSE '1' END")
        sql = f"SELECT {', '.join(columns)}, {' || '.join(bits)} AS bits FROM ({sql})"
    return sql


_BITS = _halving_sql()
_WIDTH = DIMENSIONS * DIGITS


def _letters(alphabet: str, width: int, padded: int) -> str:
    """Letters for groups of ``width`` bits of the hash with zeros added on the right."""
    bits = f"rpad(bits, {padded}, '0')"
    groups = []
    for start in range(1, padded, width):
        number = " + ".join(
            f"{1 << (width - 1 - k)} * CAST(substr({bits}, {start + k}, 1) AS INTEGER)"
            for k in range(width)
        )
        groups.append(f"substr('{alphabet}', 1 + {number}, 1)")
    return " || ".join(groups)


_BYTE_BITS = -(-_WIDTH // 8) * 8
_B16 = _letters("0123456789ABCDEF", 4, _BYTE_BITS)
_B32 = _letters("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 5, -(-_BYTE_BITS // 5) * 5)
_B32_LENGTH = -(-_BYTE_BITS // 40) * 8
_CELL = f"substr(bits, 1, {DIMENSIONS}) = (SELECT substr(bits, 1, {DIMENSIONS}) FROM h WHERE vec_id = 0)"
_SQUARES = " + ".join(f"(h.x{i} - q.x{i}) * (h.x{i} - q.x{i})" for i in range(DIMENSIONS))
_POINT = "36.0::DOUBLE + (c_custkey % 80) / 10.0::DOUBLE", "-9.0::DOUBLE + (c_custkey % 120) / 10.0::DOUBLE"

ORACLES = {
    "geohash_bits": f"SELECT vec_id, bits FROM ({_BITS})",
    "geohash_b16": f"SELECT vec_id, {_B16} AS hash FROM ({_BITS})",
    "geohash_b32": f"""
        SELECT vec_id, rpad({_B32}, {_B32_LENGTH}, '=') AS hash FROM ({_BITS})
    """,
    "geohash_prefix": f"WITH h AS ({_BITS}) SELECT vec_id, bits FROM h WHERE {_CELL}",
    "geohash_knn": f"""
        WITH h AS ({_BITS}), q AS (SELECT * FROM h WHERE vec_id = 0)
        SELECT h.vec_id,
               CAST(row_number() OVER (ORDER BY {_SQUARES}, h.vec_id) AS INTEGER) AS rank
        FROM h, q QUALIFY rank <= 5
    """,
    "geohash_box": f"""
        SELECT * FROM (SELECT c_custkey, {_POINT[0]} AS lat, {_POINT[1]} AS long FROM customer)
        WHERE lat BETWEEN {BOX[0][0]}::DOUBLE AND {BOX[1][0]}::DOUBLE
            AND long BETWEEN {BOX[0][1]}::DOUBLE AND {BOX[1][1]}::DOUBLE
    """,
    "geohash_near": f"""
        SELECT c_custkey, CAST(row_number() OVER (ORDER BY d, c_custkey) AS INTEGER) AS rank FROM (
            SELECT c_custkey, (lat - {NEAR[0]}::DOUBLE) * (lat - {NEAR[0]}::DOUBLE)
                + (long - {NEAR[1]}::DOUBLE) * (long - {NEAR[1]}::DOUBLE) AS d
            FROM (SELECT c_custkey, {_POINT[0]} AS lat, {_POINT[1]} AS long FROM customer))
        QUALIFY rank <= 10
    """,
    "geohash_cells": f"""
        SELECT substr(bits, 1, {DIMENSIONS * 2}) AS cell, count(*) AS n FROM ({_BITS}) GROUP BY 1
    """,
    "geohash_checked": f"SELECT vec_id, bits FROM ({_halving_sql(2)})",
    "nearest_place": f"""
        SELECT c_custkey, arg_min(name, km) AS place FROM (
            SELECT c_custkey, p.name,
                   asin(sqrt(pow(sin(radians(p.lat - c.lat) / 2), 2)
                        + cos(radians(c.lat)) * cos(radians(p.lat))
                          * pow(sin(radians(p.long - c.long) / 2), 2))) AS km
            FROM (SELECT c_custkey, {_POINT[0]} AS lat, {_POINT[1]} AS long FROM customer) c,
                 (VALUES {", ".join(f"('{n}', {a['lat']}::DOUBLE, {a['long']}::DOUBLE)" for n, a in PLACES.items())})
                 p(name, lat, long))
        GROUP BY c_custkey
    """,
    "nearest_supplier": f"""
        SELECT c_custkey, arg_min(s_suppkey, km) AS s_suppkey FROM (
            SELECT c_custkey, s_suppkey,
                   asin(sqrt(pow(sin(radians(s.lat - c.lat) / 2), 2)
                        + cos(radians(c.lat)) * cos(radians(s.lat))
                          * pow(sin(radians(s.long - c.long) / 2), 2))) AS km
            FROM (SELECT c_custkey, {_POINT[0]} AS lat, {_POINT[1]} AS long FROM customer) c,
                 (SELECT s_suppkey, 36.0::DOUBLE + (s_suppkey * 7919 % 7993)::DOUBLE / 1000.0::DOUBLE AS lat,
                         -9.0::DOUBLE + (s_suppkey * 104729 % 11987)::DOUBLE / 1000.0::DOUBLE AS long
                  FROM supplier) s)
        GROUP BY c_custkey
    """,
    "place_rows": f"""
        SELECT c_name AS place, {_POINT[0]} AS lat, {_POINT[1]} AS long FROM customer
    """,
}
