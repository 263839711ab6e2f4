"""Binned joins, dependent generators, maps and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.maps import merge_maps, swap
from tallyloom.operators.binned import bin_sizes, binned_join, triangular_pairs
from tallyloom.sources.tables import table


def q_binned_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return binned_join(orders, names, "custkey", num_bins=3)


def q_bin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bytes of seven bins by the MD5 of the key."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    digest = F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 7)
    number = (F.conv(digest, 16, 10).cast("bigint") % 7).cast("int")
    return bin_sizes(rows, "c_custkey", 7, number)


def q_triangular_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return triangular_pairs(sizes, "p_size").select("p_partkey", "i", "j")


def q_merged_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    later = F.create_map(F.lit("segment"), F.lower("c_mktsegment"))
    merged = merge_maps(base, later)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", merged["name"].alias("name"), merged["segment"].alias("segment")
    )


def q_swapped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.struct(F.col("o_orderkey").alias("first"), F.col("o_custkey").alias("second"))
    half = F.expr("o_custkey div 2").alias("half")
    return table(spark, sf_dir, "orders").select(swap(pair).alias("p"), half).select("p.*", "half")


def q_key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return customers.unionByName(suppliers).dropDuplicates(["nationkey"])


def q_bag_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


QUERIES = {
    "binned_join": q_binned_join,
    "bin_rows": q_bin_rows,
    "triangular_pairs": q_triangular_pairs,
    "merged_maps": q_merged_maps,
    "swapped_pairs": q_swapped_pairs,
    "key_union": q_key_union,
    "bag_union": q_bag_union,
}

ORACLES = {
    "binned_join": """
        SELECT o_custkey AS custkey, o_orderkey, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "bin_rows": """
        SELECT CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 7))::BIGINT % 7 AS INTEGER) AS bin,
            count(*) AS n_rows, CAST(sum(48 + strlen(c_name) + strlen(c_mktsegment)) AS BIGINT) AS n_bytes
        FROM customer GROUP BY 1
    """,
    "triangular_pairs": """
        SELECT p_partkey, p_size AS i, CAST(unnest(range(1, p_size + 1)) AS INTEGER) AS j FROM part
    """,
    "merged_maps": """
        SELECT c_custkey, c_name AS name, lower(c_mktsegment) AS segment FROM customer
    """,
    "swapped_pairs": """
        SELECT o_custkey AS first, o_orderkey AS second, o_custkey // 2 AS half FROM orders
    """,
    "key_union": """
        SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier
    """,
    "bag_union": "SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier",
}
