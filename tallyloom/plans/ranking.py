"""Ranks, top lists and similar neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.neighbours import similar_neighbours
from tallyloom.operators.rank import bead_sort
from tallyloom.sources.tables import cents, table


def q_bead_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bead_sort(table(spark, sf_dir, "part"), "p_size")


def q_bead_sort_below_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select((F.col("p_size") - 10).alias("x"))
    return bead_sort(sizes, "x")


def q_bead_sort_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bead_sort(table(spark, sf_dir, "orders").select(cents("o_totalprice").alias("x")), "x")


def q_top_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.orderBy(F.desc("p_retailprice"), "p_partkey").limit(5).select("p_name")


def q_similar_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("s_nationkey").alias("age")
    )
    others = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")
    )
    found = similar_neighbours(persons, others, "age", "name", "c_custkey", k=2)
    return found.select("s_suppkey", "c_custkey", "score", "rank")


QUERIES = {
    "bead_sort": q_bead_sort,
    "bead_sort_below_one": q_bead_sort_below_one,
    "bead_sort_prices": q_bead_sort_prices,
    "top_episodes": q_top_episodes,
    "similar_neighbours": q_similar_neighbours,
}


def _positions(value: str, source: str) -> str:
    return f"""
        SELECT * FROM (SELECT row_number() OVER (ORDER BY x) - 1 AS pos, x AS value
                       FROM (SELECT CAST({value} AS BIGINT) AS x FROM {source}))
        WHERE value >= 1
    """


ORACLES = {
    "bead_sort": _positions("p_size", "part"),
    "bead_sort_below_one": _positions("p_size - 10", "part"),
    "bead_sort_prices": _positions("round(o_totalprice * 100)", "orders"),
    "top_episodes": """
        SELECT p_name FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5
    """,
    "similar_neighbours": """
        SELECT s_suppkey, c_custkey, score, rank FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY s_suppkey
                           ORDER BY score DESC, c_custkey) AS INTEGER) AS rank
            FROM (SELECT s_suppkey, c_custkey,
                         CAST(len(list_intersect(list_distinct(string_split(s_name, '')),
                                  list_distinct(string_split(c_name, '')))) AS INTEGER) AS score
                  FROM supplier JOIN customer ON s_nationkey = c_nationkey))
        WHERE rank <= 2
    """,
}
