"""Grouped reports, OLAP cube, day-level ETL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.times import to_day
from tallyloom.operators.cube import CubeSpec, olap_cube, olap_rollup, olap_slice, with_day
from tallyloom.operators.cuboids import CuboidStore
from tallyloom.operators.merge import last_by_key, upsert_by_key, write_key_ranges
from tallyloom.operators.posts import favs_by
from tallyloom.session import scratch_dir, stored_table
from tallyloom.sources.tables import table, usage_facts

USAGE = CubeSpec(
    dimensions=["host", "domain", "feature", "date_day"],
    measures=["core", "db", "active_visitor"],
)
USAGE_KEY = ["host", "domain", "feature", "date"]
USAGE_VERSION = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
USAGE_COLUMNS = [*USAGE_KEY, "date_day", *USAGE.measures]
SPLIT_POINTS = ["AO", "NF", "NO", "RF"]


def q_topic_favs(spark: SparkSession, sf_dir: str) -> DataFrame:
    favs = favs_by(table(spark, sf_dir, "documents"), ["lang"], "n_chars")
    return favs.withColumnRenamed("lang", "topic_name").orderBy(F.desc("sum_favs"))


def q_place_topic_favs(spark: SparkSession, sf_dir: str) -> DataFrame:
    favs = favs_by(table(spark, sf_dir, "documents"), ["source", "lang"], "n_chars")
    renamed = favs.withColumnsRenamed({"source": "place", "lang": "topic_name"})
    return renamed.orderBy("place", F.desc("sum_favs"))


def q_domain_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.groupBy(F.col("l_linestatus").alias("domain")).agg(F.count(F.lit(1)).alias("n"))


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def _daily_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_day(usage_facts(spark, sf_dir), "date")


def q_olap_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return olap_cube(_daily_facts(spark, sf_dir), USAGE)


def q_olap_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return olap_rollup(_daily_facts(spark, sf_dir), USAGE, ["host", "domain"])


def q_olap_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _daily_facts(spark, sf_dir)
    return olap_slice(facts, USAGE, axes=["host", "feature"])


def q_olap_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _daily_facts(spark, sf_dir)
    return olap_slice(facts, USAGE, axes=["host"], where={"feature": "1-URGENT"})


def _cuboids(spark: SparkSession, sf_dir: str) -> CuboidStore:
    """Cuboids of the usage facts, built once for each state of the tables."""

    def build(path: str) -> None:
        CuboidStore(path, USAGE).build(_daily_facts(spark, sf_dir))

    return CuboidStore(stored_table(spark, "cuboids", sf_dir, build), USAGE)


def q_olap_stored_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cuboids(spark, sf_dir).slice(spark, axes=["host", "feature"])


def q_olap_stored_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cuboids(spark, sf_dir).slice(spark, axes=["host"], where={"feature": "1-URGENT"})


def q_etl_day_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _daily_facts(spark, sf_dir)
    return last_by_key(facts, USAGE_KEY, USAGE_VERSION).select(*USAGE_COLUMNS)


def q_key_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _daily_facts(spark, sf_dir).select(*USAGE_COLUMNS, *USAGE_VERSION)
    stored = last_by_key(facts.where(F.col("l_linenumber") % 2 == 1), USAGE_KEY, USAGE_VERSION)
    incoming = facts.where(F.col("l_linenumber") % 2 == 0)
    return upsert_by_key(stored, incoming, USAGE_KEY, USAGE_VERSION).select(*USAGE_COLUMNS)


def q_events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = to_day(F.col("ts")).alias("day")
    events = table(spark, sf_dir, "events")
    return events.groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n"))


def q_key_range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items stored by key range, and what the folder of each range holds."""
    key = F.concat("l_returnflag", "l_linestatus")
    line = table(spark, sf_dir, "lineitem").select(key.alias("k"), "l_orderkey", "l_linenumber")
    path = scratch_dir(spark, "key-ranges")
    write_key_ranges(line, path, F.col("k"), SPLIT_POINTS, ["k", "l_orderkey", "l_linenumber"])
    return spark.read.parquet(path).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("first_key"), F.max("k").alias("last_key")
    )


QUERIES = {
    "topic_favs": q_topic_favs,
    "place_topic_favs": q_place_topic_favs,
    "domain_count": q_domain_count,
    "row_count": q_row_count,
    "olap_cube": q_olap_cube,
    "olap_rollup": q_olap_rollup,
    "olap_slice": q_olap_slice,
    "olap_member": q_olap_member,
    "olap_stored_slice": q_olap_stored_slice,
    "olap_stored_member": q_olap_stored_member,
    "etl_day_upsert": q_etl_day_upsert,
    "key_upsert": q_key_upsert,
    "events_by_day": q_events_by_day,
    "key_range_split": q_key_range_split,
}

_FACTS = """
    SELECT l_returnflag AS f_host, l_linestatus AS f_domain, o_orderpriority AS f_feature,
           l_shipdate AS f_date, CAST(l_shipdate AS DATE) AS f_day,
           CAST(l_quantity AS BIGINT) AS f_core,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS f_db,
           l_linenumber AS f_visitor, l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

_SUMS = """
    CAST(sum(f_core) AS BIGINT) AS core, CAST(sum(f_db) AS BIGINT) AS db,
    CAST(sum(f_visitor) AS BIGINT) AS active_visitor
"""


def _label(column: str, name: str) -> str:
    return (
        f"CASE WHEN grouping({column}) = 1 THEN 'All Types' "
        f"ELSE CAST({column} AS VARCHAR) END AS {name}"
    )


_MEMBERS = ", ".join(
    [
        _label("f_host", "host"),
        _label("f_domain", "domain"),
        _label("f_feature", "feature"),
        _label("f_day", "date_day"),
    ]
)


def _last_version(order: str) -> str:
    return f"""
        SELECT f_host AS host, f_domain AS domain, f_feature AS feature, f_date AS date,
               f_day AS date_day, f_core AS core, f_db AS db, f_visitor AS active_visitor
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY f_host, f_domain, f_feature, f_date ORDER BY {order}) AS rn
              FROM ({_FACTS}))
        WHERE rn = 1
    """


_NEWEST = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC"

ORACLES = {
    "topic_favs": """
        SELECT lang AS topic_name, CAST(sum(n_chars) AS BIGINT) AS sum_favs
        FROM documents GROUP BY lang ORDER BY sum_favs DESC
    """,
    "place_topic_favs": """
        SELECT source AS place, lang AS topic_name, CAST(sum(n_chars) AS BIGINT) AS sum_favs
        FROM documents GROUP BY source, lang ORDER BY place, sum_favs DESC
    """,
    "domain_count": "SELECT l_linestatus AS domain, count(*) AS n FROM lineitem GROUP BY 1",
    "row_count": "SELECT count(*) AS n FROM lineitem",
    "olap_cube": f"""
        SELECT {_MEMBERS}, {_SUMS} FROM ({_FACTS})
        GROUP BY CUBE (f_host, f_domain, f_feature, f_day)
    """,
    "olap_rollup": f"""
        SELECT {_label("f_host", "host")}, {_label("f_domain", "domain")},
               'All Types' AS feature, 'All Types' AS date_day, {_SUMS}
        FROM ({_FACTS}) GROUP BY ROLLUP (f_host, f_domain)
    """,
    "olap_slice": f"""
        SELECT f_host AS host, 'All Types' AS domain, f_feature AS feature,
               'All Types' AS date_day, {_SUMS}
        FROM ({_FACTS}) GROUP BY f_host, f_feature
    """,
    "olap_member": f"""
        SELECT f_host AS host, 'All Types' AS domain, f_feature AS feature,
               'All Types' AS date_day, {_SUMS}
        FROM ({_FACTS}) WHERE f_feature = '1-URGENT' GROUP BY f_host, f_feature
    """,
    "etl_day_upsert": _last_version(_NEWEST),
    "key_upsert": _last_version("l_linenumber % 2, " + _NEWEST),
    "events_by_day": """
        SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2
    """,
    "key_range_split": """
        SELECT CAST(k >= 'AO' AS INTEGER) + CAST(k >= 'NF' AS INTEGER)
               + CAST(k >= 'NO' AS INTEGER) + CAST(k >= 'RF' AS INTEGER) AS bucket,
               count(*) AS n, min(k) AS first_key, max(k) AS last_key
        FROM (SELECT l_returnflag || l_linestatus AS k FROM lineitem) GROUP BY 1
    """,
}

ORACLES["olap_stored_slice"] = ORACLES["olap_slice"]
ORACLES["olap_stored_member"] = ORACLES["olap_member"]
