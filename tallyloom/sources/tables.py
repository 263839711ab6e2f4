"""The given tables, and views of them shaped like the inputs of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Coordinates of an embedding.
VECTOR_SIZE = 64

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# The configured places with their coordinates.
PLACES = {
    "Madrid": {"lat": 40.4000, "long": -3.6833},
    "Barcelona": {"lat": 41.3833, "long": 2.1833},
    "Donostia": {"lat": 43.3214, "long": -1.9856},
    "Valencia": {"lat": 39.4667, "long": -0.3833},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    """Money as whole cents, so that sums do not depend on their order."""
    return F.round(F.col(amount) * 100).cast("bigint")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_posts(table(spark, sf_dir, "documents"))


def as_posts(doc: DataFrame) -> DataFrame:
    """Documents as nested posts; ``doc_id`` is kept as the arrival number."""
    # A hashtag is any word of the whole text that begins with a capital letter.
    words = F.filter(F.split("text", " "), lambda word: word.rlike("^[A-Z]"))
    return doc.select(
        "doc_id",
        "text",
        F.col("n_chars").alias("favorite_count"),
        (F.col("doc_id") % 2 == 0).alias("retweeted"),
        F.lit(None).cast("string").alias("in_reply_to_screen_name"),
        F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") % 7).alias("retweet_count"),
        F.lit(None).cast("boolean").alias("possibly_sensitive"),
        "lang",
        (
            F.lit("2014-03-02 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(days=(F.col("doc_id") % 28).cast("int"))
        ).alias("created_at"),
        "source",
        F.struct(F.concat(F.lit("author"), F.col("doc_id")).alias("screen_name")).alias("author"),
        F.struct(F.transform(words, lambda w: F.struct(w.alias("text"))).alias("hashtags")).alias(
            "entities"
        ),
        F.when(F.col("doc_id") % 3 != 0, F.struct(F.col("source").alias("full_name"))).alias("place"),
    )


def customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers melted into cells; the segment has an old and a new version."""
    rows = [
        ("info", "nationkey", 1, F.col("c_nationkey").cast("string")),
        ("info", "segment", 1, F.lower("c_mktsegment")),
        ("info", "segment", 2, F.col("c_mktsegment")),
        ("acct", "balance", 1, F.col("c_acctbal").cast("decimal(12,2)").cast("string")),
    ]
    cells = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"),
                F.lit(qualifier).alias("qualifier"),
                F.lit(ts).cast("bigint").alias("ts"),
                value.alias("value"),
            )
            for family, qualifier, ts, value in rows
        ]
    )
    customer = table(spark, sf_dir, "customer")
    return customer.select(F.col("c_name").alias("row_key"), F.inline(cells))


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as versions of cells: row = user, qualifier = type, ``event_id`` breaks ties."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("row_key"),
        F.lit("value").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
        "event_id",
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log records over four partitions, in batches of 1,000 events."""
    event_id = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod(event_id, F.lit(4)).cast("int").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
        F.expr("event_id div 1000").alias("batch"),
        "event_id",
    )


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of the documents."""
    return table(spark, sf_dir, "documents").select(*columns)


def usage_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as usage facts with host, domain, feature, date and three measures."""
    line = table(spark, sf_dir, "lineitem").drop("l_discount", "l_tax")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_returnflag").alias("host"),
        F.col("l_linestatus").alias("domain"),
        F.col("o_orderpriority").alias("feature"),
        F.col("l_shipdate").alias("date"),
        F.col("l_quantity").cast("bigint").alias("core"),
        cents("l_extendedprice").alias("db"),
        F.col("l_linenumber").alias("active_visitor"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with coordinates derived from their key."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        (F.lit(36.0) + (key % 80) / 10.0).alias("lat"),
        (F.lit(-9.0) + (key % 120) / 10.0).alias("long"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All coordinates of the embeddings as doubles, ``x0`` and so on."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(VECTOR_SIZE)],
    )
