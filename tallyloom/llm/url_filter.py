"""URL rules as a sort-merge range join over reversed hosts.

A host's canonical key is its labels in reverse, each ended by a dot, so that a rule for
a host and all its subdomains is the interval of keys that begin with the rule's key.
Distinct hosts and rules are sorted together, over range partitions. The sweep keeps the
stack of the rules opened last: any rule that covers a host begins its key, so it is the
last rule at or before the host or one that encloses that rule. Sweeping distinct hosts
keeps a host with very many pages to one row. All work is done with SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

# Host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
RULE_SCHEMA = "host string, path string, verdict string"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def canonical(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): per rule host, its rules and those of the hosts that enclose it."""
    opened = rules.select(
        canonical(F.col("host")).alias("key"),
        F.struct(
            canonical(F.col("host")).alias("key"),
            F.col("path"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict"),
        ).alias("one"),
    )
    labels = F.split(F.col("key"), r"\.")
    enclosing = opened.select("key").distinct().withColumn(
        "outer",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels) - 1),
                lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")),
            )
        ),
    )
    outer = opened.withColumnRenamed("key", "outer")
    return enclosing.join(outer, "outer").groupBy("key").agg(F.collect_set("one").alias("stack"))


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, active): the rules whose interval holds the host, by one sorted sweep.

    Each range partition starts with the stack that the partitions before it leave open;
    one row per partition is looked at for that.
    """
    stacks = rule_stacks(rules)
    # A rule comes before the hosts of its own key.
    points = (
        hosts.select("host", canonical(F.col("host")).alias("key"), F.lit(1).alias("turn"))
        .withColumn("stack", F.lit(None).cast(stacks.schema["stack"].dataType))
        .unionByName(
            stacks.select(F.lit(None).cast("string").alias("host"), "key", F.lit(0).alias("turn"), "stack")
        )
    )
    spread = points.repartitionByRange("key", "turn").withColumn("part", F.spark_partition_id())
    ordered = stored(spread, "url-sweep")
    last_open = ordered.filter("turn = 0").groupBy("part").agg(
        F.max_by("stack", "key").alias("left_open")
    )
    parts = ordered.select("part").distinct().join(last_open, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        "part", F.last("left_open", ignorenulls=True).over(before).alias("carried")
    )
    sweep = Window.partitionBy("part").orderBy("key", "turn").rowsBetween(
        Window.unboundedPreceding, 0
    )
    swept = ordered.withColumn("open", F.last("stack", ignorenulls=True).over(sweep))
    stack = F.coalesce("open", "carried")
    covering = F.filter(stack, lambda one: F.startswith(F.col("key"), one["key"]))
    return (
        swept.join(carried, "part", "left")
        .filter("turn = 1")
        .select("host", covering.alias("active"))
        .filter(F.size("active") > 0)
    )


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict.

    The longest rule whose host covers the url's host and whose path begins the url's
    path decides; among equally long ones the greatest text. Without a rule the verdict
    is ``default`` and the rule null. A null url, or one without ``://``, has an empty
    host and path. Repeated rows and null ids are judged row by row; extra columns are
    ignored; no rules or no pages give no matches or no rows.
    """
    rows = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    active = active_rules(rows.select("host").distinct(), rules)
    fitting = F.filter("active", lambda one: F.startswith(F.col("path"), one["path"]))
    longest = F.array_max(
        F.transform(fitting, lambda one: F.struct(F.length(one["rule"]), one["rule"], one["verdict"]))
    )
    best = F.col("best")
    return (
        rows.join(active, "host", "left")
        .withColumn("best", longest)
        .select(
            "page_id",
            "host",
            "path",
            best["rule"].alias("rule"),
            F.coalesce(best["verdict"], F.lit(default)).alias("verdict"),
        )
    )
