"""File readers and the few file-system calls that snapshots need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES_TYPE = "map<string, struct<lat: double, long: double>>"


def avro_files(spark: SparkSession, path: str) -> DataFrame:
    """Avro files; needs Spark's own ``spark-avro`` module on the class path."""
    return spark.read.format("avro").load(path)


def csv_table(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = False) -> DataFrame:
    """Bulk load of a CSV file with a declared schema; a bad line is an error."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A relational table; give a partition column, or one task reads all of it."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("partition_column needs bounds and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", num_partitions)
        )
    return reader.options(**options).load()


def rows_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A collection of the driver as a table."""
    return spark.createDataFrame(list(rows), schema)


def places_rows(configs: DataFrame, column: str = "config") -> DataFrame:
    """Rows ``(place, lat, long)`` from JSON texts ``{name: {lat, long}, ...}``."""
    parsed = F.from_json(F.col(column), PLACES_TYPE)
    exploded = configs.select(F.explode(parsed).alias("place", "at"))
    return exploded.select("place", F.col("at.lat").alias("lat"), F.col("at.long").alias("long"))


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    located = jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), located


def path_uri(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme, as libraries other than Spark need it."""
    fs, located = _located(spark, path)
    uri = fs.makeQualified(located).toString()
    return uri if "://" in uri else uri.replace(":/", ":///", 1)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, located = _located(spark, path)
    return fs.exists(located)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, located = _located(spark, path)
    return fs.exists(located) and fs.getFileStatus(located).isDirectory()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, located = _located(spark, path)
    if not fs.exists(located):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(located))


def touch(spark: SparkSession, path: str) -> None:
    fs, located = _located(spark, path)
    fs.create(located, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, located = _located(spark, path)
    fs.delete(located, True)
