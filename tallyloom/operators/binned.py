"""Join against a collection that is split into hash bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.session import scratch_dir

# Bytes of a bin, by ``row_bytes``, that may be broadcast.
BIN_BYTES = 64_000_000


def hash_bin(key: str, num_bins: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(num_bins)).cast("int")


def row_bytes(rows: DataFrame) -> Column:
    """Upper estimate of a row's size: text lengths plus a fixed part per column."""
    texts = [
        F.coalesce(F.octet_length(field.name), F.lit(0))
        for field in rows.schema.fields
        if field.dataType.simpleString() in ("string", "binary")
    ]
    other = [f for f in rows.schema.fields if f.dataType.simpleString() not in ("string", "binary")]
    nested = [
        F.coalesce(F.length(F.to_json(F.struct(f.name))), F.lit(0))
        for f in other
        if f.dataType.simpleString().startswith(("array", "struct", "map"))
    ]
    return reduce(lambda a, b: a + b, [*texts, *nested], F.lit(16 * len(rows.columns)).cast("bigint"))


def bin_sizes(rows: DataFrame, key: str, num_bins: int, number: Column | None = None) -> DataFrame:
    """Rows ``(bin, n_rows, n_bytes)`` of a collection split by key hash, or by ``number``."""
    bins = hash_bin(key, num_bins) if number is None else number
    return rows.groupBy(bins.alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row_bytes(rows)).alias("n_bytes")
    )


def binned_join(
    rows: DataFrame, collection: DataFrame, key: str, num_bins: int = 1, bin_bytes: int = BIN_BYTES
) -> DataFrame:
    """Inner join on ``key`` by way of ``num_bins`` hash bins; equal to the ordinary join.

    Both sides are dealt once to folders of their bins. One bin after another is joined,
    by a broadcast hash table of that bin of the collection alone, which is let go before
    the next one. The bins' sizes are measured first: a bin of more than ``bin_bytes``, as a
    key of very many rows makes it, is joined by sorting instead. More bins mean smaller
    tables. A single bin is joined in place.
    """
    if num_bins < 1:
        raise ValueError("num_bins must be at least 1")
    spark = rows.sparkSession
    # One row per bin.
    sizes = {r["bin"]: r["n_bytes"] for r in bin_sizes(collection, key, num_bins).collect()}
    if num_bins == 1:
        return bin_join(rows, collection, key, sizes.get(0, 0), bin_bytes)
    sides = []
    for side in (rows, collection):
        folder = scratch_dir(spark, "bins")
        side.withColumn("_bin", hash_bin(key, num_bins)).write.partitionBy("_bin").parquet(folder)
        sides.append((folder, side.schema))
    joined = rows.join(collection, key)
    folder = scratch_dir(spark, "binned-join")
    # An empty part, so that the folder has files if no bin has rows.
    joined.where(F.lit(False)).write.parquet(f"{folder}/none")
    for number, size in sorted(sizes.items()):
        parts = [
            spark.read.schema(schema.add("_bin", "integer")).parquet(path).where(F.col("_bin") == number).drop("_bin")
            for path, schema in ((path, StructType(list(schema.fields))) for path, schema in sides)
        ]
        bin_join(*parts, key, size, bin_bytes).write.parquet(f"{folder}/{number}")
    return spark.read.schema(joined.schema).option("recursiveFileLookup", "true").parquet(folder)


def bin_join(rows: DataFrame, collection: DataFrame, key: str, size: int, bin_bytes: int) -> DataFrame:
    """Join of one bin, by a broadcast of its measured ``size`` or, beyond the bound, by sorting."""
    return rows.join(F.broadcast(collection) if size <= bin_bytes else collection.hint("merge"), key)


RUN = 1_000


def triangular_pairs(rows: DataFrame, n: str, first: str = "i", second: str = "j") -> DataFrame:
    """Dependent generator: for each row, ``j`` from 1 to ``i``; no join.

    Numbers are written out in runs of at most ``RUN``, so no row ever holds all of them.
    """
    kind = rows.schema[n].dataType
    runs = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(CAST(`{n}` AS BIGINT) - 1) DIV {RUN}"))
    last = F.least(F.col(n).cast("bigint"), (F.col("_run") + 1) * RUN)
    return (
        rows.where(F.col(n) >= 1)
        .withColumn("_run", F.explode(runs))
        .withColumn("_j", F.explode(F.sequence(F.col("_run") * RUN + 1, last)))
        .select(*rows.columns, F.col(n).alias(first), F.col("_j").cast(kind).alias(second))
    )
