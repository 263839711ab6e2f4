"""First k rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import scratch_dir


def top_k_per_group(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
) -> DataFrame:
    """The k first rows per group in ``order``, numbered from 1 in column ``rank``.

    ``order`` has to end in a tie-break for a stable result. Up to Spark's
    window group limit each task keeps only k rows per group before the shuffle,
    so a hot group sends k rows per task. Above the limit the same cut is made
    per slice of a group in a first, evenly spread window.
    """
    limit = int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    source = rows
    if k > limit:
        per_slice = Window.partitionBy(*group, "_slice").orderBy(*order)
        source = (
            rows.withColumn("_slice", F.spark_partition_id())
            .withColumn("_in_slice", F.row_number().over(per_slice))
            .where(F.col("_in_slice") <= k)
            .drop("_slice", "_in_slice")
        )
    ranked = source.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)


def top_k_wide_rows(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    key: Sequence[str],
    rank: str = "rank",
) -> DataFrame:
    """The same for rows that carry long columns, such as whole texts.

    ``key`` tells all rows apart. The choice is made on the key, group and order
    columns alone and stored in the shared folder; the long columns of the chosen
    rows are fetched by a second scan. Spark knows the size of the stored choice
    and broadcasts it below its own threshold, so the long columns are neither
    sorted nor shuffled; above the threshold it is a shuffle join.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "top-k")
    top_k_per_group(rows, group, order, k, rank).select(*key, rank).write.parquet(path)
    return rows.join(spark.read.parquet(path), list(key)).select(*rows.columns, rank)
