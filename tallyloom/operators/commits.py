"""Tables whose batches become visible together."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.merge import BATCH, read_batches, write_batch
from tallyloom.sources.files import path_exists


@dataclass(frozen=True)
class BatchLog:
    """A log with one entry per batch; what several tables hold of a batch shows with its entry.

    A batch is written to all tables first and then entered. A run that ends in between
    leaves nothing to see: its batch is written anew by the next run. A batch that is
    entered is never written again, so a repeated one changes nothing. One run writes at
    a time, as a stream's checkpoint sees to.
    """

    path: str

    def _entry(self, batch_id: int) -> str:
        return f"{self.path}/{BATCH}={int(batch_id)}"

    def holds(self, spark: SparkSession, batch_id: int) -> bool:
        return path_exists(spark, f"{self._entry(batch_id)}/_SUCCESS")

    def commit(self, spark: SparkSession, batch_id: int, tables: Mapping[str, DataFrame]) -> None:
        """Write a batch's rows, given by table path, and enter it."""
        if self.holds(spark, batch_id):
            return
        for path, rows in tables.items():
            write_batch(rows, path, batch_id)
        entered = spark.range(1).select(F.current_timestamp().alias("entered"))
        entered.coalesce(1).write.mode("overwrite").parquet(self._entry(batch_id))

    def entries(self, spark: SparkSession) -> DataFrame:
        """``(batch_id, entered)`` of all entries."""
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], f"{BATCH} bigint, entered timestamp")
        rows = spark.read.schema(f"entered timestamp, {BATCH} bigint").parquet(self.path)
        return rows.select(BATCH, "entered")

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """Rows of a table that belong to entered batches.

        The batch is the table's partition, so Spark reads no files of other batches.
        """
        return read_batches(spark, path).join(self.entries(spark).select(BATCH), BATCH, "left_semi")
