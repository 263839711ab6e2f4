"""Top lists that each batch of rows brings up to date."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.topk import top_k_per_group, top_k_wide_rows
from tallyloom.sources.files import delete_path, list_names, path_exists

VERSION = "version="


@dataclass(frozen=True)
class TopLists:
    """The ``k`` rows of each group with most of ``most``, kept over all batches written so far.

    ``tie_break`` names the columns that order rows of the same number and has to tell all
    rows of a group apart. A batch's own top rows compete with the lists, so a batch reads
    its rows and at most ``k`` rows per group, never the rows of earlier batches. Each batch
    writes a new version of the lists; writing it again starts from the version before, so
    a repeated batch changes nothing. ``keep`` versions stay for readers that still use them.

    With ``key``, columns that tell the rows of a batch apart, long columns such as texts
    are only read for the chosen rows of the batch. Nulls of ``most`` come last.
    """

    path: str
    group: str
    most: str
    tie_break: Sequence[str]
    k: int
    key: Sequence[str] = ()
    keep: int = 3

    def _versions(self, spark: SparkSession) -> list[int]:
        numbers = [int(n.removeprefix(VERSION)) for n in list_names(spark, self.path) if n.startswith(VERSION)]
        return sorted(n for n in numbers if path_exists(spark, f"{self._folder(n)}/_SUCCESS"))

    def _folder(self, number: int) -> str:
        return f"{self.path}/{VERSION}{number}"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Bring the lists up to date with one batch, numbered upwards."""
        spark = rows.sparkSession
        order = [F.desc(self.most), *[F.col(name) for name in self.tie_break]]
        if self.key:
            best = top_k_wide_rows(rows, [self.group], order, self.k, self.key)
        else:
            best = top_k_per_group(rows, [self.group], order, self.k)
        earlier = [n for n in self._versions(spark) if n < batch_id]
        if earlier:
            held = spark.read.parquet(self._folder(earlier[-1])).select(*rows.columns)
            rivals = held.unionByName(best.drop("rank"))
            best = top_k_per_group(rivals, [self.group], order, self.k)
        best.write.mode("overwrite").parquet(self._folder(int(batch_id)))
        for number in earlier[: -self.keep + 1 or None]:
            delete_path(spark, self._folder(number))

    def read(self, spark: SparkSession) -> DataFrame:
        """The lists of the latest batch, with the place in the list as ``rank``."""
        versions = self._versions(spark)
        if not versions:
            raise ValueError(f"no batch has been written to {self.path}")
        return spark.read.parquet(self._folder(versions[-1]))
