"""Merge sinks: counting upsert, snapshot replace, primary-key upsert, key ranges.

Batches of a stream are written so that writing one again changes nothing: each
batch owns one partition of the stored table and replaces just that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import stored
from tallyloom.sources.files import delete_path, list_names, path_exists, touch

BATCH = "batch_id"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Store rows as the batch's own partition; a repeated batch replaces it.

    The partition is cleared first, so a repeated batch that has no rows any more leaves
    none.
    """
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={int(batch_id)}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.withColumn(BATCH, F.col(BATCH).cast("bigint"))


def split_valid(rows: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored and rows to reject; an undecided test rejects."""
    good = F.coalesce(valid, F.lit(False))
    return rows.where(good), rows.where(~good)


def join_or_reject(rows: DataFrame, lookup: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Rows joined to what a lookup holds for them, and the rows it holds nothing for."""
    keys = lookup.select(on).distinct()
    return rows.join(lookup, on), rows.join(keys, on, "left_anti")


RUN = "run"
COMPACTED = "000000-compacted"


@dataclass(frozen=True)
class CountingUpsert:
    """Table of first sightings: the first row of a key stays, ``hits`` counts all.

    ``order`` names the columns that order the rows of one batch. A batch is reduced to
    one row per key and added to the table; readers fold the batches. So a batch costs
    what it holds, not what the table holds.

    Batches are kept per run. A run is what has one checkpoint: a repeated batch of a run
    replaces itself, while a new checkpoint, which counts its batches from 0 again, is a
    new run and adds to what is there. Runs are ordered by their first batch.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    hits: str = "hits"

    def reduce_batch(self, rows: DataFrame) -> DataFrame:
        """One row per key of one batch: its first row and the number of rows."""
        first = F.min_by(F.struct(*self._kept(rows)), F.struct(*self.order))
        return (
            rows.groupBy(*self.keys)
            .agg(first.alias("_first"), F.count(F.lit(1)).alias(self.hits))
            .select(*self.keys, "_first.*", self.hits)
        )

    def write(self, rows: DataFrame, batch_id: int, run: str | None = None) -> None:
        """Add a batch; ``run`` is the query's own id unless given."""
        spark = rows.sparkSession
        name = self._run_folder(spark, run or query_id(spark))
        write_batch(self.reduce_batch(rows), f"{self._folder(spark)}/{RUN}={name}", batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """Current rows: keys, first-seen columns, hits."""
        return self._fold(read_batches(spark, self._folder(spark))).drop(RUN, BATCH)

    def compact(self, spark: SparkSession) -> None:
        """Fold all batches but the newest into one, in a new generation of the table.

        The newest batch of the newest run is copied as it is, as the stream may still
        repeat it. Writers and readers follow the table to its new generation, as it
        becomes current with one small file. Run it between two batches, for example in
        the sink itself.
        """
        batches = read_batches(spark, self._folder(spark))
        last = batches.agg(F.max(F.struct(RUN, BATCH)).alias("last")).select("last.*").first()
        newest = (F.col(RUN) == last[RUN]) & (F.col(BATCH) == last[BATCH])
        older = self._fold(batches.where(~newest)).withColumns(
            {RUN: F.lit(COMPACTED), BATCH: F.lit(0).cast("bigint")}
        )
        number = self._generation(spark) + 1
        rows = older.unionByName(batches.where(newest))
        # A generation that was left half-written by an earlier try is replaced.
        rows.repartition(BATCH, *self.keys).write.mode("overwrite").partitionBy(RUN, BATCH).parquet(
            f"{self.path}/data-{number:06d}"
        )
        touch(spark, f"{self.path}/current/{number:06d}")

    def _generation(self, spark: SparkSession) -> int:
        names = list_names(spark, f"{self.path}/current")
        return int(names[-1]) if names else 0

    def _folder(self, spark: SparkSession) -> str:
        return f"{self.path}/data-{self._generation(spark):06d}"

    def _run_folder(self, spark: SparkSession, run: str) -> str:
        """The run's folder name: its place among the runs and its id."""
        names = [n.removeprefix(f"{RUN}=") for n in list_names(spark, self._folder(spark))]
        known = [name for name in names if name.partition("-")[2] == run]
        places = [int(name.partition("-")[0]) for name in names if name.partition("-")[0].isdigit()]
        return known[0] if known else f"{max(places, default=0) + 1:06d}-{run}"

    def _kept(self, rows: DataFrame) -> list[str]:
        return [c for c in rows.columns if c not in (*self.keys, self.hits, RUN, BATCH)]

    def _fold(self, batches: DataFrame) -> DataFrame:
        first = F.min_by(F.struct(*self._kept(batches), RUN, BATCH), F.struct(RUN, BATCH, *self.order))
        return (
            batches.groupBy(*self.keys)
            .agg(first.alias("_first"), F.sum(self.hits).alias(self.hits))
            .select(*self.keys, "_first.*", self.hits)
        )


def query_id(spark: SparkSession) -> str:
    """Id of the stream whose batch is being handled, the same for one checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def replace_snapshot(rows: DataFrame, path: str, version: int) -> bool:
    """Make ``rows`` the table's content; no rows leave the old content.

    Each attempt writes a folder of its own and becomes visible with one small marker file
    that names it, so readers never see an empty or half-written table, and an attempt
    that is repeated, has no rows or begins to count its versions anew spoils nothing.
    Returns whether the content changed.
    """
    spark = rows.sparkSession
    attempt = f"version={int(version)}-{uuid.uuid4().hex}"
    folder = f"{path}/data/{attempt}"
    rows.write.parquet(folder)
    if spark.read.schema(rows.schema).parquet(folder).isEmpty():
        delete_path(spark, folder)
        return False
    number = len(_markers(spark, path)) and int(_markers(spark, path)[-1].partition(".")[0]) + 1
    touch(spark, f"{path}/committed/{number:020d}.{attempt}")
    return True


def _markers(spark: SparkSession, path: str) -> list[str]:
    return list_names(spark, f"{path}/committed")


def snapshot_version(spark: SparkSession, path: str) -> int | None:
    """Version of the snapshot committed last."""
    names = _markers(spark, path)
    return int(names[-1].partition("=")[2].partition("-")[0]) if names else None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    names = _markers(spark, path)
    if not names:
        raise FileNotFoundError(f"no snapshot in {path}")
    return spark.read.parquet(f"{path}/data/{names[-1].partition('.')[2]}")


def drop_old_snapshots(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete superseded snapshots once no reader uses them any more."""
    names = _markers(spark, path)
    for name in names[: max(len(names) - keep, 0)]:
        delete_path(spark, f"{path}/committed/{name}")
        delete_path(spark, f"{path}/data/{name.partition('.')[2]}")


def last_by_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key, the one with the largest version."""
    others = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(*version))
    return rows.groupBy(*keys).agg(newest.alias("_last")).select(*keys, "_last.*").select(*rows.columns)


def upsert_by_key(
    current: DataFrame | None, incoming: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Content after ``incoming`` is put into ``current``; the last write of a key wins.

    Only the incoming rows are reduced by key; stored rows pass through an anti
    join.
    """
    fresh = last_by_key(incoming, keys, version)
    if current is None:
        return fresh
    return current.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def key_range_bucket(key: Column, split_points: Sequence[str]) -> Column:
    """Number of split points that are at most the key: 0 .. len(split_points)."""
    passed = [(key >= F.lit(point)).cast("int") for point in split_points]
    return reduce(lambda a, b: a + b, passed, F.lit(0))


def write_key_ranges(
    rows: DataFrame, path: str, key: Column, split_points: Sequence[str], order: Sequence[str]
) -> None:
    """Store rows by key range: one folder per bucket, sorted files in each.

    ``order`` should end in columns that tell rows of one key apart; the range
    shuffle then cuts a bucket that holds much of the table into several tasks.
    """
    bucketed = rows.withColumn("bucket", key_range_bucket(key, split_points))
    (
        bucketed.repartitionByRange("bucket", *order)
        .sortWithinPartitions("bucket", *order)
        .write.mode("overwrite")
        .partitionBy("bucket")
        .parquet(path)
    )


def create_table(spark: SparkSession, name: str, ddl: str) -> None:
    """Create a parquet table unless it exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def reset_table(spark: SparkSession, name: str, ddl: str) -> None:
    drop_table(spark, name)
    create_table(spark, name, ddl)


def insert_new_offsets(
    records: DataFrame,
    path: str,
    topic: str = "topic",
    partition: str = "partition",
    offset: str = "offset",
    range_size: int = 1_000_000,
) -> None:
    """Append the records whose (topic, partition, offset) is not stored yet.

    The store has a folder per topic, partition and range of offsets. To find what is
    there, only the folders between the first and last range of each partition of the
    batch are read. A repeated batch adds nothing.
    """
    spark = records.sparkSession
    key = [topic, partition, offset]
    places = {
        "in_topic": F.col(topic).cast("string"),
        "in_partition": F.col(partition).cast("string"),
        "offset_range": F.expr(f"`{offset}` div {int(range_size)}"),
    }
    fresh = stored(records.dropDuplicates(key).withColumns(places), "offsets-batch")
    if path_exists(spark, path):
        fresh = fresh.join(touched_ranges(fresh, path).select(*key), key, "left_anti")
    fresh.write.mode("append").partitionBy(*places).parquet(path)


def touched_ranges(batch: DataFrame, path: str) -> DataFrame:
    """What the store holds of the ranges that a batch touches, read from their folders."""
    # One row per partition of the log.
    spans = batch.groupBy("in_topic", "in_partition").agg(
        F.min("offset_range").alias("low"), F.max("offset_range").alias("high")
    )
    touched = F.lit(False)
    for span in spans.collect():
        touched = touched | (
            F.col("in_topic").eqNullSafe(span["in_topic"])
            & F.col("in_partition").eqNullSafe(span["in_partition"])
            & F.col("offset_range").between(span["low"], span["high"])
        )
    return batch.sparkSession.read.schema(batch.schema).parquet(path).where(touched)


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("in_topic", "in_partition", "offset_range")
