from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import merge
from tallyloom.operators.merge import CountingUpsert
from tests.conftest import rows_of

SHAPE = "author string, at int, seq int, text string"
BATCHES = [
    [("ann", 1, 2, "second"), ("ann", 1, 1, "first"), ("bob", 1, 3, "b")],
    [("ann", 1, 0, "later"), ("cid", 5, 9, None)],
    [("cid", 5, 1, "c"), ("ann", 1, 7, "last")],
]
WANT = [("ann", 1, 1, "first", 4), ("bob", 1, 3, "b", 1), ("cid", 5, 9, None, 2)]


@pytest.fixture
def store(tmp_path):
    return CountingUpsert(str(tmp_path / "table"), ["author", "at"], ["seq"])


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def test_first_row_stays_and_hits_count(spark, store):
    for number, rows in enumerate(BATCHES):
        store.write(frame(spark, rows), number)
    assert rows_of(store.read(spark)) == WANT


def test_a_repeated_batch_changes_nothing(spark, store):
    for number in (0, 1, 1, 0, 2, 2):
        store.write(frame(spark, BATCHES[number]), number)
    assert rows_of(store.read(spark)) == WANT


def test_empty_batch(spark, store):
    store.write(frame(spark, BATCHES[0]), 0)
    before = rows_of(store.read(spark))
    store.write(frame(spark, []), 1)
    assert rows_of(store.read(spark)) == before


def test_a_repeated_batch_that_lost_its_rows_leaves_none(spark, store):
    store.write(frame(spark, BATCHES[0]), 0)
    store.write(frame(spark, BATCHES[1]), 1)
    store.write(frame(spark, []), 1)
    assert rows_of(store.read(spark)) == [("ann", 1, 1, "first", 2), ("bob", 1, 3, "b", 1)]


def test_a_new_checkpoint_adds_to_what_is_there(spark, store):
    store.write(frame(spark, BATCHES[0]), 0, "one")
    store.write(frame(spark, BATCHES[1]), 0, "two")
    store.write(frame(spark, BATCHES[1]), 0, "two")
    store.write(frame(spark, BATCHES[2]), 1, "two")
    assert rows_of(store.read(spark)) == WANT


def test_compaction_keeps_the_table_and_the_newest_batch(spark, store):
    for number, rows in enumerate(BATCHES):
        store.write(frame(spark, rows), number)
    store.compact(spark)
    assert rows_of(store.read(spark)) == WANT
    # The same store, as a running sink holds it, goes on in the new generation.
    store.write(frame(spark, BATCHES[2]), 2)
    assert rows_of(store.read(spark)) == WANT
    store.write(frame(spark, [("bob", 1, 0, "again")]), 3)
    store.compact(spark)
    want = [row if row[0] != "bob" else ("bob", 1, 3, "b", 2) for row in WANT]
    assert rows_of(store.read(spark)) == want


def test_split_valid(spark):
    rows = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    good, bad = merge.split_valid(rows, F.col("x") < 3)
    assert rows_of(good) == [(1,)] and {r[0] for r in bad.collect()} == {5, None}


def test_join_or_reject(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "place string")
    lookup = spark.createDataFrame([("a", 1), ("a", 2)], "place string, topic int")
    found, rejected = merge.join_or_reject(rows, lookup, "place")
    assert rows_of(found) == [("a", 1), ("a", 2)]
    assert {r[0] for r in rejected.collect()} == {"b", None}


def test_snapshot(spark, tmp_path):
    path = str(tmp_path / "snap")
    ids = lambda *values: spark.createDataFrame([(v,) for v in values], "x int")
    with pytest.raises(FileNotFoundError):
        merge.read_snapshot(spark, path)
    assert merge.replace_snapshot(ids(1, 2), path, 0)
    assert merge.replace_snapshot(ids(3), path, 1)
    assert not merge.replace_snapshot(ids(), path, 2)
    assert rows_of(merge.read_snapshot(spark, path)) == [(3,)]
    assert merge.replace_snapshot(ids(4), path, 10) and merge.snapshot_version(spark, path) == 10
    # An attempt that was written but never committed is not seen.
    ids(9).write.parquet(f"{path}/data/version=11-lost")
    assert rows_of(merge.read_snapshot(spark, path)) == [(4,)]
    # A repeated version without rows loses nothing; one with rows replaces it.
    assert not merge.replace_snapshot(ids(), path, 10)
    assert rows_of(merge.read_snapshot(spark, path)) == [(4,)]
    assert merge.replace_snapshot(ids(5), path, 10)
    # A new checkpoint begins at version 0 again.
    assert merge.replace_snapshot(ids(6), path, 0)
    assert rows_of(merge.read_snapshot(spark, path)) == [(6,)]
    merge.drop_old_snapshots(spark, path, keep=1)
    assert len(os.listdir(f"{path}/committed")) >= 1
    assert not [name for name in os.listdir(f"{path}/data") if name.startswith("version=1-")]
    assert rows_of(merge.read_snapshot(spark, path)) == [(6,)]


def test_primary_key_upsert(spark):
    shape = "k string, version int, v string"
    stored = spark.createDataFrame([("a", 9, "old"), ("b", 1, "keep")], shape)
    incoming = spark.createDataFrame([("a", 1, "new"), ("c", 1, "x"), ("c", 2, "y")], shape)
    out = merge.upsert_by_key(stored, incoming, ["k"], ["version"])
    assert rows_of(out) == [("a", 1, "new"), ("b", 1, "keep"), ("c", 2, "y")]
    assert rows_of(merge.upsert_by_key(None, incoming, ["k"], ["version"])) == [
        ("a", 1, "new"),
        ("c", 2, "y"),
    ]


SPLITS = [
    "CSGoogle", "CSSalesforce", "EUApple", "EUGoogle",
    "EUSalesforce", "NAApple", "NAGoogle", "NASalesforce",
]


def test_key_ranges(spark, tmp_path):
    keys = ["AA", "CSGoogle", "CSH", "EUApple", "EUZ", "NAApple", "NASalesforce", "ZZ"]
    rows = spark.createDataFrame([(k, i) for k in keys for i in range(20)], "k string, i int")
    bucket = merge.key_range_bucket(F.col("k"), SPLITS)
    want = {k: sum(s <= k for s in SPLITS) for k in keys}
    assert dict(rows_of(rows.select("k", bucket).distinct())) == want
    path = str(tmp_path / "ranges")
    merge.write_key_ranges(rows, path, F.col("k"), SPLITS, ["k", "i"])
    stored = spark.read.parquet(path)
    assert rows_of(stored.select("k", "i")) == rows_of(rows)
    one = stored.where("bucket = 8")
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()
    assert {r["k"] for r in one.collect()} == {"NASalesforce", "ZZ"}


def test_tables(spark):
    merge.create_table(spark, "facts_demo", "k STRING, n INT")
    spark.sql("INSERT INTO facts_demo VALUES ('a', 1)")
    merge.create_table(spark, "facts_demo", "k STRING, n INT")
    assert spark.table("facts_demo").count() == 1
    merge.reset_table(spark, "facts_demo", "k STRING, n INT")
    assert spark.table("facts_demo").count() == 0
    merge.drop_table(spark, "facts_demo")
    assert not spark.catalog.tableExists("facts_demo")


def log(spark, offsets, partition=0):
    rows = [("k", f"v{o}", "t", partition, o) for o in offsets]
    return spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint")


def test_idempotent_insert(spark, tmp_path):
    path = str(tmp_path / "log")
    for offsets in ([0, 1, 2], [2, 3], [3, 3, 25], [], [0, 25, 26]):
        merge.insert_new_offsets(log(spark, offsets), path, range_size=10)
    merge.insert_new_offsets(log(spark, [2], partition=1), path, range_size=10)
    got = merge.read_offsets(spark, path)
    assert rows_of(got.select("partition", "offset")) == [
        (0, 0), (0, 1), (0, 2), (0, 3), (0, 25), (0, 26), (1, 2)
    ]


def test_only_touched_ranges_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    both = log(spark, range(100)).unionByName(log(spark, range(100), partition=1))
    merge.insert_new_offsets(both, path, range_size=10)
    batch = log(spark, [5]).unionByName(log(spark, [95, 100], partition=1))
    placed = batch.selectExpr(
        "*", "topic AS in_topic", "CAST(partition AS STRING) AS in_partition", "offset div 10 AS offset_range"
    )
    known = merge.touched_ranges(placed, path)
    # Range 0 of the one and 9 of the other partition, though they lie far apart.
    assert rows_of(known.select("partition", "offset")) == [
        *[(0, o) for o in range(10)], *[(1, o) for o in range(90, 100)]
    ]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PushedFilters: []" in plan
    merge.insert_new_offsets(batch, path, range_size=10)
    assert merge.read_offsets(spark, path).count() == 201
