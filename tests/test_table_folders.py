"""Streams of tables that are folders of files, as larger tables are."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.conftest import rows_of

TABLES = ["documents", "events"]


@pytest.fixture(scope="module")
def folders(spark, sf_dir, tmp_path_factory):
    """The tables of the smallest size, each a folder of three files."""
    base = str(tmp_path_factory.mktemp("tables"))
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(3).write.parquet(f"{base}/{name}.parquet")
    return base


def equal_on_folders(spark, sf_dir, folders, name):
    query = contract.queries()[name]
    want = rows_of(query(spark, sf_dir))
    return rows_of(query(spark, folders)) == want and len(want) > 0


def test_posts_of_a_folder(spark, sf_dir, folders):
    assert equal_on_folders(spark, sf_dir, folders, "place_posts_stream")


def test_rejects_of_a_folder(spark, sf_dir, folders):
    assert equal_on_folders(spark, sf_dir, folders, "place_rejects_stream")


def test_tracked_posts_of_a_folder(spark, sf_dir, folders):
    assert equal_on_folders(spark, sf_dir, folders, "tracked_stream")


@pytest.mark.parametrize("name", ["sliding_mentions_stream", "sliding_totals_stream", "idempotent_insert_stream"])
def test_events_of_a_folder(spark, sf_dir, folders, name):
    assert equal_on_folders(spark, sf_dir, folders, name)


@pytest.fixture(scope="module")
def partitioned(spark, sf_dir, tmp_path_factory):
    """The tables of the smallest size, each a folder with a folder per value of a column."""
    base = str(tmp_path_factory.mktemp("partitioned"))
    for name, column in zip(TABLES, ["lang", "event_type"], strict=True):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        rows.write.partitionBy(column).parquet(f"{base}/{name}.parquet")
    return base


@pytest.mark.parametrize("name", ["tracked_stream", "place_rejects_stream", "place_posts_stream"])
def test_posts_of_partitions(spark, sf_dir, partitioned, name):
    assert equal_on_folders(spark, sf_dir, partitioned, name)


@pytest.mark.parametrize("name", ["sliding_mentions_stream", "sliding_totals_stream", "idempotent_insert_stream"])
def test_events_of_partitions(spark, sf_dir, partitioned, name):
    assert equal_on_folders(spark, sf_dir, partitioned, name)
