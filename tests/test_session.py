"""Tables that are stored once per state of their input."""

from __future__ import annotations

import pytest

from tallyloom import session as s
from tallyloom.plans import all_queries
from tests.compare import connect, mismatch
from tallyloom.plans import all_oracles


def test_a_failed_write_is_not_remembered(spark, sf_dir):
    def fails(path):
        raise RuntimeError("no space")

    source = f"{sf_dir}/region.parquet"
    with pytest.raises(RuntimeError):
        s.stored_table(spark, "tried", source, fails)
    write = lambda path: spark.range(3).write.parquet(path)
    path = s.stored_table(spark, "tried", source, write)
    assert spark.read.parquet(path).count() == 3
    assert s.stored_table(spark, "tried", source, fails) == path


def test_a_changed_input_is_stored_anew(spark, tmp_path):
    source = str(tmp_path / "in")
    write = lambda path: spark.read.parquet(source).write.parquet(path)
    for n in (2, 5):
        spark.range(n).write.mode("overwrite").parquet(source)
        assert spark.read.parquet(s.stored_table(spark, "copied", source, write)).count() == n


@pytest.mark.parametrize("name", ["cells_scan", "geohash_prefix", "geohash_box"])
def test_queries_work_after_scratch_is_cleared(spark, sf_dir, name):
    query, sql = all_queries()[name], all_oracles()[name]
    assert mismatch(query(spark, sf_dir), connect(sf_dir), sql) is None
    s.clear_scratch(spark)
    assert mismatch(query(spark, sf_dir), connect(sf_dir), sql) is None
