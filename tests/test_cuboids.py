from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.cube import CubeSpec, olap_slice
from tallyloom.operators.cuboids import CuboidStore, choose_cuboids

SPEC = CubeSpec(["host", "kind", "day"], ["n", "paid"])


def sizes_of(**sizes):
    return {frozenset(name): n for name, n in sizes.items()} | {frozenset(): 1}


def test_the_cuboid_that_saves_most_comes_next():
    sizes = sizes_of(abc=100, ab=90, ac=20, bc=95, a=10, b=5, c=15)
    # ac saves 80 for each of ac, a, c and the total; ab 10 for four; then b saves 95.
    assert choose_cuboids(sizes, 0) == [frozenset("abc")]
    assert choose_cuboids(sizes, 2) == [frozenset("abc"), frozenset("ac"), frozenset("b")]


def test_nothing_is_kept_that_saves_nothing():
    sizes = sizes_of(ab=10, a=10, b=10) | {frozenset(): 10}
    assert choose_cuboids(sizes, 3) == [frozenset("ab")]


@pytest.fixture
def facts(spark):
    pick = random.Random(8)
    rows = [
        (pick.choice(["a", "b", None]), pick.choice(["x", "y"]), i % 40, pick.choice([None, i]), f"{i}.25")
        for i in range(600)
    ]
    frame = spark.createDataFrame(rows, "host string, kind string, day int, n int, paid string")
    return frame.withColumn("paid", F.col("paid").cast("decimal(8,2)"))


def test_every_slice_is_that_of_the_facts_and_reads_a_cuboid(spark, facts, tmp_path):
    facts.write.parquet(str(tmp_path / "facts"))
    written = spark.read.parquet(str(tmp_path / "facts"))
    store = CuboidStore(str(tmp_path / "store"), SPEC)
    chosen = store.build(written, extra=2)
    assert len(chosen) == 3
    asked = [(list(axes), {}) for n in range(4) for axes in combinations(SPEC.dimensions, n)]
    for axes, where in [*asked, (["host"], {"kind": "x"}), ([], {"day": 3}), (["host"], {"kind": "none"})]:
        got, want = store.slice(spark, axes, where), olap_slice(written, SPEC, axes, where)
        assert got.schema == want.schema
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
        files = got.inputFiles()
        assert files and all("/store/c-" in name for name in files)
        # The smallest cuboid that holds the dimensions is the one that is read.
        fitting = [c for c in chosen if {*axes, *where} <= c]
        rows = {c: spark.read.parquet(store._folder(c)).count() for c in fitting}
        folder = files[0].rsplit("/", 2)[1]
        assert rows[next(c for c in fitting if store._folder(c).endswith(f"/{folder}"))] == min(rows.values())


def test_no_facts_and_unknown_dimensions(spark, facts, tmp_path):
    store = CuboidStore(str(tmp_path / "store"), SPEC)
    store.build(facts.where("false"))
    assert store.slice(spark, ["host"]).count() == 0
    with pytest.raises(ValueError):
        store.slice(spark, ["planet"])
