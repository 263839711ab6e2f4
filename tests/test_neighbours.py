from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.text import char_set, shared_chars
from tallyloom.operators import neighbours
from tallyloom.operators.neighbours import similar_neighbours
from tallyloom.operators.topk import top_k_per_group, top_k_wide_rows
from tests.conftest import rows_of

PEOPLE = "name string, age int"
OTHERS = "id int, name string, age int"


def brute(people, others, k):
    out = []
    for name, age in people:
        scored = sorted(
            (-len(set(name or "") & set(n or "")), i) for i, n, a in others if a == age
        )
        out += [(name or "", age, i, -s, r) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, people, others, k, **options):
    frame = similar_neighbours(
        spark.createDataFrame(people, PEOPLE),
        spark.createDataFrame(others, OTHERS),
        "age",
        "name",
        "id",
        k,
        **options,
    )
    return rows_of(frame.select(F.coalesce("name", F.lit("")), "age", "id", "score", "rank"))


def test_golden(spark):
    people = [("aba", 20), ("ca", 30)]
    others = [(1, "aaa", 20), (2, "b2", 20), (3, "c", 20), (4, "c", 30), (5, "d", 30)]
    assert found(spark, people, others, 2) == [
        ("aba", 20, 1, 1, 1),
        ("aba", 20, 2, 1, 2),
        ("ca", 30, 4, 1, 1),
        ("ca", 30, 5, 0, 2),
    ]


@pytest.mark.parametrize("block_rows, k", [(2, 1), (3, 4), (2048, 3)])
def test_blocks_give_the_same_as_all_pairs(spark, block_rows, k):
    draw = random.Random(block_rows)
    name = lambda: "".join(draw.choices("abcdéñ😀xyz", k=draw.randint(0, 6)))
    # Two thirds of the rows share one age.
    age = lambda: draw.choice([1, 1, 2])
    people = list({(name(), age()) for _ in range(60)}) + [(None, 1), ("ab", 1)]
    others = [(i, name(), age()) for i in range(50)]
    assert found(spark, people, others, k, block_rows=block_rows) == brute(people, others, k)


def test_hot_key_blocks_are_not_built_by_one_task(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        people = spark.createDataFrame([("a", 1)], PEOPLE)
        others = spark.createDataFrame([(1, "a", 1)], OTHERS)
        frame = similar_neighbours(people, others, "age", "name", "id")
        plan = frame._jdf.queryExecution().executedPlan().toString()
        lines = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
        assert sum("age#" in line and "_part" in line for line in lines) >= 2
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_blocks_that_cannot_beat_the_kth_score_do_not_meet(spark, monkeypatch):
    draw = random.Random(8)
    name = lambda: "".join(draw.sample("abcdefghijkl", draw.choice([2, 3, 3, 4, 4, 5, 11, 12])))
    people, others = list({(name(), 1) for _ in range(150)}), [(i, name(), 1) for i in range(200)]
    counts, pairs = [], neighbours._open_pairs

    def counted(left, right, seeds, on):
        found = pairs(left, right, seeds, on)
        counts.append((found.count(), left.count() * right.count()))
        return found

    monkeypatch.setattr(neighbours, "_open_pairs", counted)
    assert found(spark, people, others, 2, block_rows=4) == brute(people, others, 2)
    (met, every), = counts
    assert 0 < met < 0.7 * every


@pytest.mark.parametrize("age", [99, None])
def test_missing_neighbours_are_an_error(spark, age):
    with pytest.raises(Exception, match="no neighbours for age 99|person without age"):
        found(spark, [("a", 1), ("b", age)], [(1, "a", 1)], 2)


def test_character_functions(spark):
    row = spark.range(1).select(char_set(F.lit("hello")), shared_chars(F.lit("aba"), F.lit("b2b"))).first()
    assert tuple(row) == (["e", "h", "l", "o"], 1)


@pytest.mark.parametrize("limit", ["2", "1000"])
def test_top_k_beyond_the_window_limit(spark, limit):
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        frame = spark.range(0, 500, 1, 6).selectExpr("id % 2 AS g", "(id * 37) % 500 AS v")
        top = top_k_per_group(frame, ["g"], [F.desc("v")], 5)
        want = [(g, v, r) for g in (0, 1) for r, v in enumerate(range(498 + g, 488, -2), 1) if r <= 5]
        assert rows_of(top) == sorted(want)
    finally:
        spark.conf.set(name, before)


def test_top_k_of_wide_rows_sorts_no_texts(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(300).selectExpr("id", "id % 3 AS g", "(id * 7) % 100 AS v", "repeat('x', 50) AS text").write.parquet(path)
    rows = spark.read.parquet(path)
    order = [F.desc("v"), F.col("id")]
    wide = top_k_wide_rows(rows, ["g"], order, 4, ["id"])
    assert wide.columns == ["id", "g", "v", "text", "rank"]
    assert rows_of(wide) == rows_of(top_k_per_group(rows, ["g"], order, 4))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort " not in plan
