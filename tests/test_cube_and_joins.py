from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import binned
from tallyloom.operators.binned import bin_sizes, binned_join, triangular_pairs
from tallyloom.operators.cube import CubeSpec, olap_cube, olap_rollup, olap_slice, with_day
from tests.conftest import rows_of

SPEC = CubeSpec(["host", "feature", "day"], ["core"])


@pytest.fixture(scope="module")
def facts(spark):
    moment = lambda d: datetime.datetime(2014, 1, d, 13, 5)
    rows = [("EU", "a", moment(1), 1), ("EU", "b", moment(1), 2), ("NA", "a", moment(2), 4), (None, "a", moment(2), 8)]
    frame = spark.createDataFrame(rows, "host string, feature string, date timestamp_ntz, core bigint")
    return with_day(frame, "date", "day")


def cells(frame):
    return {tuple(r)[:3]: r["core"] for r in frame.collect()}


def test_cube_has_all_members(facts):
    cube = cells(olap_cube(facts, SPEC))
    everything = ("All Types",) * 3
    assert cube[everything] == 15
    assert cube[("EU", "All Types", "All Types")] == 3
    assert cube[(None, "All Types", "All Types")] == 8
    assert cube[("All Types", "a", "2014-01-02")] == 12
    assert len(cube) == len(olap_cube(facts, SPEC).collect())


def test_slices_are_cells_of_the_cube(facts):
    cube = cells(olap_cube(facts, SPEC))
    for axes, where in [((), {}), (("host",), {}), (("host", "day"), {}), (("day",), {"feature": "a"})]:
        found = cells(olap_slice(facts, SPEC, axes, where))
        assert found and all(cube[key] == n for key, n in found.items())
    with pytest.raises(ValueError):
        olap_slice(facts, SPEC, ["colour"])


def test_rollup(facts):
    roll = cells(olap_rollup(facts, SPEC, ["host", "feature"]))
    cube = cells(olap_cube(facts, SPEC))
    assert all(cube[key] == n for key, n in roll.items())
    assert ("All Types", "a", "All Types") not in roll and ("EU", "a", "All Types") in roll


def test_cube_copies_totals_not_facts(facts):
    plan = olap_cube(facts, SPEC)._jdf.queryExecution().executedPlan().toString()
    expand = plan.index("Expand")
    assert "HashAggregate" in plan[expand:]


@pytest.mark.parametrize("bins", [1, 3, 50])
def test_binned_join_is_the_plain_join(spark, bins):
    left = spark.range(200).selectExpr("id % 37 AS k", "id AS a").union(spark.sql("SELECT NULL, 1L"))
    right = spark.range(60).selectExpr("id % 41 AS k", "concat('n', id) AS name")
    joined = binned_join(left, right, "k", bins)
    assert rows_of(joined) == rows_of(left.join(right, "k"))
    assert joined.columns == ["k", "a", "name"]
    sizes = bin_sizes(right, "k", bins).agg(F.sum("n_rows"), F.count("bin")).first()
    assert sizes[0] == 60 and sizes[1] <= bins


def broadcast_bytes(frame):
    """Sizes of the hash tables that the join of ``frame`` broadcast."""
    frame.collect()
    found, nodes = [], [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif name == "BroadcastExchangeExec":
            found.append(node.metrics().apply("dataSize").value())
        else:
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_bins_are_broadcast_one_by_one_below_the_bound(spark, monkeypatch):
    left = spark.range(3000).selectExpr("id % 700 AS k", "id AS a")
    right = spark.range(8000).selectExpr("IF(id < 5000, 5, id % 700) AS k", "repeat('n', 10) AS name")
    joins, plain = [], binned.bin_join

    def kept(*args):
        joins.append((args[3], plain(*args)))
        return joins[-1][1]

    monkeypatch.setattr(binned, "bin_join", kept)
    bound = 60_000
    joined = binned_join(left, right, "k", 7, bound)
    assert joined.count() == left.join(right, "k").count()
    # The bin of the key with 5,000 rows is too large and is sorted; the others fit.
    assert len(joins) == 7 and sum(size > bound for size, _ in joins) == 1
    for size, frame in joins:
        assert "CartesianProduct" not in frame._jdf.queryExecution().executedPlan().toString()
        if size > bound:
            assert broadcast_bytes(frame) == []
    used = sorted(b for size, frame in joins if size <= bound for b in broadcast_bytes(frame))
    # Spark rounds a hash table up to whole pages.
    assert len(used) == 6 and binned_join(left.limit(0), right.limit(0), "k", 7).count() == 0
    assert used[-1] <= 20 * bound


def test_dependent_generator(spark):
    pairs = triangular_pairs(spark.range(4).selectExpr("CAST(id AS INT) AS n"), "n")
    assert rows_of(pairs.select("i", "j")) == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3)]
    large = triangular_pairs(spark.createDataFrame([(2500,), (None,)], "n int"), "n")
    assert sorted(r["j"] for r in large.collect()) == list(range(1, 2501))
