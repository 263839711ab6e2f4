from __future__ import annotations

import random

import pytest

from tallyloom.operators import rank
from tallyloom.operators.rank import bead_sort
from tests.conftest import rows_of


def places(values: list[int]) -> list[tuple[int, int]]:
    """Place and value of each value of at least 1 in ascending order."""
    return [(place, x) for place, x in enumerate(sorted(values)) if x >= 1]


def ints(spark, values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


# The known lists.
@pytest.mark.parametrize(
    "values",
    [[2, 4, 1, 3, 3], [1, 2, 1, 4, 10, 5], [1, 2, 3], [3, 2, 1], [4, 1, 3], [0, 2, -1], [], [-5]],
)
def test_known_lists(spark, values):
    assert rows_of(bead_sort(ints(spark, values), "x")) == places(values)
    assert rows_of(bead_sort(ints(spark, values, "int"), "x")) == places(values)


def test_golden(spark):
    out = rows_of(bead_sort(ints(spark, [2, 4, 1, 3, 3]), "x"))
    assert out == [(0, 1), (1, 2), (2, 3), (3, 3), (4, 4)]
    assert rows_of(bead_sort(ints(spark, [0, 2, -1]), "x")) == [(2, 2)]


@pytest.mark.parametrize("bits", [2, 5, 16])
def test_all_levels_of_the_digit_tree(spark, monkeypatch, bits):
    monkeypatch.setattr(rank, "DIGIT_BITS", bits)
    draw = random.Random(bits)
    values = [draw.choice([draw.randint(-3, 40), draw.randint(0, 2**15 - 1)]) for _ in range(300)]
    want = [(pos, x) for pos, x in enumerate(sorted(values)) if x >= 1]
    assert rows_of(bead_sort(ints(spark, values, "smallint"), "x")) == want


def test_large_values_and_nulls(spark):
    values = [2**62, 2**33, 2**33 + 1, 5, None, 2**62]
    want = [(0, 5), (1, 2**33), (2, 2**33 + 1), (3, 2**62), (4, 2**62)]
    assert rows_of(bead_sort(ints(spark, values), "x")) == want


def test_long_runs_are_cut(spark, monkeypatch):
    monkeypatch.setattr(rank, "RUN_ROWS", 64)
    monkeypatch.setattr(rank, "STEP_ROWS", 8)
    values = [7] * 1000 + [3] * 65 + [9]
    want = list(enumerate(sorted(values)))
    assert rows_of(bead_sort(ints(spark, values), "x")) == want


def test_max_value(spark):
    frame = ints(spark, [5, 3])
    assert rows_of(bead_sort(frame, "x", max_value=5)) == [(0, 3), (1, 5)]
    with pytest.raises(Exception, match="above max_value"):
        bead_sort(frame, "x", max_value=4).collect()
    with pytest.raises(ValueError):
        bead_sort(spark.createDataFrame([("a",)], "x string"), "x")
