from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.pivot import axis_labels, cell_pivot
from tallyloom.sources import cells
from tests.conftest import rows_of

# Six golden cells.
PUTS = [
    ("john", "info", "age", 1, "42"),
    ("mary", "info", "age", 2, "26"),
    ("john", "visits", "amazon.com", 3, "5"),
    ("john", "visits", "google.es", 4, "2"),
    ("mary", "visits", "amazon.com", 5, "4"),
    ("mary", "visits", "facebook.com", 6, "2"),
]

# Fixed value: an answer of the row store's REST interface.
REST = (
    '{"Row":[{"key":"am9obg==","Cell":[{"column":"dmlzaXRzOmFtYXpvbi5jb20=",'
    '"timestamp":1393791171026,"$":"NQ=="},{"column":"dmlzaXRzOmdvb2dsZS5lcw==",'
    '"timestamp":1393791171063,"$":"Mg=="}]}]}'
)


@pytest.fixture(scope="module")
def table(spark):
    return cells.put_cells(spark, PUTS)


def test_scan_and_range(spark, table, tmp_path):
    path = str(tmp_path / "cells")
    cells.write_cells(table, path)
    stored = cells.scan(spark, path)
    assert rows_of(stored) == sorted(PUTS)
    some = cells.key_range(stored, "ma", "n")
    assert {r["row_key"] for r in some.collect()} == {"mary"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,ma)" in plan and "LessThan(row_key,n)" in plan
    assert cells.key_range(stored).count() == 6


def test_get(table):
    row = cells.row_map(cells.get_rows(table, "john")).first()["row"]
    assert row == {"info:age": "42", "visits:amazon.com": "5", "visits:google.es": "2"}
    assert rows_of(cells.get_rows(table, "john", "visits")) == sorted(
        p for p in PUTS if p[0] == "john" and p[1] == "visits"
    )
    assert cells.get_rows(table, "nobody").count() == 0


@pytest.mark.parametrize(
    "keys, family, count",
    [("*", "", 6), ("*", "visits", 4), ("jo*", "", 3), ("john/mary", "info", 2), ("john/j*/john", "", 3)],
)
def test_patterns(table, keys, family, count):
    assert cells.get_rows(table, keys, family).count() == count


def test_pattern_is_pushed_down(spark, table, tmp_path):
    path = str(tmp_path / "cells")
    cells.write_cells(table, path)
    plan = cells.get_rows(cells.scan(spark, path), "john/ma*")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "StringStartsWith(row_key,ma)" in text and "row_key,john" in text


def test_latest_version(spark, table):
    newer = table.unionByName(cells.put_cells(spark, [("john", "info", "age", 9, "43")]))
    got = cells.get_rows(newer, ["john"], "info")
    assert rows_of(got) == [("john", "info", "age", 9, "43")]


def test_decode_rest(spark):
    frame = spark.createDataFrame([(REST,)], "body string")
    assert rows_of(cells.decode_rest(frame)) == [
        ("john", "visits", "amazon.com", 1393791171026, "5"),
        ("john", "visits", "google.es", 1393791171063, "2"),
    ]


def test_nested_rows(table):
    john = cells.nested_rows(table).where(F.col("key") == "john").first()["row"]
    assert [tuple(c) for c in john] == [
        ("info", "age", "42", 1),
        ("visits", "amazon.com", "5", 3),
        ("visits", "google.es", "2", 4),
    ]


@pytest.mark.parametrize("labels", [None, ["amazon.com", "facebook.com", "google.es"]])
def test_pivot(table, labels):
    visits = table.where("family = 'visits'")
    assert [r[0] for r in axis_labels(visits).collect()] == ["amazon.com", "facebook.com", "google.es"]
    chart = cell_pivot(visits, labels)
    assert chart.columns == ["row_key", "amazon.com", "facebook.com", "google.es"]
    assert sorted((tuple(r) for r in chart.collect()), key=lambda r: r[0]) == [
        ("john", 5.0, None, 2.0),
        ("mary", 4.0, 2.0, None),
    ]


def test_text_that_is_no_number(spark):
    frame = cells.put_cells(spark, [("k", "f", "q", 1, "abc")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cell_pivot(frame, ["q"]).collect()
    assert cell_pivot(frame, ["q"], lenient=True).first()["q"] is None


def test_pivot_of_one_family(spark):
    frame = cells.put_cells(spark, [("k", "a", "x", 1, "1"), ("k", "b", "x", 1, "2")])
    assert [cell_pivot(frame, ["x"], family=f).first()["x"] for f in "ab"] == [1.0, 2.0]
    assert cell_pivot(frame, ["x"]).first()["x"] == 2.0


def test_delete_stored_rows(spark, table, tmp_path):
    cells.write_cells(table, str(tmp_path / "old"))
    keys = spark.createDataFrame([("john",)], "row_key string")
    new = cells.delete_stored(spark, str(tmp_path / "old"), keys, str(tmp_path / "new"))
    assert rows_of(new) == sorted(p for p in PUTS if p[0] == "mary")
    assert rows_of(cells.row_columns(table, ["info:age", "visits:x.com"])) == [
        ("john", "42", None), ("mary", "26", None)
    ]


def test_delete_rows(spark, table):
    keys = spark.createDataFrame([("john",)], "row_key string")
    assert {r["row_key"] for r in cells.delete_rows(table, keys).collect()} == {"mary"}


@pytest.mark.parametrize("limit", [2, 100])
def test_wide_rows_are_chunked(spark, limit):
    wide = cells.put_cells(spark, [("w", "f", f"q{i}", i, str(i)) for i in range(30)] + PUTS[:1])
    maps = cells.row_map(wide, limit).collect()
    assert sorted(k for r in maps if r["row_key"] == "w" for k in r["row"]) == sorted(
        f"f:q{i}" for i in range(30)
    )
    assert (sum(r["row_key"] == "w" for r in maps) > 1) == (limit == 2)
    assert [r["chunk"] for r in maps if r["row_key"] == "john"] == [0]
    nested = cells.nested_rows(wide, limit).where("key = 'w'").orderBy("chunk").collect()
    quals = [c["qual"] for r in nested for c in r["row"]]
    assert quals == sorted(f"q{i}" for i in range(30))


def test_counter_cells(spark):
    counts = spark.createDataFrame([("Chopin", "es", 7)], "word string, lang string, n bigint")
    row = cells.counter_cells(counts, "word", "lang", "n").first()
    assert (row["row_key"], row["family"], row["qualifier"], row["value"]) == ("Chopin", "mentions", "es", "7")
