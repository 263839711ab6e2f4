from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from tallyloom.functions.text import blank_tokens, space_tokens
from tallyloom.operators import mapreduce as mr
from tallyloom.operators.stages import python_stage
from tests.conftest import rows_of

# Three texts and the counts of their words.
DOCS = [(None, "hola que tal hola"), (None, "ey hola"), (None, "como estamos")]
COUNTS = {"hola": 3, "que": 1, "tal": 1, "ey": 1, "como": 1, "estamos": 1}


LONGEST = {"h": "hola", "q": "que", "t": "tal", "e": "estamos", "c": "como"}


def initials(_title, text):
    yield from ((token[0], token) for token in text.split())


def longest(letter, tokens):
    yield letter, max(tokens, key=lambda token: (len(token), token))


def total(key, numbers):
    yield key, sum(numbers)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "title string, text string")


@pytest.mark.parametrize("mappers", [None, 1, 3, 7])
@pytest.mark.parametrize("combine", [None, longest])
def test_result_depends_on_neither_parts_nor_combiner(docs, mappers, combine):
    found = mr.map_reduce(
        docs, initials, longest, combine, mapped_schema="letter string, word string", num_mappers=mappers
    )
    assert dict(rows_of(found)) == LONGEST


def test_token_counts(docs, spark):
    assert dict(rows_of(mr.token_counts(docs, space_tokens("text")))) == COUNTS
    gaps = spark.createDataFrame([("a  b",)], "text string")
    assert dict(rows_of(mr.token_counts(gaps, space_tokens("text")))) == {"a": 1, "": 1, "b": 1}
    blanks = spark.createDataFrame([(" a b\t\na ",)], "text string")
    assert dict(rows_of(mr.token_counts(blanks, blank_tokens("text")))) == {"a": 2, "b": 1}


def test_identity_keeps_the_pairs(spark):
    pairs = [(1, "a"), (1, "a"), (2, None), (None, "b")]
    frame = spark.createDataFrame(pairs, "k int, v string")
    for functions in ({}, {"map_f": mr.identity_map, "reduce_f": mr.identity_reduce}):
        out = mr.map_reduce(frame, num_mappers=2, **functions)
        assert Counter(tuple(r) for r in out.collect()) == Counter(pairs)


def test_null_and_array_keys_form_groups(spark):
    rows = [(None, 1), (None, 2), (["a"], 3), (["a"], 4), (["a", "b"], 5)]
    frame = spark.createDataFrame(rows, "k array<string>, v bigint")
    out = mr.map_reduce(frame, None, total, total)
    assert Counter((tuple(r[0] or ()), r[1]) for r in out.collect()) == Counter(
        [((), 3), (("a",), 7), (("a", "b"), 5)]
    )


def test_reduce_may_change_keys_and_skip_values(spark):
    frame = spark.range(100).selectExpr("id % 3 AS k", "id AS v")

    def first_only(key, values):
        yield f"key{key}", next(iter(values)) % 3

    out = mr.map_reduce(frame, reduce_f=first_only, result_schema="name string, rest bigint")
    assert rows_of(out) == [("key0", 0), ("key1", 1), ("key2", 2)]


def test_groups_span_arrow_batches(spark):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        frame = spark.range(200).selectExpr("id % 2 AS k", "id AS v")
        assert rows_of(mr.map_reduce(frame, reduce_f=total)) == [(0, 9900), (1, 10000)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


@pytest.mark.parametrize("limit", [1, 2, 5, 1000])
def test_combiner_buffer(monkeypatch, limit):
    monkeypatch.setattr(mr, "BUFFERED_VALUES", limit)
    pairs = [(i % 4, i) for i in range(50)]
    sums = defaultdict(int)
    for key, value in mr._combined(iter(pairs), total):
        sums[key] += value
    assert sums == {k: sum(v for key, v in pairs if key == k) for k in range(4)}


def test_combiner_keeps_a_small_buffer_of_hot_keys(monkeypatch):
    monkeypatch.setattr(mr, "BUFFERED_VALUES", 10)
    assert list(mr._combined(((7, 1) for _ in range(1000)), total)) == [(7, 1000)]


@pytest.mark.parametrize("max_values", [2, 3, 100])
def test_grouped_lists_have_one_order_for_every_bound(spark, max_values):
    pairs = [("hot", i % 5) for i in range(40)] + [("hot", None), ("cold", 9), (None, 4)]
    frame = spark.createDataFrame(pairs, "k string, v bigint")
    rows = mr.grouped_lists(frame, max_values).orderBy("key", "chunk").collect()
    hot = [r for r in rows if r["key"] == "hot"]
    assert [v for r in hot for v in r["values"]] == [None] + sorted(i % 5 for i in range(40))
    assert [r["chunk"] for r in hot] == list(range(-(-41 // max_values)))
    assert {len(r["values"]) for r in hot[:-1]} <= {max_values}


def test_nan_keys_are_one_group(spark):
    nan = float("nan")
    frame = spark.createDataFrame([(nan, 1), (nan, 2), (0.0, 3), (-0.0, 4)], "k double, v bigint")
    for combine in (None, total):
        out = mr.map_reduce(frame, reduce_f=total, combine_f=combine)
        assert sorted(r["v"] for r in out.collect()) == [3, 7]
    inner = frame.selectExpr("array(k) AS k", "v")
    assert sorted(r["v"] for r in mr.map_reduce(inner, reduce_f=total).collect()) == [3, 7]


def test_regrouped_keeps_the_pairs(spark):
    pairs = [("a", i) for i in range(50)] + [(None, 1), (None, 1)]
    frame = spark.createDataFrame(pairs, "k string, v bigint")
    assert Counter(tuple(r) for r in mr.regrouped(frame, 10).collect()) == Counter(pairs)


@pytest.mark.parametrize("max_values", [3, 100])
def test_grouped_lists_hold_everything(spark, max_values):
    pairs = [("hot", i % 5) for i in range(40)] + [("same", 1)] * 20 + [("cold", 9), (None, 4)]
    frame = spark.createDataFrame(pairs, "k string, v bigint")
    out = mr.grouped_lists(frame, max_values).collect()
    assert Counter((r["key"], v) for r in out for v in r["values"]) == Counter(pairs)
    chunks = Counter(r["key"] for r in out)
    assert chunks["cold"] == chunks[None] == 1
    assert (chunks["hot"] > 1 and chunks["same"] > 1) == (max_values == 3)
    assert len({(r["key"], r["chunk"]) for r in out}) == len(out)


def test_key_sorted_lists(docs):
    counted = mr.token_counts(docs, space_tokens("text"))
    rows = [(r["key"], list(r["values"])) for r in mr.key_sorted_lists(counted).collect()]
    assert rows == sorted((word, [n]) for word, n in COUNTS.items())


def test_python_stage_sets_up_once_per_task(spark):
    def initialize():
        seen = []

        def process(row):
            seen.append(row["id"])
            for copy in range(row["id"] % 3):
                yield row["id"], copy, len(seen)

        return process

    frame = spark.range(0, 30, 1, 3)
    out = python_stage(frame, initialize, "id bigint, copy int, nth int").collect()
    assert sorted((r["id"], r["copy"]) for r in out) == [(i, c) for i in range(30) for c in range(i % 3)]
    assert max(r["nth"] for r in out) == 10


def test_pair_stats(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int").coalesce(1)
    assert rows_of(mr.pair_stats(frame, "mapped")) == [("mapped", 0, 2, 3)]


def test_two_columns_are_required(spark):
    with pytest.raises(ValueError):
        mr.map_reduce(spark.range(1))
    with pytest.raises(ValueError):
        mr.random_parts(spark.range(1), 0)
