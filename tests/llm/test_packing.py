from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tallyloom.llm import packing as op


def check(rows, lengths, capacities):
    largest, bins, docs = max(capacities), defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
        docs[r["doc_id"], r["piece"]].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r["bin_offset"])
        at = 0
        for r in held:
            assert r["bin_offset"] == at
            at += r["n_tokens"]
        assert {r["bin_tokens"] for r in held} == {at}
        assert {r["capacity"] for r in held} == {min(c for c in capacities if c >= at)}
    assert sorted(bins) == list(range(len(bins)))
    want = sorted(
        (str(doc_id), start, min(largest, n - start))
        for doc_id, n in lengths
        for start in range(0, n, largest)
    )
    assert sorted((str(r["doc_id"]), r["start"], r["n_tokens"]) for r in rows) == want
    return sum(bins[b][0]["capacity"] + op.BIN_COST for b in bins)


def best_fit_cost(lengths, capacities, opened):
    """Plain best-fit decreasing, one piece at a time."""
    largest, open_bins, left = max(capacities), [], defaultdict(int)
    pieces = sorted((min(largest, n - s) for _, n in lengths for s in range(0, n, largest)), reverse=True)
    for p in pieces:
        left[p] += 1
    for p in pieces:
        fits = [b for b in open_bins if b[0] >= p]
        if fits:
            best = min(fits, key=lambda b: b[0])
        else:
            cost = lambda c: ((c + op.BIN_COST) / (min(c // p, left[p]) * p), -c)  # noqa: B023, E731
            size = min((c for c in opened if c >= p), key=cost)
            best = [size, 0]
            open_bins.append(best)
        best[0] -= p
        best[1] += p
        left[p] -= 1
    return sum(min(c for c in capacities if c >= held) + op.BIN_COST for _, held in open_bins)


@pytest.mark.parametrize("cell_rows", [7, 100_000])
def test_every_token_has_one_place(spark, cell_rows):
    draw = random.Random(cell_rows)
    lengths = [(i, draw.choice([1, 3, 3, 3, 8, 13, 21, 40, 170])) for i in range(300)]
    lengths += [(7, 3), (7, 3), (None, 5), (None, 5)]
    frame = spark.createDataFrame(lengths, "doc_id long, n_tokens long")
    rows = op.packed(frame, (8, 16, 32), cell_rows=cell_rows).collect()
    check(rows, lengths, (8, 16, 32))


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_as_cheap_as_single_pieces(seed):
    draw = random.Random(seed)
    lengths = [(i, draw.randint(1, 64)) for i in range(200)]
    counts = defaultdict(int)
    for _, n in lengths:
        counts[n] += 1
    sizes = (16, 32, 64)
    plan = op.best_plan(dict(counts), sizes)
    costs = [best_fit_cost(lengths, sizes, o) for o in ((64,), (16, 64), (32, 64), (16, 32, 64))]
    assert plan.cost(sizes, op.BIN_COST) <= min(costs) * 1.02
    tokens = sum(n for _, n in lengths)
    assert sum(n * held for _, n, held in plan.bins) == tokens


def test_lengths_and_no_rows(spark, odd, empty, make):
    got = {r["doc_id"]: r["n_tokens"] for r in op.with_lengths(odd).collect() if r["doc_id"]}
    assert got == {1: 1, 2: 1, 3: 4, 4: 4, 5: 1, 6: 5, 7: 30_002}
    assert op.packed(op.with_lengths(empty)).collect() == []
    lengths = [(r["doc_id"], r["n_tokens"]) for r in op.with_lengths(odd).collect()]
    check(op.packed(op.with_lengths(odd)).collect(), lengths, op.CAPACITIES)


def test_rows_of_one_id_are_spread(spark):
    frame = spark.range(3000).selectExpr("CAST(NULL AS LONG) AS doc_id", "5L AS n_tokens")
    pieces = op.pieces_of(frame, 8).withColumn("row", op.F.monotonically_increasing_id())
    ranks = op.ranked(pieces, 100).collect()
    assert sorted(r["rank"] for r in ranks) == list(range(3000))
    lengths = [(None, 5)] * 3000
    check(op.packed(frame, (8, 16, 32), cell_rows=100).collect(), lengths, (8, 16, 32))
