from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from tallyloom.llm import decontaminate as op
from tests.llm.conftest import ODD


def brute_tiles(item, doc, seed):
    """Mark the longest common run of unmarked tokens until none is long enough."""
    used_item, used_doc, tiles = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                    and i + n not in used_item and j + n not in used_doc
                ):
                    n += 1
                if n >= seed and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            return sorted(tiles)
        n, i, j = -best[0], best[1], best[2]
        tiles.append((i, j, n))
        used_item.update(range(i, i + n))
        used_doc.update(range(j, j + n))


@pytest.mark.parametrize("size", [2, 4, 30])
def test_tiles_equal_brute_force(size):
    draw = random.Random(size)
    for _ in range(60):
        item = [draw.randrange(size) for _ in range(draw.randint(3, 14))]
        doc = [draw.randrange(size) for _ in range(10)] + item[6:] + item[:6] + [draw.randrange(size)]
        assert op.tiles_of(np.array(item), np.array(doc), 3) == brute_tiles(item, doc, 3)


@pytest.mark.parametrize("seed", range(6))
def test_tiles_of_repetitive_texts_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(40):
        period = [draw.randrange(3) for _ in range(draw.randint(1, 3))]
        item = period * draw.randint(2, 8) + [draw.randrange(4) for _ in range(draw.randint(0, 6))] + period * 3
        doc = (period * 6 + [draw.randrange(4)]) * draw.randint(1, 4) + item[::-1]
        assert op.tiles_of(np.array(item), np.array(doc), 3) == brute_tiles(item, doc, 3)


LONG = """
import resource, numpy
from tallyloom.llm import decontaminate as op
blocks = [op.Block.of([(1, "la " * 1000), (2, "la la lu " * 300 + "end of it all")])]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for text in ("la " * 1_000_000, "la la lu " * 300_000):
    for block in blocks:
        print([(n, c, len(t)) for n, c, t in block.matches(text, 0.6)])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_repetitive_long_texts_need_little_memory():
    root = Path(op.__file__).parents[2]
    out = subprocess.run([sys.executable, "-c", LONG], cwd=root, capture_output=True, text=True, timeout=120, check=True)
    first, second, grown = out.stdout.splitlines()
    assert first == "[(0, 1.0, 1)]" and second.startswith("[(1, 0.99")
    assert int(grown) < 1024


def test_items_shorter_than_a_seed_must_be_whole(spark, make):
    items = [(1, "is two plus two"), (2, "Paris"), (3, "?!"), (4, "two plus"), (None, "no id")]
    rows = [(10, "What is TWO plus two? Paris."), (11, "two plus"), (12, "plus two"), (13, "a no id b"), (14, None)]
    out = op.contaminated(make(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["coverage"], r["n_tiles"]) for r in out), key=str) == sorted(
        [(10, 1, 1.0, 1), (10, 2, 1.0, 1), (10, 4, 1.0, 1), (11, 4, 1.0, 1), (13, None, 1.0, 1)], key=str
    )
    tile = next(r["tiles"][0] for r in out if r["item_id"] == 1)
    assert (tile["item_start"], tile["doc_start"], tile["length"]) == (0, 1, 4)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog. Then it sleeps under a very old tree today!"),
    (2, "one two three four five six seven eight nine ten"),
    (3, "too short"),
    (4, None),
    (5, ""),
    (2, "one two three four five six seven eight nine ten"),
]
DOCS = [
    (10, "xx THEN it sleeps under a very old tree; today! yy the quick brown fox jumps over the lazy dog zz"),
    (11, "one two three four five"),
    (12, "lead " + ITEMS[1][1].upper() + " tail " + ITEMS[0][1]),
    (13, "nothing in common here at all with any of them"),
    (14, "word " * 20_000 + ITEMS[1][1] + " word" * 20_000),
    (14, "a"),
]


def brute(rows, items, least):
    out = set()
    for doc_id, text in rows:
        doc = op.tokens_of(text)
        for item_id, words in set(items):
            item = op.tokens_of(words)
            if len(item) < 5:
                if item and any(doc[j : j + len(item)] == item for j in range(len(doc))):
                    out.add((doc_id, item_id, 1.0))
                continue
            if len(doc) > 1000:
                continue
            covered = sum(n for _, _, n in brute_tiles(item, doc, 5)) / len(item)
            if covered >= least:
                out.add((doc_id, item_id, round(covered, 9)))
    return out


@pytest.mark.parametrize("block_chars", [16_000_000, 60])
def test_equals_brute_force(spark, make, block_chars):
    rows = [*ODD, *DOCS]
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = op.contaminated(make(rows), benchmark, 0.5, block_chars=block_chars).collect()
    got = {(r["doc_id"], r["item_id"], round(r["coverage"], 9)) for r in out}
    assert got == brute(rows, ITEMS, 0.5) | {(14, 2, 1.0)}
    assert (10, 1, 1.0) in got  # reordered
    kept = op.without_contaminated(make(rows), benchmark, 0.5, block_chars=block_chars)
    assert kept.columns == make([]).columns
    bad = {(10,), (11,), (12,)}
    want = [r for r in rows if (r[0],) not in bad and not (r[1] or "").startswith("word ")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_no_rows(spark, make, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert op.contaminated(empty, benchmark).collect() == []
    assert op.contaminated(make(DOCS), none).collect() == []
    assert op.without_contaminated(make(DOCS), none).count() == len(DOCS)
