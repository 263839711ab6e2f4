from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup as op
from tests.llm.conftest import ODD


def brute(rows):
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        group = ids[text or ""]
        keep = max((i for i in group if i is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, keep, len(group), doc_id == keep, digest))
    return Counter(out)


def found(frame):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return Counter(tuple(r) for r in frame.select(*columns).collect())


@pytest.mark.parametrize("key_bits, bucket", [(64, 1 << 18), (3, 2), (1, 1)])
def test_equals_brute_force_also_where_keys_collide(make, key_bits, bucket):
    rows = [*ODD, *[(100 + i, f"text {i % 23}") for i in range(80)]]
    assert found(op.exact_duplicates(make(rows), bucket, key_bits)) == brute(rows)


def test_no_rows(empty):
    assert op.exact_duplicates(empty).collect() == []


def test_long_text_and_chains(odd):
    out = op.exact_duplicates(odd, key_bits=1).collect()
    assert len(out) == len(ODD) + 1
    assert len({(r["chain"], r["text_sha256"]) for r in out}) == len({r["text_sha256"] for r in out})


def test_directory_splits_only_overfull_buckets(spark):
    # 40 keys at the low end, one in each of two places of the other half.
    keys = spark.createDataFrame([(i,) for i in range(40)] + [(1 << 62,), (3 << 61,)], "key long")
    directory = op.directory_of(keys, bucket_entries=41, key_bits=63)
    assert directory.depths.tolist() == [1, 1] and directory.starts.tolist() == [0, 1 << 62]
    # Crowded keys are split as deep as it takes, and nothing else is.
    deep = op.directory_of(keys, bucket_entries=4, key_bits=63)
    sizes = np.bincount(deep.bucket_of(np.array([r[0] for r in keys.collect()])), minlength=len(deep.starts))
    assert sizes.max() <= 4 and deep.depths.max() == 61 and len(deep.starts) < 75
    # Keys that no bit tells apart end in one bucket.
    same = spark.createDataFrame([(5,), (5,), (5,), (4,)], "key long")
    assert op.directory_of(same, 2, 63).depths.max() == 63


def test_buckets_hold_what_they_may(make):
    index, directory = op.build_index(make([(i, f"t{i}") for i in range(400)]), 50)
    sizes = index.groupBy("bucket").agg(F.count("*").alias("n")).collect()
    assert len(sizes) > 8 and max(r["n"] for r in sizes) <= 50
    assert {r["bucket"] for r in sizes} <= set(range(len(directory.starts)))


def test_answers_come_from_the_buckets_of_the_directory(make, monkeypatch):
    rows = [(i, f"text {i % 200}") for i in range(400)]
    index, directory = op.build_index(make(rows), 50)
    monkeypatch.setattr(op, "build_index", lambda *_: (index, op.Directory(directory.starts + np.uint64(1 << 62), directory.depths)))
    assert op.exact_duplicates(make(rows), 50).count() < len(rows)
    monkeypatch.setattr(op, "build_index", lambda *_: (index, directory))
    assert found(op.exact_duplicates(make(rows), 50)) == brute(rows)


def test_owners_add_up_and_compare_bytes():
    columns = [[0, 0, 0, 0, 1], [7, 7, 7, 7, 9], ["a", "b", "a", "a", "c"], [1, 5, None, 3, None], [2, 1, 4, 1, 2]]
    batch = op.pa.RecordBatch.from_arrays(
        [op.pa.array(c, op.pa.string() if i == 2 else op.pa.int64()) for i, c in enumerate(columns)],
        ["bucket", "key", "text", "keep_id", "copies"],
    )
    parts = [batch.slice(i, 1) for i in range(5)]
    rows = [tuple(r.values()) for out in op._owned(parts) for r in out.to_pylist()]
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in "abc"}
    first, second = sorted("ab", key=digest.get)
    sums = {"a": (3, 7), "b": (5, 1)}
    assert rows == [
        (0, 7, 0, digest[first], *sums[first]), (0, 7, 1, digest[second], *sums[second]), (1, 9, 0, digest["c"], None, 2)
    ]


def test_tasks_hold_few_texts(make, monkeypatch):
    monkeypatch.setattr(op, "COMBINE_BYTES", 100)
    rows = [*ODD, *[(100 + i, f"text {i % 23}") for i in range(80)]]
    assert found(op.exact_duplicates(make(rows))) == brute(rows)
