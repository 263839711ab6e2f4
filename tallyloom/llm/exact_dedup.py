"""Exact duplicates through an extendible-hash index kept on shared files.

Every text has a 64-bit key. The directory starts as one bucket and doubles as long as a
bucket holds more keys than it may; only overfull buckets are split, by one more leading bit
of the key, so that a bucket is a range of keys. Tasks add up the copies of a text that they
read and send one row per text to the bucket's owner. The owner goes through its range key
by key, tells texts of one key apart by their bytes, chains them, adds up their copies and
writes the entries to the index. Documents look their entry up by bucket, key and digest.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import scratch_dir, stored

BUCKET_ENTRIES = 1 << 18
# Buckets hold more beyond so many of them, so that the directory, which all tasks get, has
# a bound: some 10 ** 6 ranges.
MAX_BUCKETS = 1 << 15
KEY_BITS = 64
# A histogram looks this many bits beyond the depth that an even spread needs, or beyond
# the last histogram for what is overfull there.
MORE_BITS = 4
# Texts that a task holds to add up their copies.
COMBINE_BYTES = 64_000_000
ENTRIES = "bucket long, key long, chain int, text_sha256 string, keep_id long, group_size long"


def keyed(documents: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """(doc_id, text, key); a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.shiftrightunsigned(F.xxhash64("text"), 64 - key_bits)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumn("key", key)


@dataclass(frozen=True)
class Directory:
    """Buckets as ranges of keys: the first key of each, ascending, and its local depth."""

    starts: np.ndarray
    depths: np.ndarray

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        """The bucket's number for keys given as signed longs."""
        return np.searchsorted(self.starts, keys.view(np.uint64), side="right") - 1


def directory_of(
    keys: DataFrame, bucket_entries: int = BUCKET_ENTRIES, key_bits: int = KEY_BITS
) -> Directory:
    """The directory of distinct ``keys`` (key) once no more bucket has to be split.

    Splits are read off histograms of leading bits, so that no doubling reads all keys
    again: the first one reaches a little deeper than an even spread needs, and only what
    is overfull there is looked at more deeply. Keys that no bit tells apart share a bucket.
    """
    total = keys.count()
    room = max(bucket_entries, math.ceil(total / MAX_BUCKETS))
    depth = min(math.ceil(math.log2(max(1.0, total / room))) + MORE_BITS, key_bits)
    found: list[tuple[int, int]] = []  # prefix of the key's bits, and its length
    overfull, low, rows = [0], 0, keys
    while overfull:
        prefix = F.shiftrightunsigned("key", key_bits - depth) if depth else F.lit(0).cast("long")
        # At most a few ranges for each bucket, whatever the number of keys.
        held = {r["prefix"]: r["n"] for r in rows.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n")).collect()}
        sums = [held]
        for _ in range(depth - low):
            above: dict[int, int] = {}
            for p, n in sums[-1].items():
                above[p >> 1] = above.get(p >> 1, 0) + n
            sums.append(above)
        open_slots, overfull = [(p, low) for p in overfull], []
        while open_slots:
            p, at = open_slots.pop()
            if sums[depth - at].get(p, 0) <= room or at == key_bits:
                found.append((p, at))
            elif at == depth:
                overfull.append(p)
            else:
                open_slots += [(2 * p, at + 1), (2 * p + 1, at + 1)]
        if overfull:
            rows = rows.filter(prefix.isin(overfull))
            low, depth = depth, min(depth + MORE_BITS, key_bits)
    found.sort(key=lambda f: f[0] << (key_bits - f[1]))
    starts = [p << (key_bits - at) for p, at in found]
    return Directory(np.array(starts, np.uint64), np.array([at for _, at in found]))


def _merged(tables: list[pa.Table]) -> pa.Table:
    """One row per bucket, key and text; texts are compared by their bytes."""
    grouped = pa.concat_tables(tables).group_by(["bucket", "key", "text"], use_threads=False)
    out = grouped.aggregate([("keep_id", "max"), ("copies", "sum")])
    return out.rename_columns(["bucket", "key", "text", "keep_id", "copies"])


def _combined(shared):
    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            bucket = shared.value.bucket_of(batch["key"].to_numpy())
            ones = np.ones(batch.num_rows, np.int64)
            columns = [pa.array(bucket, pa.int64()), batch["key"], batch["text"], batch["doc_id"], pa.array(ones)]
            held.append(_merged([pa.table(columns, ["bucket", "key", "text", "keep_id", "copies"])]))
            if sum(t.nbytes for t in held) > COMBINE_BYTES:
                held = [_merged(held)]
                if held[0].nbytes > COMBINE_BYTES // 2:
                    yield from held.pop().to_batches(max_chunksize=1000)
        if held:
            yield from _merged(held).to_batches(max_chunksize=1000)

    return run


def _owned(batches):
    """Entries of rows sorted by bucket and key."""
    names = [part.split()[0] for part in ENTRIES.split(", ")]

    def entries(place, texts):
        hashed = sorted((hashlib.sha256(text).hexdigest(), *found) for text, found in texts.items())
        return [(*place, chain, *entry) for chain, entry in enumerate(hashed)]

    place, texts = None, {}
    for batch in batches:
        rows = []
        columns = [batch["bucket"], batch["key"], batch["text"].cast(pa.binary()), batch["keep_id"], batch["copies"]]
        for bucket, key, text, keep_id, copies in zip(*[c.to_pylist() for c in columns], strict=True):
            if (bucket, key) != place:
                rows += entries(place, texts)
                place, texts = (bucket, key), {}
            found = texts.get(text)
            if found is None:
                texts[text] = [keep_id, copies]
            else:
                found[1] += copies
                if keep_id is not None and (found[0] is None or keep_id > found[0]):
                    found[0] = keep_id
        if rows:
            yield _entries(rows, names)
    if texts:
        yield _entries(entries(place, texts), names)


def _entries(rows, names) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def build_index(
    documents: DataFrame, bucket_entries: int = BUCKET_ENTRIES, key_bits: int = KEY_BITS
) -> tuple[DataFrame, Directory]:
    """Write the index; returns it as read from the shared folder, and its directory.

    (bucket, key, chain, text_sha256, keep_id, group_size); ``chain`` numbers the
    different texts of one key.
    """
    spark = documents.sparkSession
    rows = keyed(documents, key_bits)
    keys = stored(rows.select("key").distinct(), "dedup-keys")
    directory = directory_of(keys, bucket_entries, key_bits)
    shared = spark.sparkContext.broadcast(directory)
    sent = rows.select("key", "text", "doc_id").mapInArrow(
        _combined(shared), "bucket long, key long, text string, keep_id long, copies long"
    )
    owned = sent.repartition("bucket").sortWithinPartitions("bucket", "key").mapInArrow(_owned, ENTRIES)
    path = scratch_dir(spark, "dedup-index")
    owned.write.parquet(path)
    return spark.read.schema(owned.schema).parquet(path), directory


def exact_duplicates(
    documents: DataFrame, bucket_entries: int = BUCKET_ENTRIES, key_bits: int = KEY_BITS
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, chain.

    Of equal texts the row with the largest doc_id stays. Null texts are empty texts; very
    long ones are compared whole. Rows that repeat both id and text are one document and
    get the same answer. A group in which every id is null keeps its rows. Extra columns
    are ignored; an empty table gives no rows.
    """
    index, directory = build_index(documents, bucket_entries, key_bits)
    shared = documents.sparkSession.sparkContext.broadcast(directory)

    @F.pandas_udf("long")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(shared.value.bucket_of(keys.to_numpy(np.int64)))

    rows = keyed(documents, key_bits).select("doc_id", "key", F.sha2("text", 256).alias("text_sha256"))
    # A key's few entries are told apart by the digest.
    return rows.withColumn("bucket", bucket("key")).join(index, ["bucket", "key", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "chain",
    )
