"""Repeated passages by fixed-block anchors.

A window of ``window`` words holds, wherever it lies, one whole block of ``block`` words
that begins at a multiple of ``block`` in its document. The blocks are the index; every
rolling window of ``block`` words probes it. What is hit is extended: the full windows
around hits are compared by 96 bits, and those that start in more than one place cover
the words of maximal exact repeats, which are removed.

Documents are laid out once in cells of bounded size, kept as a bucketed table, so that
no later step shuffles texts. A cell sends each distinct hash once, so that a passage
that very many documents share costs one entry per cell; hashes are gathered in ranges of
bounded size. No pairs of documents are made.
"""

from __future__ import annotations

import math
import uuid
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.text_tasks import ascii_words, mixed, rolling_hashes, word_codes
from tallyloom.session import scratch_dir

WINDOW = 35
# Least characters of text per cell and per range of hashes; both are held by one task.
CELL_CHARS = 8_000_000
RANGE_CHARS = 32_000_000
# A cell sends each range some 1,000 hashes or more: beyond about 10 ** 10 characters both
# sizes grow with the square root of the text, to some 10 ** 9 characters at 100 TB.
SENT_CHARS = 6_000
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
SENT = "bucket int, cell int, keys binary, more binary, blocks binary"
REPLY = "cell int, keys binary, more binary"
RESULT = "doc_id long, kept_text string, n_words long, n_removed long"


class _Words:
    """The words of a cell's documents in one row, with what is needed to roll over them."""

    def __init__(self, texts: list[str | None]):
        self.split = [ascii_words(text) for text in texts]
        self.sizes = np.array([len(words) for words in self.split], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.total = int(self.sizes.sum())
        codes = [word_codes(words) for words in self.split]
        self.codes = np.concatenate([*codes, np.empty(0, np.uint64)])

    def inside(self, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows within one document, of documents of ``least`` words or more:
        in the row of all words, and in their documents."""
        counts = np.where(self.sizes >= least, self.sizes - width + 1, 0)
        ends = np.cumsum(counts)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
        return np.repeat(self.starts, counts) + within, within


def _anchor_keys(words: _Words, at: np.ndarray, block: int, ranges: int) -> np.ndarray:
    """Bucket in the high and 32 bits of the hash in the low half."""
    hashes = mixed(rolling_hashes(words.codes, block)[at])
    bucket = (hashes >> np.uint64(40)) % np.uint64(ranges)
    return bucket << np.uint64(32) | hashes & _LOW


def _window_keys(words: _Words, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits per window, from two rolling hashes: 64 and 32 of them."""
    first = mixed(rolling_hashes(words.codes, window)[at])
    second = mixed(rolling_hashes(words.codes, window, _SECOND)[at])
    return first, (second >> np.uint64(32)).astype("<u4")


def _sorted_keys(first: np.ndarray, second: np.ndarray):
    """Order of 96-bit keys, and where in that order a new key begins."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    if (a[1:] == a[:-1]).any() and (b[1:] != b[:-1])[a[1:] == a[:-1]].any():
        order = np.lexsort((second, first))  # two keys that share their first 64 bits
        a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Places of ``values`` that are in the sorted ``among``.

    A table of the low bits rules out most values before the search.
    """
    if not len(among):
        return np.empty(0, np.int64)
    bits = np.uint64((1 << 20) - 1)
    table = np.zeros(1 << 20, bool)
    table[among & bits] = True
    likely = np.flatnonzero(table[values & bits])
    found = np.searchsorted(among, values[likely])
    found = np.minimum(found, len(among) - 1)
    return likely[among[found] == values[likely]]


def _texts(table: pa.Table) -> list[str | None]:
    return table.column("text").to_pylist()


def _cell_of(table: pa.Table) -> int:
    return table.column("cell")[0].as_py()


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    fields = [part.split() for part in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.Table.from_arrays(
        [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _probes(window: int, block: int, ranges: int):
    """Per cell and bucket: distinct hashes, those met twice here, and those of blocks."""

    def run(table: pa.Table) -> pa.Table:
        words, cell = _Words(_texts(table)), _cell_of(table)
        at, within = words.inside(block, window)
        if not len(at):
            return _table(SENT, [])
        keys = _anchor_keys(words, at, block, ranges)
        blocks = np.unique(keys[within % block == 0])
        keys, counts = np.unique(keys, return_counts=True)
        twice = keys[counts > 1]
        rows = []
        for bucket in np.unique(keys >> np.uint64(32)).tolist():
            edges = np.array([bucket, bucket + 1], np.uint64) << np.uint64(32)
            parts = [
                (part[slice(*np.searchsorted(part, edges))] & _LOW).astype("<u4").tobytes()
                for part in (keys, twice, blocks)
            ]
            rows.append((bucket, cell, *parts))
        return _table(SENT, rows)

    return run


def _anchored(table: pa.Table) -> pa.Table:
    """Per cell: its hashes that are some block's and are met in two places or more."""
    cells = table.column("cell").to_pylist()
    keys, twice, blocks = (
        [np.frombuffer(x, "<u4") for x in table.column(name).to_pylist()]
        for name in ("keys", "more", "blocks")
    )
    index = np.unique(np.concatenate(blocks))
    places = np.zeros(len(index), np.int64)
    for part in (*keys, *twice):
        found = np.minimum(np.searchsorted(index, part), max(len(index) - 1, 0))
        found = found[index[found] == part] if len(index) else found[:0]
        places[found] += 1
    hits = index[places > 1]
    bucket = table.column("bucket")[0].as_py()
    rows = []
    for cell, part in zip(cells, keys, strict=True):
        own = np.intersect1d(part, hits, assume_unique=True)
        if len(own):
            full = own.astype("<u8") | np.uint64(bucket << 32)
            rows.append((cell, full.tobytes(), b""))
    return _table(REPLY, rows)


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    parts = [np.frombuffer(x, dtype) for x in table.column(name).to_pylist()]
    return np.concatenate([*parts, np.empty(0, dtype)])


def _candidates(window: int, block: int, ranges: int):
    """Per cell and bucket: keys of the full windows around hits."""

    def run(table: pa.Table, hits: pa.Table) -> pa.Table:
        if not table.num_rows or not hits.num_rows:
            return _table(SENT, [])
        words, cell = _Words(_texts(table)), _cell_of(table)
        at = _around(words, hits, window, block, ranges)
        first, second = _window_keys(words, at, window)
        order, new = _sorted_keys(first, second)
        heads = np.flatnonzero(new)
        counts = np.diff(np.concatenate([heads, [len(order)]]))
        keys = _pack(first[order][heads], second[order][heads])
        buckets = ((keys["a"] >> np.uint64(40)) % np.uint64(ranges)).astype(np.int64)
        rows = []
        for bucket in np.unique(buckets).tolist():
            own = buckets == bucket
            twice = keys[own & (counts > 1)]
            rows.append((bucket, cell, keys[own].tobytes(), twice.tobytes(), b""))
        return _table(SENT, rows)

    return run


def _around(words: _Words, hits: pa.Table, window: int, block: int, ranges: int) -> np.ndarray:
    """Starts of the full windows that hold a hit block window."""
    at, _ = words.inside(window, window)
    probes, _ = words.inside(block, window)
    among = np.sort(_joined(hits, "keys", "<u8"))
    marks = np.zeros(words.total + 1, np.int64)
    marks[probes[_member(_anchor_keys(words, probes, block, ranges), among)]] = 1
    sums = np.concatenate([[0], np.cumsum(marks)])
    return at[sums[at + window - block + 1] > sums[at]]


KEY = np.dtype([("a", "<u8"), ("b", "<u4")])


def _pack(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    keys = np.empty(len(first), KEY)
    keys["a"], keys["b"] = first, second
    return keys


def _repeated(table: pa.Table) -> pa.Table:
    """Per cell: its window keys that are met in two places or more."""
    cells = table.column("cell").to_pylist()
    sizes = [len(x) // KEY.itemsize for x in table.column("keys").to_pylist()]
    every = np.concatenate([_joined(table, "keys", KEY), _joined(table, "more", KEY)])
    order, new = _sorted_keys(every["a"].copy(), every["b"].copy())
    heads = np.flatnonzero(new)
    counts = np.diff(np.concatenate([heads, [len(order)]]))
    again = np.zeros(len(every), bool)
    again[order] = np.repeat(counts > 1, counts)
    ends = np.cumsum(sizes)
    rows = []
    for cell, last, size in zip(cells, ends.tolist(), sizes, strict=True):
        own = slice(last - size, last)
        if again[own].any():
            rows.append((cell, every[own][again[own]].tobytes(), b""))
    return _table(REPLY, rows)


def _removed(window: int):
    def run(table: pa.Table, repeats: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table(RESULT, [])
        words = _Words(_texts(table))
        marks = np.zeros(words.total + 1, np.int64)
        if repeats.num_rows:
            at, _ = words.inside(window, window)
            hit = at[_is_repeat(*_window_keys(words, at, window), _joined(repeats, "keys", KEY))]
            marks[hit] += 1
            np.subtract.at(marks, hit + window, 1)
        covered = np.cumsum(marks)[:-1] > 0
        rows = []
        for doc_id, split, start in zip(
            table.column("doc_id").to_pylist(), words.split, words.starts.tolist(), strict=True
        ):
            own = covered[start : start + len(split)]
            kept = list(compress(split, ~own)) if own.any() else split
            text = b" ".join(kept).decode("utf-8", "surrogatepass")
            rows.append((doc_id, text, len(split), len(split) - len(kept)))
        return _table(RESULT, rows)

    return run


def _is_repeat(first: np.ndarray, second: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Places of the windows whose 96 bits are among ``repeats``."""
    order, _ = _sorted_keys(repeats["a"].copy(), repeats["b"].copy())
    a, b = repeats["a"][order], repeats["b"][order]
    likely = _member(first, a)
    left = np.searchsorted(a, first[likely], side="left")
    same = b[left] == second[likely]
    # Repeats that share their first 64 bits are looked at one by one.
    for place in np.flatnonzero(~same).tolist():
        right = np.searchsorted(a, first[likely[place]], side="right")
        same[place] = second[likely[place]] in b[left[place] : right]
    return likely[same]


def _least_chars(chars: int) -> int:
    return math.isqrt(SENT_CHARS * chars) if chars > 10**10 else 0


def laid_out(documents: DataFrame, cell_chars: int = CELL_CHARS) -> tuple[DataFrame, int]:
    """(cell, doc_id, text) as a table bucketed by cell, and the characters in it.

    Rows are numbered, so that repeated and null ids are told apart, and dealt to cells
    evenly, whatever their ids.
    """
    spark = documents.sparkSession
    chars = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    cells = max(1, math.ceil(chars / max(cell_chars, _least_chars(chars))))
    number = F.xxhash64(F.monotonically_increasing_id())
    rows = documents.select("doc_id", "text", F.pmod(number, F.lit(cells)).cast("int").alias("cell"))
    files = max(1, math.ceil(cells / 2))
    name = f"cells_{uuid.uuid4().hex}"
    (
        rows.repartition(files, "cell")
        .write.bucketBy(files, "cell")
        .sortBy("cell")
        .option("path", scratch_dir(spark, "cells"))
        .saveAsTable(name)
    )
    return spark.table(name), chars


def without_repeats(
    documents: DataFrame,
    window: int = WINDOW,
    cell_chars: int = CELL_CHARS,
    range_chars: int = RANGE_CHARS,
) -> DataFrame:
    """Per row: doc_id, kept_text, n_words, n_removed.

    Words are runs of what is neither a space nor one of the code points 9 to 13. A word
    goes if a window of ``window`` words that covers it starts in another place, too; the
    words that stay are joined by one space. Null and empty texts, and texts of fewer
    words than a window, lose nothing. Repeated rows repeat each other's words, so both
    lose them. Null ids are kept; extra columns are ignored; an empty table gives no rows.
    """
    block = (window + 1) // 2
    table, chars = laid_out(documents, cell_chars)
    ranges = max(1, math.ceil(chars / max(range_chars, _least_chars(chars))))
    by_cell = table.groupBy("cell")
    sent = by_cell.applyInArrow(_probes(window, block, ranges), SENT)
    hits = sent.groupBy("bucket").applyInArrow(_anchored, REPLY)
    around = by_cell.cogroup(hits.groupBy("cell")).applyInArrow(
        _candidates(window, block, ranges), SENT
    )
    repeats = around.groupBy("bucket").applyInArrow(_repeated, REPLY)
    return by_cell.cogroup(repeats.groupBy("cell")).applyInArrow(_removed(window), RESULT)
