"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a run of ``seed`` tokens are joined on the
Karp-Rabin hash of that run. For each such pair the longest common run of unmarked tokens is
marked as a tile, again and again, until none of ``seed`` tokens is left. Common runs are
looked for by length, on hashes of the tokens that lie in common seeds, so that a text that
repeats one run very often never makes pairs of all its places. Tiles may come in any order,
so a passage whose sentences were moved is still covered. The share of the item's tokens in
tiles decides. An item of fewer tokens is one seed, which has to be there whole.

The benchmark is the stated query set: it is sent to the tasks in blocks of bounded size,
one pass over the documents per block, and no document leaves its task.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tallyloom.llm.text_tasks import BASE, mixed, powers, rolling_hashes
from tallyloom.session import stored

SEED = 5
MIN_COVERAGE = 0.6
# Characters of benchmark text that one pass sends to every task.
BLOCK_CHARS = 16_000_000
TOKEN = re.compile(r"[^\W_]+")
FOUND = (
    "item_id long, coverage double, n_tiles long, n_tokens long, "
    "tiles array<struct<item_start:long,doc_start:long,length:long>>"
)


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


class Runs:
    """Karp-Rabin hashes of the runs of one row of tokens, for any length."""

    def __init__(self, tokens: np.ndarray):
        codes = mixed(tokens.astype(np.uint64))
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers(len(codes)), out=self._sums[1:])
        self._inverse = powers(len(codes) + 1, np.uint64(pow(int(BASE), -1, 1 << 64)))

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return (self._sums[starts + length] - self._sums[starts]) * self._inverse[starts]


def _ahead(at: np.ndarray) -> np.ndarray:
    """How many of the ascending numbers follow each other without a gap, from each on."""
    ends = np.flatnonzero(np.concatenate([np.diff(at) != 1, np.ones(min(1, len(at)), bool)]))
    return np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(len(at)) + 1


def _common(item: Runs, doc: Runs, item_at, doc_at, item_ahead, doc_ahead, length: int, seed: int):
    """Places of the item and of the document at which common runs of ``length`` begin."""
    i, j = item_at[item_ahead > length - seed], doc_at[doc_ahead > length - seed]
    a, b = item.at(i, length), doc.at(j, length)
    known = np.unique(a)
    held = np.isin(b, known)
    shared = np.isin(a, b[held])
    return i[shared], a[shared], j[held], b[held]


def greedy_tiles(item: Runs, doc: Runs, item_at, doc_at, seed: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (item start, document start, length) from the places of common seeds, ascending.

    The longest match is marked first (ties: the first in the item, then in the document).
    Matches of one length are marked together; then the seeds that meet marked tokens go,
    and the next length is the largest of a common run that is left. Memory is linear in
    the places.
    """
    tiles, limit = [], None
    while len(item_at) and len(doc_at):
        item_ahead, doc_ahead = _ahead(item_at), _ahead(doc_at)
        high = int(min(item_ahead.max(), doc_ahead.max())) + seed - 1
        high = high if limit is None else min(high, limit)
        common = lambda n: _common(item, doc, item_at, doc_at, item_ahead, doc_ahead, n, seed)  # noqa: B023, E731
        found, low = common(high), seed
        if not len(found[0]):
            # A common run of some length has common runs of all lesser lengths.
            high -= 1
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if len(common(middle)[0]) else (low, middle - 1)
            if low > high or not len((found := common(low))[0]):
                break
            high = low
        made = _of_length(high, *found)
        tiles += made
        limit = high - 1
        item_at = _left(item_at, [a for a, _, _ in made], high, seed)
        doc_at = _left(doc_at, [b for _, b, _ in made], high, seed)
        if limit < seed:
            break
    return sorted(tiles)


def _left(at: np.ndarray, starts: list[int], length: int, seed: int) -> np.ndarray:
    """Places whose seeds meet no tile."""
    starts = np.sort(np.array(starts, np.int64))
    near = np.searchsorted(starts, at + seed, side="left") - 1
    return at[(near < 0) | (starts[np.maximum(near, 0)] + length <= at)]


def _of_length(length: int, i, item_hashes, j, doc_hashes) -> list[tuple[int, int, int]]:
    """Matches of one length that do not meet, the first in the item and document first."""
    order = np.argsort(doc_hashes, kind="stable")
    j, doc_hashes = j[order], doc_hashes[order]
    first = np.searchsorted(doc_hashes, item_hashes, side="left")
    last = np.searchsorted(doc_hashes, item_hashes, side="right")
    made, taken, free_item, tried = [], [], -1, {}
    for a, x, y in zip(i.tolist(), first.tolist(), last.tolist(), strict=True):
        if a < free_item:
            continue
        at = tried.get(x, x)
        while at < y:
            b = int(j[at])
            near = bisect_left(taken, b - length + 1)
            if near == len(taken) or taken[near] >= b + length:
                break
            # The places up to this tile's end meet it, too.
            at += int(np.searchsorted(j[at:y], taken[near] + length))
        tried[x] = at
        if at < y:
            made.append((a, b, length))
            insort(taken, b)
            free_item = a + length
    return made


def tiles_of(item: np.ndarray, doc: np.ndarray, seed: int = SEED) -> list[tuple[int, int, int]]:
    """The tiles of two rows of token numbers."""
    a, b = (rolling_hashes(mixed(t.astype(np.uint64)), seed) for t in (item, doc))
    return greedy_tiles(Runs(item), Runs(doc), np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a)), seed)


@dataclass(frozen=True)
class Block:
    """Part of the benchmark with the index of its seeds."""

    vocabulary: dict[str, int]
    item_ids: list[int]
    tokens: np.ndarray  # of all items in a row
    token_heads: np.ndarray  # where each item's tokens begin
    seeds: np.ndarray  # distinct hashes, sorted
    slots: np.ndarray  # the seed at each place of each item, in a row
    slot_heads: np.ndarray
    items: np.ndarray  # the items of each seed, seed by seed
    item_heads: np.ndarray
    short: list[tuple[int, np.ndarray, np.ndarray]]  # (tokens, hashes ascending, items)
    seed: int

    @staticmethod
    def of(rows: list[tuple[int, str]], seed: int = SEED) -> Block:
        vocabulary: dict[str, int] = {}
        tokens, hashes, owners, short = [], [], [], {}
        for number, (_, text) in enumerate(rows):
            words = tokens_of(text)
            ids = np.array([vocabulary.setdefault(word, len(vocabulary) + 1) for word in words], np.uint64)
            rolled = rolling_hashes(mixed(ids), seed)
            if 0 < len(ids) < seed:
                short.setdefault(len(ids), []).append((int(rolling_hashes(mixed(ids), len(ids))[0]), number))
            tokens.append(ids)
            hashes.append(rolled)
            owners.append(np.full(len(rolled), number, np.int64))
        heads = lambda parts: np.cumsum([0, *map(len, parts)])
        seeds, slots = np.unique(np.concatenate([*hashes, np.empty(0, np.uint64)]), return_inverse=True)
        pairs = np.unique(np.stack([slots, np.concatenate([*owners, np.empty(0, np.int64)])]), axis=1)
        wide = []
        for width, held in sorted(short.items()):
            held.sort()
            wide.append((width, np.array([h for h, _ in held], np.uint64), np.array([n for _, n in held])))
        return Block(
            vocabulary,
            [item_id for item_id, _ in rows],
            np.concatenate([*tokens, np.empty(0, np.uint64)]),
            heads(tokens),
            seeds,
            slots,
            heads(hashes),
            pairs[1],
            np.searchsorted(pairs[0], np.arange(len(seeds) + 1)),
            wide,
            seed,
        )

    def matches(self, text: str | None, min_coverage: float):
        """(item number, coverage, tiles) of the items that the text covers enough."""
        get = self.vocabulary.get
        ids = np.array([get(word, 0) for word in tokens_of(text)], np.uint64)
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        for width, hashes, items in self.short:
            at, rolled = self._seeds(ids, known, width)
            own, first = np.unique(rolled, return_index=True)
            place = np.searchsorted(own, hashes)
            hit = place < len(own)
            hit[hit] = own[place[hit]] == hashes[hit]
            for item, start in zip(items[hit].tolist(), at[first[place[hit]]].tolist(), strict=True):
                yield item, 1.0, [(0, start, width)]
        at, rolled = self._seeds(ids, known, self.seed)
        slot = np.searchsorted(self.seeds, rolled)
        hit = slot < len(self.seeds)
        hit[hit] = self.seeds[slot[hit]] == rolled[hit]
        at, slot = at[hit], slot[hit]
        if not len(at):
            return
        present = np.unique(slot)
        counts = self.item_heads[present + 1] - self.item_heads[present]
        ends = np.cumsum(counts)
        entry = np.arange(ends[-1]) + np.repeat(self.item_heads[present] - ends + counts, counts)
        doc = None
        for item in np.unique(self.items[entry]).tolist():
            size = int(self.token_heads[item + 1] - self.token_heads[item])
            slots = self.slots[self.slot_heads[item] : self.slot_heads[item + 1]]
            item_at = np.flatnonzero(_within(slots, present))
            # What all tiles together cover at most; spares the tiling of chance seeds.
            gaps = np.minimum(np.diff(np.concatenate([item_at, [item_at[-1] + self.seed]])), self.seed)
            if gaps.sum() < min_coverage * size:
                continue
            doc = doc or Runs(ids)
            own = Runs(self.tokens[self.token_heads[item] : self.token_heads[item + 1]])
            tiles = greedy_tiles(own, doc, item_at, at[_within(slot, np.unique(slots))], self.seed)
            coverage = sum(length for _, _, length in tiles) / size
            if coverage >= min_coverage:
                yield item, coverage, tiles

    def _seeds(self, ids: np.ndarray, known: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of runs of ``width`` tokens that the benchmark has, and their hashes."""
        if len(ids) < width:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(known[width:] - known[:-width] == width)
        return at, rolling_hashes(mixed(ids), width)[at]


def _within(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ones."""
    place = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[place] == values


def benchmark_blocks(
    benchmark: DataFrame, seed: int = SEED, block_chars: int = BLOCK_CHARS
):
    """The benchmark in blocks of about ``block_chars`` characters, one at a time, and
    whether each is the last.

    Repeated items are taken once per text and id. Null texts and those without tokens
    match nothing. Null ids are taken as they are.
    """
    rows = benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_chars))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    for number in range(count):
        held = dealt.filter(F.col("block") == number).orderBy("item_id", "text").collect()
        yield Block.of([(row["item_id"], row["text"]) for row in held], seed), number == count - 1


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    min_coverage: float = MIN_COVERAGE,
    seed: int = SEED,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item that it covers: doc_id, item_id, coverage and tiles.

    Tokens are runs of letters and digits in lower case; starts and lengths count tokens.
    An item of fewer than ``seed`` tokens is covered where all of them stand in a row.
    Null and empty texts cover nothing; very long texts are read whole, in memory linear in
    their length; null ids and repeated rows give rows of their own; extra columns are
    ignored; an empty table gives no rows.
    """
    spark = documents.sparkSession
    rows, found = documents.select("doc_id", "text"), None
    for block, last in benchmark_blocks(benchmark, seed, block_chars):
        shared = spark.sparkContext.broadcast(block)
        part = rows.mapInPandas(_search(shared, min_coverage), f"doc_id long, {FOUND}")
        if not last:
            # A block is let go before the next one is built.
            part = stored(part, "tilings")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def _search(shared, min_coverage: float):
    def run(batches):
        block = shared.value
        names = ["doc_id", *[part.split()[0] for part in FOUND.split(", ")]]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                for item, coverage, tiles in block.matches(text, min_coverage):
                    spans = [
                        {"item_start": a, "doc_start": b, "length": n} for a, b, n in tiles
                    ]
                    out.append(
                        (
                            None if pd.isna(doc_id) else int(doc_id),
                            block.item_ids[item],
                            coverage,
                            len(tiles),
                            sum(n for _, _, n in tiles),
                            spans,
                        )
                    )
            frame = pd.DataFrame(out, columns=names)
            for name in ("doc_id", "item_id"):
                frame[name] = frame[name].astype("Int64")
            yield frame

    return run


def without_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    min_coverage: float = MIN_COVERAGE,
    seed: int = SEED,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents that cover no item, with all their columns, whatever their names.

    The odd cases are those of ``contaminated``: null and empty texts stay, as do repeated
    rows and rows without an id whose texts cover nothing.
    """
    for block, last in benchmark_blocks(benchmark, seed, block_chars):
        shared = documents.sparkSession.sparkContext.broadcast(block)
        covers = F.pandas_udf(_covering(shared, min_coverage), BooleanType())
        documents = documents.filter(~covers(F.col("text")))
        if not last:
            documents = stored(documents, "clean")
            shared.destroy()
    return documents


def _covering(shared, min_coverage: float):
    def covers(texts: pd.Series) -> pd.Series:
        block = shared.value
        return pd.Series([any(True for _ in block.matches(t, min_coverage)) for t in texts], dtype=bool)

    return covers
