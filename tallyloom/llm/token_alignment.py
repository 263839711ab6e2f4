"""Alignment of two tokenizers' tokens over the bytes of each text.

Per batch, pandas ``merge_asof`` finds for the start of each token of one side the token of
the other side that covers it, keyed by document; both directions together give every pair
of tokens whose bytes overlap. Offsets where tokens of both sides end cut a document into
groups. Pairs of ids are counted over all documents: tasks add up their own counts, Spark
the tasks'. Documents then look up the counts of their links: frequent pairs in a table of
bounded size that all tasks get, other pairs by a join.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from array import array
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import scratch_dir, stored

# Bytes of text that are aligned at once; one text may have more.
GROUP_BYTES = 1_000_000
# Pieces of text whose ids a task remembers.
CACHE_PIECES = 400_000
# Pairs that a task counts before it hands them on, and that every task gets for look-ups.
TASK_PAIRS = 1 << 21
HOT_PAIRS = 1 << 19
# A text is encoded by pieces that begin with its spaces after another sign.
PIECE_END = re.compile(r"(?<=\S) ")
# Fixed value: how byte-level tokenizers of this kind split a text.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SPACE = "▁"
ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a_ids binary, b_ids binary, pairs array<long>, times array<long>"
)
_DOCUMENT = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def byte_alphabet() -> dict[str, int]:
    """The sign that stands for each byte: itself if it is printable, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteSide:
    """Byte-level tokens of a tokenizer file; special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        alphabet, vocabulary = byte_alphabet(), model["vocab"]
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(sign in alphabet for sign in token):
                self.tokens[number] = bytes(alphabet[sign] for sign in token)
        first = min((vocabulary[token] for token in joined), default=0)
        if [vocabulary[token] for token in joined] == list(range(first, first + len(joined))):
            # Ids in the order of the merges are ranks, which another library encodes faster.
            ranks = {token: number for number, token in enumerate(self.tokens[: first + len(joined)]) if token}
            core = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._encode = core.encode_ordinary
        else:
            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True
            self._encode = lambda text: library.encode(text, add_special_tokens=False).ids

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece with a space before it."""
        encode = self._encode
        return [encode(" " + piece) for piece in pieces]


class PieceSide:
    """Tokens of a sentence-piece model that puts a space before each text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens, self.whole = [], False
        for number in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(number)
            if self._model.is_byte(number):
                self.tokens.append(bytes([int(piece[3:5], 16)]))
                continue
            # Only tokens with a space after another sign could reach over the end of a piece.
            self.whole |= SPACE in piece.lstrip(SPACE)
            self.tokens.append(piece.replace(SPACE, " ").encode())
        self._space = [self._model.piece_to_id(SPACE)]

    def encode(self, pieces: list[str]) -> list[list[int]]:
        found = self._model.encode(pieces, num_threads=1)
        # The model has no token for an empty text, which here is a space at a text's end.
        return [ids if piece else self._space for piece, ids in zip(pieces, found, strict=True)]


class Aligner:
    """Tokens, links and groups of texts under two tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteSide(a_path), PieceSide(b_path)
        self.a_bytes = np.array([len(t) for t in self.a.tokens], np.int64)
        self.b_bytes = np.array([len(t) for t in self.b.tokens], np.int64)
        self.width = len(self.b.tokens)
        if max(len(self.a.tokens), self.width) > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        # Ids in decimal, with the sign after them: within a group, and at its end.
        self._a_text = np.array([f"{n}," for n in range(len(self.a.tokens))] + [f"{n}|" for n in range(len(self.a.tokens))], object)
        self._b_text = np.array([f"{n}," for n in range(self.width)] + [f"{n};" for n in range(self.width)], object)
        self._known: dict[str, tuple[bytes, bytes]] = {}
        self._odd: set[str] = set()

    def _learn(self, pieces: list[str]) -> None:
        found = zip(pieces, self.a.encode(pieces), self.b.encode(pieces), strict=True)
        for piece, a, b in found:
            self._known[piece] = array("H", a).tobytes(), array("H", b).tobytes()
            raw = (" " + piece).encode()
            if self._bytes(self.a, a) != raw or self._bytes(self.b, b) != raw:
                self._odd.add(piece)

    @staticmethod
    def _bytes(side, ids) -> bytes:
        return b"".join(map(side.tokens.__getitem__, ids))

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none for texts that are null, empty, or not given back whole."""
        split = [([text] if self.b.whole else PIECE_END.split(text)) if text else [] for text in texts]
        new = list({piece for piece in chain.from_iterable(split) if piece not in self._known})
        if len(self._known) + len(new) > CACHE_PIECES:
            self._known.clear()
            self._odd.clear()
            new = list(set(chain.from_iterable(split)))
        self._learn(new)
        get, coded = self._known.__getitem__, []
        for text, pieces in zip(texts, split, strict=True):
            a, b = zip(*map(get, pieces), strict=True) if pieces else ((), ())
            a, b = np.frombuffer(b"".join(a), np.uint16), np.frombuffer(b"".join(b), np.uint16)
            if not self._odd.isdisjoint(pieces):
                raw = (" " + text).encode()
                if self._bytes(self.a, a.tolist()) != raw or self._bytes(self.b, b.tolist()) != raw:
                    a = b = a[:0]
            coded.append((a, b))
        if len(self._known) > CACHE_PIECES:  # one group alone may hold more
            self._known.clear()
            self._odd.clear()
        return coded

    def links(self, a: np.ndarray, a_doc: np.ndarray, b: np.ndarray, b_doc: np.ndarray):
        """(token of A, token of B) of all links, by number, and the tokens' ends.

        Both sides have the same bytes per document, so offsets run on from one document
        to the next. Tokens without bytes have no links.
        """
        a_end, b_end = np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b])
        sides = []
        for ids, doc, end, sizes in ((a, a_doc, a_end, self.a_bytes), (b, b_doc, b_end, self.b_bytes)):
            frame = pd.DataFrame({"at": end - sizes[ids], "doc": doc, "token": np.arange(len(ids))})
            sides.append(frame if sizes.min() else frame[sizes[ids] > 0])
        left, right = sides
        under = [
            pd.merge_asof(one[["at", "doc"]], other, on="at", by="doc")["token"].to_numpy()
            for one, other in ((left, right), (right, left))
        ]
        a_at, b_at = left["at"].to_numpy(), right["at"].to_numpy()
        starts = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, bool)
        starts[a_at] = True
        # Tokens that start together have met in the first direction.
        more = ~starts[b_at]
        first = np.concatenate([left["token"].to_numpy(), under[1][more].astype(np.int64)])
        second = np.concatenate([under[0].astype(np.int64), right["token"].to_numpy()[more]])
        return first, second, a_end, b_end

    def group_of(self, a_end: np.ndarray, b_end: np.ndarray):
        """Whether each token ends a group, on both sides."""
        ends = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, np.int8)
        ends[a_end] += 1
        ends[b_end] += 2
        both = ends == 3
        return both[a_end], both[b_end]

    def keys(self, a: np.ndarray, b: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """One number per link for its pair of ids."""
        return a[first].astype(np.int64) * self.width + b[second]

    def written(self, a, b, a_cut, b_cut) -> np.ndarray:
        """Groups as text, token by token in their order: `a1,a2|b1;a3|b2`."""
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        a_held, b_held = np.bincount(a_group), np.bincount(b_group)
        out = np.empty(len(a) + len(b), object)
        a_place = np.arange(len(a)) + np.concatenate([[0], np.cumsum(b_held)])[a_group]
        b_place = np.arange(len(b)) + np.cumsum(a_held)[b_group]
        out[a_place] = self._a_text[a + len(self.a.tokens) * a_cut.astype(np.int64)]
        out[b_place] = self._b_text[b + self.width * b_cut.astype(np.int64)]
        return out

    def align(self, texts: list[str | None]):
        """Per text: counts, digest and ids; and the pairs of the texts' links with their times."""
        coded = self.encode(texts)
        a, a_doc, b, b_doc, sizes = _joined(coded)
        first, second, a_end, b_end = self.links(a, a_doc, b, b_doc)
        a_cut, b_cut = self.group_of(a_end, b_end)
        count = len(texts)
        tokens = self.written(a, b, a_cut, b_cut)
        ends = np.cumsum(sizes.sum(axis=1)).tolist()
        starts = [0, *ends[:-1]]
        digests = [
            hashlib.sha256("".join(tokens[x:y])[:-1].encode()).hexdigest() if y > x else ""
            for x, y in zip(starts, ends, strict=True)
        ]
        pairs, times = np.unique(self.keys(a, b, first, second), return_counts=True)
        columns = [
            sizes[:, 0],
            sizes[:, 1],
            np.bincount(a_doc[a_cut], minlength=count),
            np.bincount(a_doc[first], minlength=count),
            digests,
            [one.tobytes() for one, _ in coded],
            [two.tobytes() for _, two in coded],
        ]
        return columns, pairs, times


def _joined(coded: list[tuple[np.ndarray, np.ndarray]]):
    """The ids of all texts in a row with their texts' numbers, and the tokens per text and side."""
    sizes = np.array([(len(a), len(b)) for a, b in coded], np.int64).reshape(-1, 2)
    none = np.empty(0, np.uint16)
    a, b = (np.concatenate([none, *[c[k] for c in coded]]) for k in (0, 1))
    numbers = np.arange(len(coded), dtype=np.int64)
    return a, np.repeat(numbers, sizes[:, 0]), b, np.repeat(numbers, sizes[:, 1]), sizes


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_of(a_path: str, b_path: str) -> Aligner:
    """One per worker process, so that tasks share the pieces they have seen."""
    if (a_path, b_path) not in _ALIGNERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _groups_of(sizes: np.ndarray, limit: int):
    """Ranges of rows of at most ``limit`` bytes, or of one row."""
    first, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield first, row
            first, held = row, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


class _Counts:
    """Pairs with their times, added up."""

    def __init__(self):
        self._parts, self._held = [], 0

    def add(self, pairs: np.ndarray, times: np.ndarray):
        """Counts to hand on, once there are too many."""
        self._parts.append((pairs, times))
        self._held += len(pairs)
        if self._held > TASK_PAIRS:
            self._merge()
            if self._held > TASK_PAIRS // 2:
                return self.take()
        return None

    def _merge(self) -> None:
        if len(self._parts) > 1:
            pairs = np.concatenate([p for p, _ in self._parts])
            times = np.concatenate([t for _, t in self._parts])
            pairs, at = np.unique(pairs, return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, at, times)
            self._parts = [(pairs, sums)]
            self._held = len(pairs)

    def take(self):
        self._merge()
        held, self._parts, self._held = self._parts, [], 0
        return held[0] if held else None


def _counted(pairs: np.ndarray, times: np.ndarray):
    """Rows that carry pairs instead of a document."""
    names = [part.split()[0] for part in ALIGNED.split(", ")]
    for first in range(0, len(pairs), 100_000):
        part = slice(first, first + 100_000)
        lists = [pa.array([values[part]], pa.list_(pa.int64())) for values in (pairs, times)]
        kinds = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([*[pa.nulls(1, kind) for kind in kinds], *lists], names)


def _align(a_path: str, b_path: str):
    names = [part.split()[0] for part in ALIGNED.split(", ")]

    def run(batches):
        aligner, counts = aligner_of(a_path, b_path), _Counts()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch["text"]
            sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy()
            for first, last in _groups_of(sizes, GROUP_BYTES):
                columns, pairs, times = aligner.align(texts[first:last].to_pylist())
                rows = np.arange(row, row + last - first)
                row += last - first
                kinds = [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
                none = pa.nulls(last - first, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        batch["doc_id"][first:last],
                        *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                        none,
                        none,
                    ],
                    names,
                )
                full = counts.add(pairs, times)
                if full:
                    yield from _counted(*full)
        rest = counts.take()
        if rest:
            yield from _counted(*rest)

    return run


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): links of each pair of ids over all documents.

    ``best`` marks the pairs of the highest count of their B id, ties included.
    """
    listed = aligned.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = listed.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    counts = stored(counts, "pair-counts").withColumn("b", F.col("pair") % width)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return stored(counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def hot_pairs(counts: DataFrame, hot: int = HOT_PAIRS) -> pd.DataFrame:
    """The most frequent pairs, ``hot`` at most, ascending."""
    level = F.floor(F.log2("n") * 8)
    sizes = sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    least, held = math.inf, 0
    for r in sizes:  # eight levels for each doubling of the counts
        held += r["count"]
        if held > hot:
            break
        least = r["level"]
    if least == math.inf:
        return pd.DataFrame({"pair": [], "n": [], "best": []}).astype({"pair": "int64", "n": "int64", "best": "bool"})
    return counts.filter(level >= least).toPandas().sort_values("pair")


_SUMS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "n_best long, count_sum long, pairs array<long>, times array<long>"
)


def _look_up(a_path: str, b_path: str, shared):
    def run(batches):
        aligner = aligner_of(a_path, b_path)
        pairs, counts, best = shared.value
        for batch in batches:
            sizes = pa.compute.binary_length(batch["a_ids"]).to_numpy()
            for first, last in _groups_of(sizes, GROUP_BYTES):
                part = batch.slice(first, last - first)
                count = part.num_rows
                coded = [
                    tuple(np.frombuffer(ids, np.uint16) for ids in both)
                    for both in zip(part["a_ids"].to_pylist(), part["b_ids"].to_pylist(), strict=True)
                ]
                a, a_doc, b, b_doc, _ = _joined(coded)
                one, two, _, _ = aligner.links(a, a_doc, b, b_doc)
                keys, doc = aligner.keys(a, b, one, two), a_doc[one]
                at = np.searchsorted(pairs, keys)
                known = at < len(pairs)
                known[known] = pairs[at[known]] == keys[known]
                at = at[known]
                sums, bests = np.zeros(count, np.int64), np.zeros(count, np.int64)
                np.add.at(sums, doc[known], counts[at])
                np.add.at(bests, doc[known], best[at])
                # A group has far fewer than 2 ** 32 texts, and pairs of 16-bit ids are below that.
                rare, times = np.unique(doc[~known] << 32 | keys[~known], return_counts=True)
                cuts = pa.array(np.searchsorted(rare >> 32, np.arange(count + 1)), pa.int32())
                values = rare & (1 << 32) - 1, times.astype(np.int64)
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in values]
                yield pa.RecordBatch.from_arrays(
                    [*[part[name] for name in _DOCUMENT], pa.array(bests), pa.array(sums), *lists],
                    [field.split()[0] for field in _SUMS.split(", ")],
                )

    return run


def aligned(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents with their counts, digest and ids, and rows that carry pairs; see ``ALIGNED``.

    Written to the shared folder and read back. ``a_ids`` and ``b_ids`` are the tokens as
    little-endian unsigned 16-bit integers.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_align(a_path, b_path), ALIGNED)
    path = scratch_dir(documents.sparkSession, "aligned")
    found.write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(found.schema).parquet(path)


def alignment(documents: DataFrame, a_path: str, b_path: str, hot: int = HOT_PAIRS) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text is encoded with a space before it. Tokens of both sides that share a byte are
    linked; offsets where both sides end cut them into groups. ``count_sum`` adds up, over
    a document's links, how many links in all documents have that pair of ids, and
    ``n_best`` counts the links whose pair is the most frequent of its B id.

    Texts that are null, empty, or not given back whole by both sides have no tokens: zeros
    and an empty digest. Null ids and repeated rows are documents of their own. Extra columns
    are ignored; an empty table gives no rows.
    """
    spark = documents.sparkSession
    rows = aligned(documents, a_path, b_path)
    counts = pair_counts(rows, aligner_of(a_path, b_path).width)
    table = hot_pairs(counts, hot)
    shared = spark.sparkContext.broadcast(
        (table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy().astype(np.int64))
    )
    held = rows.filter("row IS NOT NULL").select(*_DOCUMENT, "a_ids", "b_ids")
    sums = stored(held.mapInArrow(_look_up(a_path, b_path, shared), _SUMS), "alignment-sums")
    rare = sums.filter(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    rare = rare.select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")).join(counts, "pair")
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    total = lambda name, other: (F.col(name) + F.coalesce(other, F.lit(0))).alias(name)
    return sums.join(more, "row", "left").select(
        *_DOCUMENT[1:6], total("n_best", "more_best"), total("count_sum", "more_sum"), "groups_sha256"
    )
