"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are dealt out by ranges of their ids, so that shard after shard holds them in
ascending order. A shard has three files: the ids of all its documents as little-endian
unsigned integers (16 bits where the vocabulary fits, else 32), the position of each
document's first id as unsigned 64-bit integers with the shard's total at the end, and
the document ids as signed 64-bit integers. A shard's base is the sum of the totals
before it. Tasks write under names of their own attempt and report them, so that a lost
or repeated attempt leaves files that nobody reads.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.session import scratch_dir, stored

END_ID = 1
# Words whose ids a task remembers.
CACHE_WORDS = 800_000
# Texts are encoded in groups of so many documents.
GROUP_DOCS = 1_000
STOPS = re.compile(rb"(?<=[a-z])([.,])(?=[\t-\r ])")
MANIFEST = "shard int, name string, n_docs long, n_tokens long"
READ_BACK = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"


class TextEncoder:
    """Whole texts to ids, by the ids of their words.

    The tokenizer must ignore case and treat spaces only as ends of words, and must split
    letters from a full stop or comma after them, so that a text's ids are those of its
    words in a row; ``check`` tells whether it does on a text. Texts that may hold special
    tokens keep their case.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # An id is at most the vocabulary's size.
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._known: dict[bytes, bytes] = {}

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def check(self, text: str) -> bool:
        return self.plain(text) == self.encode([text])[0][:-1].tolist()

    def _learn(self, words: list[bytes]) -> None:
        """Add the ids of words; lower-case ASCII letters need no normalising or splitting."""
        known, code, other = self._known, self.dtype.char, []
        tokenize = self.tokenizer.model.tokenize
        for word in words:
            if word.isalpha() and word.islower():
                known[word] = array(code, [t.id for t in tokenize(word.decode())]).tobytes()
            else:
                other.append(word)
        for first in range(0, len(other), 10_000):
            part = other[first : first + 10_000]
            texts = [word.decode("utf-8") for word in part]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for word, one in zip(part, found, strict=True):
                known[word] = array(code, one.ids).tobytes()

    def encode(self, texts: list[str | None], end_id: int = END_ID) -> list[np.ndarray]:
        """Ids of each text and the end mark."""
        split = [_words(text) for text in texts]
        known = self._known
        new = [w for w in set(chain.from_iterable(split)) if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = list(set(chain.from_iterable(split)))
        self._learn(new)
        end = np.array([end_id], self.dtype).tobytes()
        get = known.__getitem__
        coded = [np.frombuffer(b"".join([*map(get, words), end]), self.dtype) for words in split]
        if len(known) > CACHE_WORDS:  # one batch alone may hold more
            known.clear()
        return coded


_ENCODERS: dict[str, TextEncoder] = {}


def encoder_of(path: str) -> TextEncoder:
    """One encoder per worker process, so that tasks share the words they have seen."""
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def _words(text: str | None) -> list[bytes]:
    if not text:
        return []
    raw = text.encode("utf-8")
    if b"<|" not in raw:
        # NFC joins letters with marks from U+0300 to U+036F (first byte 0xCC or 0xCD), some
        # only if they are small. Beside such marks only words of ASCII are lower-cased here.
        if b"\xcc" in raw or b"\xcd" in raw:
            raw = b" ".join([w.lower() if w.isascii() else w for w in raw.split()])
        else:
            raw = raw.lower()
        raw = STOPS.sub(rb" \1", raw)
    return raw.split()


def _place(folder: str):
    """File system and path of a shared folder, given as a path or an address."""
    if urlparse(folder).scheme:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def write_shards(documents: DataFrame, tokenizer_path: str, folder: str) -> DataFrame:
    """Write all documents below ``folder``; returns (shard, name, n_docs, n_tokens, base).

    Documents of equal id lie in the order of a hash of their texts, so that even an id of
    very many rows is dealt to several shards; null ids come first and are written as the
    least 64-bit integer. Null and empty texts have the end mark only.
    """
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    rows = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    written = rows.drop("_tie").mapInArrow(_writer(tokenizer_path, folder), MANIFEST)
    manifest = stored(written, "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard: the prefix sums that make the shards one sequence.
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


NO_ID = np.iinfo(np.int64).min


def _writer(tokenizer_path: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, store, root = encoder_of(tokenizer_path), *_place(folder)
        store.create_dir(root, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        at, docs = 0, 0
        with (
            store.open_output_stream(f"{root}/{name}.ids") as ids_file,
            store.open_output_stream(f"{root}/{name}.offsets") as offsets_file,
            store.open_output_stream(f"{root}/{name}.docs") as docs_file,
        ):
            for batch in batches:
                doc_ids = batch.column("doc_id").fill_null(int(NO_ID)).to_numpy()
                starts = np.empty(len(doc_ids), "<u8")
                for first in range(0, len(doc_ids), GROUP_DOCS):
                    texts = batch.column("text")[first : first + GROUP_DOCS].to_pylist()
                    for i, ids in enumerate(encoder.encode(texts), first):
                        starts[i] = at
                        at += len(ids)
                        ids_file.write(ids.tobytes())
                docs += len(doc_ids)
                offsets_file.write(starts.tobytes())
                docs_file.write(doc_ids.astype("<i8").tobytes())
            offsets_file.write(np.array([at], "<u8").tobytes())
        if docs:
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "name": pa.array([name]),
                    "n_docs": pa.array([docs], pa.int64()),
                    "n_tokens": pa.array([at], pa.int64()),
                }
            )

    return run


def mapped(store, path: str, dtype) -> np.ndarray:
    """A file's integers, memory-mapped where the folder is mounted, else read."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), dtype)


def read_shards(manifest: DataFrame, folder: str, id_bits: int) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 and its shard.

    The checksum is that of the ids as little-endian unsigned 32-bit integers.
    """
    # A task per shard: the manifest has few bytes, but the shards have many.
    shards = manifest.select("shard", "name", "base").repartition(max(1, manifest.count()))
    return shards.mapInArrow(_reader(folder, np.dtype(f"<u{id_bits // 8}")), READ_BACK)


def _reader(folder: str, dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(folder)
        for batch in batches:
            for shard, name, base in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = mapped(store, f"{root}/{name}.ids", dtype)
                offsets = mapped(store, f"{root}/{name}.offsets", "<u8")
                doc_ids = mapped(store, f"{root}/{name}.docs", "<i8")
                for first in range(0, len(doc_ids), 10_000):
                    part = np.array(doc_ids[first : first + 10_000])
                    cuts = np.array(offsets[first : first + len(part) + 1]).astype(np.int64)
                    sums = [
                        zlib.crc32(ids[a:b].astype("<u4").tobytes())
                        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(part, pa.int64(), mask=part == NO_ID),
                            "start": pa.array(cuts[:-1] + base),
                            "n_tokens": pa.array(np.diff(cuts)),
                            "ids_crc32": pa.array(sums, pa.int64()),
                            "shard": pa.array(np.full(len(part), shard), pa.int32()),
                        }
                    )

    return run


def token_files(documents: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write ``documents`` and read them back; see ``write_shards`` and ``read_shards``.

    Repeated rows are written each on its own; extra columns are ignored; an empty table
    writes no shard that is read and gives no rows.
    """
    folder = folder or scratch_dir(documents.sparkSession, "token-files")
    bits = 8 * TextEncoder(tokenizer_path).dtype.itemsize
    return read_shards(write_shards(documents, tokenizer_path, folder), folder, bits)
