from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import token_files as op
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


TEXTS = [
    "Hello, World. It's <|endoftext|> fine", "Á. B\n\x1cc\x85d", "Ähnlich, überall. Σας", "<|ENDOFTEXT|> x",
    "don't. we'll, İ. ...", "1234 5,6. 7", "\U0001f600\U0001f600, ﻿", "x" * 500 + ". end",
]


def test_words_have_the_ids_of_the_text():
    encoder = op.TextEncoder(PATH)
    draw = random.Random(1)
    signs = list("aAbÉéΣς́ \t\n\x0b\x1c\x85  ＜<|>'s12!.,ſKİß　漢字") + ["<|endoftext|>", "'ll", ". ", ", "]
    for text in TEXTS + ["".join(draw.choice(signs) for _ in range(draw.randint(0, 25))) for _ in range(2000)]:
        assert encoder.check(text), text


def test_capitals_with_marks_have_the_ids_of_the_text():
    encoder = op.TextEncoder(PATH)
    draw = random.Random(2)
    letters = ["H\u0331", "T\u0308", "W\u030a", "Y\u030a", "J\u030c"]
    signs = letters + ["a", "B", "\u0331", "\u030c", ". ", ", ", " ", "\n", "É", "T", "J"]
    for text in letters + ["".join(draw.choice(signs) for _ in range(draw.randint(0, 25))) for _ in range(2000)]:
        assert encoder.check(text), text


def test_cache_may_be_cleared(monkeypatch, tokenizer):
    monkeypatch.setattr(op, "CACHE_WORDS", 3)
    encoder = op.TextEncoder(PATH)
    texts = ["a b c d e f", "a", None, "", "g h i"]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def brute(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(make, tokenizer):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(TEXTS)], *[(-i, f"text {i}") for i in range(50)]]
    rows.append((50, "many words " * 20_000))
    out = op.token_files(make(rows), PATH).collect()
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in out if r["doc_id"] is not None)
    want = brute(rows, tokenizer)
    assert got == sorted(r for r in want if r[0] is not None)
    nulls = sorted((r["start"], r["n_tokens"]) for r in out if r["doc_id"] is None)
    assert sorted(n for _, n in nulls) == sorted(r[2] for r in want if r[0] is None)
    assert [start for start, _ in nulls] == [0, nulls[0][1]]


def test_files_are_flat_integers(spark, make, tokenizer, tmp_path):
    rows = [(i, f"document number {i}") for i in range(40)]
    manifest = op.write_shards(make(rows), PATH, str(tmp_path)).orderBy("shard").collect()
    ids = np.concatenate([np.memmap(tmp_path / f"{m['name']}.ids", "<u2", "r") for m in manifest])
    want = [i for _, t in rows for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 1]]
    assert ids.tolist() == want
    at = 0
    for m in manifest:
        offsets = np.memmap(tmp_path / f"{m['name']}.offsets", "<u8", "r")
        assert m["base"] == at and offsets[-1] == m["n_tokens"] and len(offsets) == m["n_docs"] + 1
        at += m["n_tokens"]


def test_no_rows(empty):
    assert op.token_files(empty, PATH).collect() == []
