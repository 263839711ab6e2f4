from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import token_alignment as op
from tests.llm.conftest import ODD

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="session")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain_tokens(text, libraries):
    """(id, bytes) of each token on both sides; nothing where the bytes are not those of the text."""
    if not text:
        return [], []
    a, b = libraries
    alphabet = op.byte_alphabet()
    left = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        byte = len(piece) == 6 and piece.startswith("<0x")
        right.append((i, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    return (left, right) if all(b"".join(t for _, t in side) == raw for side in (left, right)) else ([], [])


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(rows, libraries):
    held, counts = [], Counter()
    for doc_id, text in rows:
        a, b = map(spans, plain_tokens(text, libraries))
        links, first = [], 0
        for i, x, y in a:
            while first < len(b) and b[first][2] <= x:
                first += 1
            k = first
            while k < len(b) and b[k][1] < y:
                links.append((i, b[k][0]))
                k += 1
        counts.update(links)
        ends = sorted({y for *_, y in a} & {y for *_, y in b})
        groups = [
            "|".join(",".join(str(i) for i, _, y in side if x < y <= end) for side in (a, b))
            for x, end in zip([0, *ends], ends, strict=False)
        ]
        held.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return sorted(
        (
            (d, n_a, n_b, n, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if links else "")
            for d, n_a, n_b, n, links, text in held
        ),
        key=str,
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def texts():
    draw = random.Random(1)
    signs = [" ", " ", "  ", "\n", "\t", " ", "\x1c", " ", "▁", "'s", "'", "é", "é", "漢", "\U0001f600", "ﬁ",
             "The", "ing", "token", "izer", "12", "3", "...", "<s>", "</s>", "<|endoftext|>", "<0x41>", "<unk>", "\x00"]
    return ["".join(draw.choices(signs, k=draw.randrange(1, 25))) for _ in range(400)]


def test_pieces_have_the_ids_of_whole_texts(libraries):
    aligner = op.Aligner(*PATHS)
    own = texts()
    for text, (a, b) in zip(own, aligner.encode(own), strict=True):
        left, right = plain_tokens(text, libraries)
        assert (a.tolist(), b.tolist()) == ([i for i, _ in left], [i for i, _ in right]), text


@pytest.mark.parametrize(("hot", "group"), [(1 << 19, 1_000_000), (40, 700), (0, 1)])
def test_counts_and_groups_equal_brute_force(make, monkeypatch, libraries, hot, group):
    monkeypatch.setattr(op, "GROUP_BYTES", group)
    monkeypatch.setattr(op, "TASK_PAIRS", group)
    rows = [*ODD, *enumerate(texts(), 100), (7, "long words " * 3000)]
    assert found(op.alignment(make(rows), *PATHS, hot=hot)) == brute(rows, libraries)


def test_groups_as_written():
    aligner = op.Aligner(*PATHS)
    columns, pairs, times = aligner.align(["Hello worlds", None, ""])
    assert [c.tolist() if hasattr(c, "tolist") else c for c in columns[:4]] == [[2, 0, 0], [2, 0, 0], [2, 0, 0], [2, 0, 0]]
    a, b = aligner.encode(["Hello worlds"])[0].__iter__()
    text = ";".join(f"{x}|{y}" for x, y in zip(a, b, strict=True))
    assert columns[4] == [hashlib.sha256(text.encode()).hexdigest(), "", ""]
    assert times.tolist() == [1, 1] and len(pairs) == 2


def test_no_rows(empty):
    assert op.alignment(empty, *PATHS).collect() == []
