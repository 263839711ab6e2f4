from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, source string, lang string, n_chars long, "
    "key string, score int, component_id string, host string, cell string, fp string, "
    "bin_id string, kept string, spans string, blob string, n_removed string, rule string"
)


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source), with clashing names."""

    def build(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "s", "en", len(r[1] or ""), *["x", 1, *["x"] * 9, "x"])
            for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return build


ODD = [
    (1, None),
    (2, ""),
    (None, "a word"),
    (None, None),
    (3, "same text here"),
    (3, "same text here"),
    (4, "same text here"),
    (5, " \n\t "),
    (6, "éà 漢字 \U0001f600 ſ"),
]


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty texts, ties, repeated rows and a very long text."""
    return make([*ODD, (7, "long " * 30_000 + "tail")])


@pytest.fixture(scope="session")
def empty(make):
    return make([])
