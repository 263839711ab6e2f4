"""The registered queries against their SQL twins, and the pipeline against plain Python."""

from __future__ import annotations

import importlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tallyloom.llm import queries
from tallyloom.llm import decontaminate, line_dedup, packing, toxicity
from tests.compare import connect, mismatch
from tests.llm import (
    test_decontaminate,
    test_line_dedup,
    test_packing,
    test_simhash,
    test_token_alignment,
    test_token_files,
)


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert mismatch(queries.QUERIES[name](spark, sf_dir), connection, queries.ORACLES[name]) is None


def test_operators_are_registered():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES]
    assert numbers == sorted({*range(1, 11), *numbers})
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


def test_queries_without_sql_equal_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.QUERIES["op8_simhash"](spark, sf_dir).collect()
    assert sorted(
        (r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in got
    ) == sorted(test_simhash.brute(docs))
    assert {len(r["fingerprint"]) for r in got} == {16}


def _documents(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_tiling_query_equals_brute_force(spark, sf_dir):
    items = [
        (r["item_id"], decontaminate.tokens_of(r["text"]))
        for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    ]
    grams = [(i, t, {tuple(t[k : k + 5]) for k in range(len(t) - 4)}) for i, t in items]
    want = set()
    for doc_id, text in _documents(spark, sf_dir):
        tokens = decontaminate.tokens_of(text)
        own = {tuple(tokens[k : k + 5]) for k in range(len(tokens) - 4)}
        for item_id, item, seeds in grams:
            if own & seeds:
                tiles = test_decontaminate.brute_tiles(item, tokens, 5)
                covered = sum(n for _, _, n in tiles) / len(item)
                if covered >= decontaminate.MIN_COVERAGE:
                    want.add((doc_id, item_id, round(covered, 9), len(tiles)))
    got = queries.QUERIES["op3_string_tiling"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"], round(r["coverage"], 9), r["n_tiles"]) for r in got} == want
    assert want and len(got) == len(want)


def test_packing_query_places_every_token(spark, sf_dir):
    lengths = [
        (doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) + 1)
        for doc_id, text in _documents(spark, sf_dir)
    ]
    rows = queries.QUERIES["op4_best_fit_packing"](spark, sf_dir).collect()
    cost = test_packing.check(rows, lengths, packing.CAPACITIES)
    assert cost <= 1.02 * test_packing.best_fit_cost(lengths, packing.CAPACITIES, packing.CAPACITIES)


def test_toxicity_query_scores_whole_texts(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op6_toxic_segments"](spark, sf_dir).collect()}
    assert got == pytest.approx({doc_id: model.score(text) for doc_id, text in _documents(spark, sf_dir)})


def test_toxicity_query_is_accurate_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    tested = queries.QUERIES["op6_toxic_segments"](spark, sf_dir).filter("held_out").join(labels, "doc_id")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in tested.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8 and n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.9


def test_token_query_equals_the_tokenizer(spark, sf_dir):
    tokenizer = Tokenizer.from_file(test_token_files.PATH)
    got = queries.QUERIES["op9_token_files"](spark, sf_dir).collect()
    want = test_token_files.brute(_documents(spark, sf_dir), tokenizer)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_alignment_query_equals_brute_force(spark, sf_dir):
    tokenizer = Tokenizer.from_file(test_token_alignment.PATHS[0])
    tokenizer.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_file=test_token_alignment.PATHS[1])
    want = test_token_alignment.brute(_documents(spark, sf_dir), (tokenizer, pieces))
    assert test_token_alignment.found(queries.QUERIES["op12_token_alignment"](spark, sf_dir)) == want


def test_pipeline_equals_plain_python(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [
        decontaminate.tokens_of(r["text"])
        for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    ]
    model = toxicity.fit(documents, labels)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    rows = [r for r in rows if model.score(r[1]) < toxicity.THRESHOLD]
    lines = test_line_dedup.brute(rows, line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    texts = [(doc_id, text) for doc_id, text, _, _ in lines]
    stays = {c for _, c in test_simhash.copies(texts)}
    texts = [r for r in texts if r[0] in stays]
    grams = [{tuple(item[i : i + 5]) for i in range(len(item) - 4)} for item in items]

    def clean(text):
        tokens = decontaminate.tokens_of(text)
        own = {tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)}
        # Coverage is a matter of tiles only where an item shares most of its runs.
        return not any(g and len(own & g) / len(g) > 0.5 for g in grams)

    want = {doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for doc_id, t in texts if clean(t)}
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r["doc_id"]] += r["n_tokens"]
    assert got == want and len(want) < len(rows)


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir, odd, empty):
    plain = [c for c in ("doc_id", "text", "lang", "source", "n_chars")]
    for frame in (odd.select(*plain, "key", "score"), empty):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select(F.sum("n_tokens")).count() == 1


def test_nothing_else_imports_the_subpackage():
    root = importlib.import_module("tallyloom").__path__[0]
    from pathlib import Path

    for path in Path(root).rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "tallyloom.llm" not in path.read_text()
