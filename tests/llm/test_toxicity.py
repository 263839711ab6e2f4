from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import toxicity as op
from tests.llm.conftest import ODD

BAD = ["vile", "awful", "dreck", "scurvy"]


def brute_segments(weights):
    """All maximal segments by their definition, found from the best one outwards."""
    def split(low, high):
        best = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += weights[b]
                if total > 0 and (best is None or total > best[0] + 1e-12 or (
                    abs(total - best[0]) <= 1e-12 and b + 1 - a < best[2] - best[1])):
                    best = (total, a, b + 1)
        if best is None:
            return []
        return split(low, best[1]) + [best] + split(best[2], high)

    return split(0, len(weights))


@pytest.mark.parametrize("seed", range(20))
def test_segments_are_the_maximal_ones(seed):
    draw = random.Random(seed)
    weights = [draw.choice([-0.5, -0.5, -0.5, draw.uniform(-2, 3)]) for _ in range(30)]
    places = np.array([i for i, w in enumerate(weights) if w != -0.5])
    scores = np.array([weights[i] for i in places])
    got = [(round(s, 9), a, b) for s, a, b in op.segments(places, scores, -0.5)]
    assert got == [(round(s, 9), a, b) for s, a, b in brute_segments(weights)]


@pytest.fixture(scope="module")
def corpus(spark, make):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [*ODD], [(1, 0), (3, 0), (None, 1), (5, None), (3, 0)]
    for i in range(20, 820):
        text, toxic = [draw.choice(words) for _ in range(60)], i % 8 == 0
        if toxic:
            for _ in range(4):
                text.insert(draw.randrange(60), draw.choice(BAD))
        rows.append((i, " ".join(text).title()))
        labels.append((i, int(toxic)))
    rows.append((900, "clean words " * 20_000 + " ".join(BAD * 3) + " clean" * 20_000))
    return make(rows), spark.createDataFrame(labels, "doc_id long, toxic int"), rows


def test_held_out_accuracy(corpus):
    documents, labels, rows = corpus
    out = op.scored(documents, labels).collect()
    assert len(out) == len(rows)
    truth = dict(map(tuple, labels.filter("doc_id >= 20").collect()))
    tested = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(tested) > 150
    assert all(r["predicted"] == truth[r["doc_id"]] for r in tested)
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        want = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == want
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[900]["predicted"] == 1 and by_id[1]["predicted"] == by_id[2]["predicted"] == 0
    kept = op.without_toxic(documents, labels)
    assert kept.columns == documents.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(
        (r["doc_id"] for r in out if not r["predicted"]), key=str
    )


def test_held_out_labels_change_nothing(spark, corpus):
    documents, labels, _ = corpus
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    assert op.fit(documents, labels) == op.fit(documents, flipped)


def test_passages_are_found_in_place(corpus):
    documents, labels, rows = corpus
    model = op.fit(documents, labels)
    text = rows[-1][1]
    (start, end, p), = model.passages(text)
    assert text[start:end] == " ".join(BAD * 3) and 0 <= p < 1e-3
    assert model.passages(None) == [] and model.score(None) == model.score("")


def test_calibration_solves_the_equation():
    scores = np.array([3.0, 2.0, 5.0])
    lam = op._root(scores, 0.01, -0.1)
    assert 0.01 * np.exp(lam * scores).mean() + 0.99 * math.exp(-0.1 * lam) == pytest.approx(1)


def test_without_labels_and_rows(spark, make, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = op.scored(make(ODD), none).collect()
    assert len(out) == len(ODD) and len({r["score"] for r in out}) == 1
    assert op.scored(empty, none).collect() == []


def plain_fit(rows, labels, chosen, weigh):
    """The model from its definition: counts, log-odds, drift, root and logistic curve, one by one."""
    tokens = lambda text: re.findall(r"[^\W_]+", (text or "").lower())
    toxic = {}
    for doc_id, label in labels:
        if doc_id in chosen and label is not None:
            toxic[doc_id] = max(label, toxic.get(doc_id, 0))
    seen, bad, good = Counter(), Counter(), Counter()
    for doc_id, text in rows:
        own = set(tokens(text))
        seen.update(own)
        if doc_id in toxic and weigh[doc_id]:
            (bad if toxic[doc_id] else good).update(own)
    vocabulary = set(bad) | set(good)
    all_bad, all_good, all_seen = sum(bad.values()), sum(good.values()), sum(seen[t] for t in vocabulary)
    weights = {}
    for t in vocabulary:
        each = 1 + op.PRIOR_STRENGTH * seen[t] / all_seen
        b = bad[t] + each * all_bad / (all_bad + all_good)
        g = good[t] + each * all_good / (all_bad + all_good)
        delta = math.log(b / (all_bad + op.PRIOR_STRENGTH - b)) - math.log(g / (all_good + op.PRIOR_STRENGTH - g))
        if abs(delta / math.sqrt(1 / b + 1 / g)) >= op.MIN_Z:
            weights[t] = min(max(delta, -6), 6)
    rest = [(tokens(text), toxic[i]) for i, text in rows if i in toxic and not weigh[i]]
    clean = [weights.get(t, 0) for words, label in rest if not label for t in words]
    rising = [w for w in clean if w > 0]
    other = -max(0.1, 2 * sum(rising) / (len(clean) + 1))
    known = [w for w in clean if w]
    share = len(known) / (len(clean) + 2)
    k = max(len(rising), 1) / (len(clean) + 2)
    excess = lambda x: share * sum(math.exp(x * w) for w in known) / len(known) + (1 - share) * math.exp(x * other) - 1
    low = high = 1e-6
    while excess(high) < 0:
        low, high = high, high * 1.5
    for _ in range(200):
        low, high = ((low + high) / 2, high) if excess((low + high) / 2) < 0 else (low, (low + high) / 2)

    def evidence(text):
        words = tokens(text)
        scores = [weights.get(t, 0) or other for t in words]
        logs = [low * s - math.log(k * max(len(words), 2)) for s, _, _ in brute_segments(scores)]
        x = sum(v for v in logs if v > -math.log(0.05))
        return x * 40 / (40 + x)

    points = [(0, 0), (40, 1), *[(evidence(" ".join(words)), label) for words, label in rest]]
    return weights, evidence, points


def test_fit_equals_plain_python(spark, make):
    draw = random.Random(3)
    words, kind = [f"w{i}" for i in range(60)], ["fine", "lovely", "thanks"]
    rows, labels = [(1, None), (None, "vile fine")], [(2, None), (1, 0)]
    for i in range(10, 410):
        text, toxic = draw.choices(words, k=25), i % 4 == 0
        for _ in range(3):
            text.insert(draw.randrange(25), draw.choice(BAD if toxic or draw.random() < 0.02 else kind))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    documents, known = make(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    training = op.training_rows(documents.withColumn("text", op.F.col("doc_id").cast("string")), known).collect()
    weigh = {int(r["text"]): r["weigh"] for r in training}
    assert {i for i in weigh if zlib.crc32(str(i).encode()) % 4 == 2} == set() and len(weigh) > 250
    model = op.fit(documents, known)
    weights, evidence, points = plain_fit(rows, labels, set(weigh), weigh)
    assert model.weights == pytest.approx(weights)
    assert set(BAD) <= {t for t, w in weights.items() if w > 0} and set(kind) <= {t for t, w in weights.items() if w < 0}
    for _, text in rows[::9]:
        assert model.evidence(text) == pytest.approx(evidence(text), rel=1e-6, abs=1e-6)

    def loss(a, b):
        return sum(np.logaddexp(0, a * x + b) - y * (a * x + b) for x, y in points) + 0.005 * a * a

    best = loss(model.slope, model.offset)
    for da in (-0.02, 0, 0.02):
        for db in (-0.02, 0, 0.02):
            assert loss(model.slope + da, model.offset + db) >= best - 1e-9


def test_more_evidence_is_always_more(corpus):
    documents, labels, _ = corpus
    model = op.fit(documents, labels)
    scores = [model.evidence(" ".join(BAD * n)) for n in (1, 5, 20, 100, 400)]
    assert scores == sorted(set(scores)) and scores[-1] < op.EVIDENCE_CEILING
