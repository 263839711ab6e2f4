"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens get the log-odds of toxic against other labelled documents under an informative
Dirichlet prior, which follows the tokens' shares in all documents. Tokens that clearly speak
for or against toxicity keep their weight. A document is scanned once, in time linear in its tokens, for all
maximal segments of positive total score. A segment's score is judged by the
extreme-value distribution of such scores in random text of that length (Karlin and
Altschul), and the evidence of all significant segments is calibrated to a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored

# Bound on the labelled rows that the model is fitted on: all of them below it, beyond it
# the ones with the smallest hashes of their ids.
MAX_TRAIN_ROWS = 20_000
PRIOR_STRENGTH = 500.0
# Tokens below this many standard errors count as any other token: with some 10 ** 6
# tokens a lower bound lets chance in.
MIN_Z = 3.3
MAX_WEIGHT = 6.0
SIGNIFICANT = 0.05
# Evidence is bent so that it comes near to this and never reaches it; keeps single documents
# from ruling the curve, and more evidence is still more.
EVIDENCE_CEILING = 40.0
# Distinct tokens that a task counts before it hands them on.
TASK_TOKENS = 500_000
THRESHOLD = 0.3
TOKEN = re.compile(r"[^\W_]+")
# Java's form of the same tokens.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class ToxicityModel:
    """Token weights, the weight of every other token, and the calibration."""

    weights: dict[str, float]
    other: float
    lam: float
    k: float
    slope: float
    offset: float

    def segments(self, text: str) -> list[tuple[float, int, int]]:
        """All maximal segments: (score, first token, token after the last)."""
        return segments(*self._hits(text)[:2], self.other)

    def _hits(self, text: str):
        tokens = TOKEN.findall(text.lower())
        found = np.fromiter(map(self.weights.get, tokens, _ZEROS), np.float64, len(tokens))
        places = np.flatnonzero(found)
        return places, found[places], len(tokens)

    def evidence(self, text: str | None) -> float:
        """Sum over significant segments of the log of 1 / expected number by chance."""
        places, scores, n = self._hits(text or "")
        if not len(places) or scores.max() <= 0:
            return 0.0
        space = math.log(self.k * max(n, 2))
        logs = [self.lam * s - space for s, _, _ in segments(places, scores, self.other)]
        return _summed(logs)

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """Significant segments as (first character, character after the last, p-value)."""
        if not text:
            return []
        # Lower-casing can change lengths, so places are found in the original text.
        spans = [m.span() for m in TOKEN.finditer(text)]
        tokens = [text[a:b].lower() for a, b in spans]
        found = np.array([self.weights.get(t, 0.0) for t in tokens])
        places = np.flatnonzero(found)
        out = []
        for score, a, b in segments(places, found[places], self.other):
            expected = self.k * max(len(tokens), 2) * math.exp(-self.lam * score)
            if expected < SIGNIFICANT:
                out.append((spans[a][0], spans[b - 1][1], -math.expm1(-expected)))
        return sorted(out)

    def score(self, text: str | None) -> float:
        return 1.0 / (1.0 + math.exp(-(self.slope * self.evidence(text) + self.offset)))


class _Zeros:
    """An endless supply of the default for ``map``."""

    def __iter__(self):
        return self

    def __next__(self):
        return 0.0


_ZEROS = _Zeros()


def segments(places, scores, other: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments, by the linear scan of Ruzzo and Tompa.

    ``places`` are the tokens with a weight of their own, ``scores`` these weights; each
    token between them weighs ``other`` (negative). The runs between positive weights are
    taken in one step, so the scan is linear in the positive tokens.
    """
    kept: list[list[float]] = []  # sum before, sum after, first token, token after
    total, at = 0.0, 0
    for place, score in zip(places.tolist(), scores.tolist(), strict=True):
        total += other * (place - at)
        at = place + 1
        if score <= 0:
            total += score
            continue
        left, right, first = total, total + score, place
        total = right
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= left:
                j = int(kept[j][4])
            if j < 0 or kept[j][1] >= right:
                kept.append([left, right, first, at, j])
                break
            left, first = kept[j][0], int(kept[j][2])
            del kept[j:]
    return [(b - a, int(s), int(e)) for a, b, s, e, _ in kept]


def in_training(doc_id: Column) -> Column:
    """False for the held-out quarter, whose labels are never looked at."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(
    documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS
) -> DataFrame:
    """(toxic, text, weigh) of about ``max_rows`` labelled rows outside the held-out ones.

    Three quarters of them give token weights (``weigh``), the others the calibration.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(in_training(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = max_rows / max(known.count(), max_rows)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The chosen ids are bounded by max_rows, whatever the size of the labels.
    weigh = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) > 0
    return rows.join(F.broadcast(chosen), "doc_id").select("toxic", "text", weigh.alias("weigh"))


def _occurrences(batches):
    counts: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update(set(TOKEN.findall(text.lower())))
            if len(counts) > TASK_TOKENS:
                yield _listed(counts)
                counts.clear()
    yield _listed(counts)


def _listed(counts: Counter) -> pd.DataFrame:
    return pd.DataFrame({"token": pd.Series(list(counts), dtype="object"), "seen": pd.Series(list(counts.values()), dtype="int64")})


def corpus_counts(documents: DataFrame) -> DataFrame:
    """(token, seen): how many of all documents have the token."""
    texts = documents.select("text").filter("text IS NOT NULL AND text != ''")
    found = texts.mapInPandas(_occurrences, "token string, seen long")
    return found.groupBy("token").agg(F.sum("seen").alias("seen"))


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, toxic documents, other documents) of the training rows."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN_PATTERN), F.lit(0)))
    return (
        rows.select("toxic", F.explode(tokens).alias("token"))
        .groupBy("token")
        .agg(
            F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("toxic") > 0, 0).otherwise(1)).alias("good"),
        )
    )


def log_odds(counts: DataFrame, prior: float = PRIOR_STRENGTH) -> DataFrame:
    """(token, delta, z): log-odds with a Dirichlet prior in proportion to ``seen``."""
    sums = counts.agg(*[F.sum(name).alias(name) for name in ("bad", "good", "seen")]).first()
    all_bad, all_good, all_seen = (float(sums[name] or 0) for name in ("bad", "good", "seen"))
    everything = all_bad + all_good
    # The prior of a token: one document and its share of ``prior`` documents, dealt to the
    # two kinds by their size, so that it favours neither.
    each = F.lit(1.0) + F.lit(prior) * F.col("seen") / max(all_seen, 1.0)
    bad = F.col("bad") + each * all_bad / everything
    good = F.col("good") + each * all_good / everything
    delta = F.log(bad / (all_bad + prior - bad)) - F.log(
        good / (all_good + prior - good)
    )
    return counts.select("token", delta.alias("delta"), (delta / F.sqrt(1 / bad + 1 / good)).alias("z"))


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> ToxicityModel:
    """Fit on labelled rows outside the held-out quarter; see the bound above.

    Without usable labels of both kinds every document gets the score of the prior.
    """
    rows = stored(training_rows(documents, labels, max_rows), "training-rows")
    counts = token_counts(rows.filter("weigh"))
    # Few tokens are cut differently here and there; they have their own count.
    seen = F.coalesce("seen", F.col("bad") + F.col("good")).alias("seen")
    counts = counts.join(corpus_counts(documents), "token", "left").select("token", "bad", "good", seen)
    counts = stored(counts, "token-counts")
    # Bounded by the tokens of the training rows.
    odds = log_odds(counts).filter(F.abs("z") >= MIN_Z).collect()
    weights = {r["token"]: max(-MAX_WEIGHT, min(r["delta"], MAX_WEIGHT)) for r in odds}
    draft = ToxicityModel(weights, -1.0, 1.0, 1.0, 1.0, 0.0)
    rest = rows.filter("NOT weigh").select("toxic", "text")
    seen = rest.mapInPandas(_tally(draft), _TALLY).collect()
    return calibrated(draft, seen)


_TALLY = "toxic int, tokens long, scores array<double>, places array<long>"


def _tally(draft: ToxicityModel):
    def run(batches):
        for batch in batches:
            found = [draft._hits(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "toxic": batch["toxic"].astype("int32"),
                    "tokens": [n for _, _, n in found],
                    "scores": [s for _, s, _ in found],
                    "places": [p for p, _, _ in found],
                }
            )

    return run


def calibrated(draft: ToxicityModel, seen) -> ToxicityModel:
    """Set the drift, the extreme-value parameters and the final logistic curve.

    ``other`` makes the mean weight in clean text clearly negative. ``lam`` solves
    E[exp(lam * weight)] = 1 there, as in the theory. ``k`` is taken from that theory's
    bound: the share of clean tokens at which a segment can begin.
    """
    clean = [r for r in seen if not r["toxic"]]
    tokens = sum(r["tokens"] for r in clean) + 1
    scores = np.concatenate([np.array(r["scores"], float) for r in clean] + [np.zeros(1)])
    scores = scores[scores != 0]
    rising = scores[scores > 0]
    other = -max(0.1, 2.0 * float(rising.sum()) / tokens)
    k = max(len(rising), 1) / (tokens + 1)
    if len(rising):
        lam = _root(scores, len(scores) / (tokens + 1), other)
    else:
        lam = _root(np.array([1.0]), k, other)
    labelled = [
        (_evidence(r, other, lam, k), bool(r["toxic"]))
        for r in seen
    ]
    slope, offset = _logistic(labelled)
    return ToxicityModel(draft.weights, other, lam, k, slope, offset)


def _evidence(row, other: float, lam: float, k: float) -> float:
    places, scores = np.array(row["places"], int), np.array(row["scores"], float)
    space = math.log(k * max(row["tokens"], 2))
    logs = [lam * s - space for s, _, _ in segments(places, scores, other)]
    return _summed(logs)


def _summed(logs: list[float]) -> float:
    significant = sum(x for x in logs if x > -math.log(SIGNIFICANT))
    return float(significant) * EVIDENCE_CEILING / (EVIDENCE_CEILING + float(significant))


def _root(scores: np.ndarray, share: float, other: float) -> float:
    """The positive solution of E[exp(lam * weight)] = 1, by bisection."""

    def excess(lam: float) -> float:
        return share * float(np.exp(lam * scores).mean()) + (1 - share) * math.exp(lam * other) - 1

    high = 1e-3
    while excess(high) < 0 and high < 64:
        high *= 2
    low = high / 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def _logistic(labelled: list[tuple[float, bool]]) -> tuple[float, float]:
    """Slope and offset of P(toxic | evidence), with one added row of each kind."""
    x = np.array([0.0, *[e for e, _ in labelled], EVIDENCE_CEILING])
    y = np.array([0.0, *[t for _, t in labelled], 1.0], float)
    slope, offset = 0.0, math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    ridge = 1e-2  # keeps the curve finite where the classes are apart

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((np.logaddexp(0, z) - y * z).sum() + ridge * a * a / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
        w = p * (1 - p)
        g = np.array([((y - p) * x).sum() - ridge * slope, (y - p).sum()])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        while loss(slope + step[0], offset + step[1]) > loss(slope, offset) and np.abs(step).max() > 1e-9:
            step /= 2
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(slope), 1e-6), float(offset)


def toxicity_score(spark, model: ToxicityModel):
    """The model as a column function of a text; the bounded model is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score, na_action=None).astype("float64")

    return score


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    A null or empty text has no evidence and gets the score of a clean text. Null ids are
    scored and not held out. Repeated rows and very long texts are scored whole, each on
    its own; extra columns are ignored; an empty table gives no rows.
    """
    model = fit(documents, labels)
    score = toxicity_score(documents.sparkSession, model)
    rows = documents.select("doc_id", score(F.coalesce("text", F.lit(""))).alias("score"))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns, whatever their names.

    Null and empty texts have no evidence. Rows without an id and repeated rows are judged
    by their texts, very long ones whole. An empty table gives no rows.
    """
    model = fit(documents, labels)
    score = toxicity_score(documents.sparkSession, model)
    return documents.filter(score(F.coalesce("text", F.lit(""))) < THRESHOLD)
