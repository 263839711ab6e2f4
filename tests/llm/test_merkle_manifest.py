from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import merkle_manifest as op

FIELDS = ("doc_id", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    texts = [None if v is None else str(v) for v in values]
    return digest(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(leaves, fanout):
    """Root, and each leaf's (place, others) from the bottom up."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for way, k in zip(ways, at, strict=True):
            run, place = runs[k // fanout], k % fanout
            way.append((place, "".join(run[:place] + run[place + 1 :])))
        at = [k // fanout for k in at]
        level = [digest(*run) for run in runs]
    return level[0], ways


def brute(rows, fanout):
    """(doc_id, leaf, slot, subroot, root, proof) per row of (doc_id, text, lang)."""
    groups = {}
    for doc_id, text, lang in rows:
        groups.setdefault(lang, []).append((doc_id, leaf((doc_id, text))))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = tree([h for _, h in groups[name]], fanout)
    root, above = tree([trees[name][0] for name in names], fanout)
    return sorted(
        (
            (doc_id, own, slot, trees[name][0], root, tuple(trees[name][1][slot] + above[n]))
            for n, name in enumerate(names)
            for slot, (doc_id, own) in enumerate(groups[name])
        ),
        key=str,
    )


def found(frame):
    return sorted(
        (
            (r["doc_id"], r["leaf"], r["slot"], r["subroot"], r["root"], tuple((s["place"], s["others"]) for s in r["proof"]))
            for r in frame.collect()
        ),
        key=str,
    )


def frame_of(spark, rows):
    full = [(*r, "x", 1, "x", 2) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, grp string, slot int, digest string, rank int")


def drawn():
    draw = random.Random(1)
    rows = [(draw.choice([None, None, draw.randrange(-3, 90), draw.getrandbits(63), -draw.getrandbits(60)]),
             draw.choice(["a", "b", "", None, "é" * draw.randrange(9)]),
             draw.choice([None, "", "en", "en", "en", "é", "=", "zz"])) for _ in range(700)]
    rows += [(7, "one", "solo"), (-(1 << 63), "least", "en"), ((1 << 63) - 1, "most", "en"), (1, "long " * 40_000, "en")]
    return rows + [(5, f"text {n}", "en") for n in range(150)] + [(6, "equal", "en")] * 90


@pytest.mark.parametrize(("fanout", "slots", "run"), [(2, 128, 65_536), (2, 4, 7), (3, 9, 65_536), (200, 128, 20)])
def test_trees_equal_plain_python(spark, monkeypatch, fanout, slots, run):
    monkeypatch.setattr(op, "ARRAY_SLOTS", slots)
    monkeypatch.setattr(op, "RUN_COPIES", run)
    rows = drawn()
    assert found(op.manifest(frame_of(spark, rows), fields=FIELDS, fanout=fanout)) == brute(rows, fanout)


def test_proofs_fold_to_the_root_and_false_claims_do_not(spark):
    rows = drawn()
    claim = F.when(F.col("doc_id") % 2 == 0, op.leaf_of([F.col("doc_id"), F.concat("text", F.lit("!"))]))
    out = op.manifest(frame_of(spark, rows), fields=FIELDS, claim=claim)
    out = out.withColumn("honest", op.folded(F.col("leaf"), F.col("proof")) == F.col("root"))
    out = out.withColumn("held", op.folded(F.coalesce("claim", "leaf"), F.col("proof")) == F.col("root"))
    out = out.withColumn("hash", op.siblings_of(F.col("proof"))).collect()
    assert all(r["honest"] for r in out) and len(out) == len(rows)
    assert all(r["held"] == (r["claim"] is None or r["claim"] == r["leaf"]) for r in out)
    assert 0 < sum(r["held"] for r in out) < len(out)
    assert all(r["hash"] == digest(*[s["others"] for s in r["proof"]]) for r in out)


def test_ranks_count_the_rows_before(spark):
    draw = random.Random(2)
    ids = sorted({draw.getrandbits(draw.choice([7, 20, 40, 63])) * draw.choice([1, -1]) for _ in range(600)})
    rows = [("g", None, 4)] + [("g", i, draw.choice([1, 1, 1, 5])) for i in ids] + [("h", 3, 2), ("h", 9, 1)]
    out = op.ranked(spark.createDataFrame(rows, "grp string, id long, rows long")).collect()
    want, before = {}, {}
    for grp, i, n in rows:
        want[grp, i] = before.get(grp, 0)
        before[grp] = want[grp, i] + n
    assert {(r["grp"], r["id"]): r["rank"] for r in out} == want


def test_odd_rows_and_none(odd, empty):
    assert op.manifest(empty).collect() == []
    assert op.manifest(odd).count() == odd.count()
