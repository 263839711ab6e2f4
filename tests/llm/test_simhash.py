from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tallyloom.llm import simhash as op
from tallyloom.llm.components import components
from tests.llm.conftest import ODD


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def clusters(nodes, close):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if close(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint_is_the_plain_one():
    draw = random.Random(1)
    texts = [t for _, t in ODD] + [
        " ".join(draw.choice(["The", "é", "of", "X\u00a0y"]) for _ in range(n)) for n in (1, 2, 3, 4, 300, 1200)
    ]
    assert [op.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_tree_finds_all_within_the_radius():
    draw = random.Random(2)
    centre = [draw.getrandbits(64) for _ in range(20)]
    values = [c ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 3))) for c in centre * 20]
    tree = op.BKTree()
    for value in values:
        tree.add(value)
    for value in values[:60]:
        near = {i for i, v in enumerate(values) if (v ^ value).bit_count() <= 2}
        assert set(tree.within(value, 2)) == near


@pytest.mark.parametrize("tree_size", [2, 8, 4096])
def test_links_lose_no_pair(spark, tree_size):
    draw = random.Random(3)
    values = {draw.getrandbits(64) for _ in range(40)}
    for value in list(values)[:6]:
        for _ in range(15):
            value ^= 1 << draw.randrange(64)
            values.add(value)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = components(op.linked(frame, tree_size=tree_size)).collect()
    got = {r["node"]: r["root"] for r in found}
    want = clusters(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {v: got.get(v, v) for v in signed} == want


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, 1001 + i) for i in range(50)] + [(7, 7), (None, 3)]
    random.Random(4).shuffle(links)
    out = components(spark.createDataFrame(links, "a long, b long"))
    got = {r["node"]: r["root"] for r in out.collect()}
    assert got == {**{i: 0 for i in range(101)}, **{1000 + i: 1000 for i in range(51)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = clusters(set(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc_id, _), p in zip(rows, prints, strict=True):
        if doc_id is not None:
            least[root[p]] = min(least.get(root[p], doc_id), doc_id)
    return sorted(((d, p, least.get(root[p])) for (d, _), p in zip(rows, prints, strict=True)), key=str)


def test_near_duplicates_equal_brute_force(make):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    rows = list(ODD)
    for i in range(30):
        base = [draw.choice(words) for _ in range(200)]
        rows.append((100 + 3 * i, " ".join(base)))
        rows.append((101 + 3 * i, " ".join(base).upper() + " tail"))
        rows.append((102 + 3 * i, "\t".join(base)))
    out = op.near_duplicates(make(rows)).collect()
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in out), key=str)
    assert got == brute(rows)


def copies(rows):
    """Least id per row of the components of pairs of sets similar to 0.8 or more, over all pairs."""
    sets = [frozenset(op.shingle_hashes(t, 5).tolist()) for _, t in rows]
    number = {own: n for n, own in enumerate(dict.fromkeys(sets))}
    distinct = list(number)
    sizes = [len(own) for own in distinct]
    near = lambda a, b: 9 * len(distinct[a] & distinct[b]) >= 4 * (sizes[a] + sizes[b])
    root = clusters(range(len(distinct)), near)
    least = {}
    for (doc_id, _), own in zip(rows, sets, strict=True):
        if doc_id is not None:
            name = root[number[own]]
            least[name] = min(least.get(name, doc_id), doc_id)
    return [(doc_id, least.get(root[number[own]])) for (doc_id, _), own in zip(rows, sets, strict=True)]


def similarity(a, b):
    sets = [set(zip(*[t.lower().split()[k:] for k in range(5)], strict=False)) for t in (a, b)]
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


def changed(draw, words, share):
    return " ".join(draw.choice("abcdefgh") * 7 if draw.random() < share else w for w in words)


@pytest.fixture(scope="module")
def edited():
    draw = random.Random(6)
    rows = list(ODD)
    for i in range(25):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.randint(40, 400))]
        rows += [(100 + 10 * i + k, changed(draw, base, share)) for k, share in enumerate((0, 0.01, 0.02, 0.1, 0.3))]
    return rows


def test_near_copies_are_those_of_similar_shingles(make, edited):
    got = sorted(((r["doc_id"], r["component_id"]) for r in op.near_copies(make(edited)).collect()), key=str)
    assert got == sorted(copies(edited), key=str)
    name = dict(copies(edited))
    long = [r for r in edited if r[0] and r[0] >= 100]
    missed = 0
    for i, (a, text) in enumerate(long):
        for b, other in long[i + 1 :]:
            alike = similarity(text, other)
            missed += alike >= 0.8 and name[a] != name[b]
            assert alike > 0.3 or name[a] != name[b]
    assert missed == 0


@pytest.mark.parametrize("tree_size", [2, 5])
def test_crowded_shards_keep_their_copies_together(make, tree_size):
    draw = random.Random(7)
    base = [f"w{i}" for i in range(2000)]
    rows = [(i, changed(draw, base, 0.002)) for i in range(60)]
    rows += [(100 + i, " ".join(f"x{draw.randrange(900)}" for _ in range(50))) for i in range(20)]
    out = op.near_copies(make(rows), tree_size=tree_size).collect()
    assert {r["component_id"] for r in out if r["doc_id"] < 100} == {0}
    assert all(r["component_id"] == r["doc_id"] for r in out if r["doc_id"] >= 100)


def alike(rows):
    """Least id per row of the components of pairs of sets similar to 0.8 or more."""
    sets = {i: frozenset(op.shingle_hashes(t, 5).tolist()) for i, t in rows}
    least = lambda a, b: 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))
    return clusters(sets, least)


def found(frame, **more):
    return {r["doc_id"]: r["component_id"] for r in op.near_copies(frame, **more).collect()}


def test_only_sets_similar_to_the_limit_are_linked(make):
    draw = random.Random(8)
    rows = []
    for i in range(40):
        base = [f"w{draw.randrange(5000)}" for _ in range(304)]
        other = list(base)
        for place in range(4, 304, 25 + i):
            other[place] = "new"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    want = alike(rows)
    assert 45 < len(set(want.values())) < 75
    assert found(make(rows)) == want


def test_compared_sets_are_connected_as_all_pairs_are():
    draw = random.Random(9)
    for _ in range(100):
        base = range(20)
        sets = [{x for x in base if draw.random() < 0.93} | {draw.randrange(99)} for _ in range(draw.randint(2, 25))]
        near = {i: {j for j, b in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)} for i, a in enumerate(sets)}
        links = op.alike_links([np.array(sorted(s), np.uint64) for s in sets])
        assert all(b in near[a] for a, b in links)
        both = {*links, *[(b, a) for a, b in links]}
        want = clusters(near, lambda a, b: b in near[a])  # noqa: B023
        assert clusters(near, lambda a, b: (a, b) in both) == want  # noqa: B023


def test_chains_are_whole_in_shards_of_any_size(make):
    draw = random.Random(10)
    rows = []
    for i in range(12):
        words = [f"w{draw.randrange(5000)}" for _ in range(200)]
        for k in range(4):
            rows.append((10 * i + k, " ".join(words)))
            for place in draw.sample(range(200), 3):
                words[place] = f"new{draw.randrange(5000)}"
    want = alike(rows)
    got = [found(make(rows), tree_size=size) for size in (2, 4096)]
    assert got[0] == got[1] == want and len(set(want.values())) < 30


def test_crowded_shards_are_cut_and_lose_no_pair(spark):
    rows = [(bytes([n]), n, bytes(32), [1, n % 2]) for n in range(1, 120)]
    prints = spark.createDataFrame(rows, "key binary, size long, fp binary, bands array<long>")
    shards = {}
    for r in op.copy_shards(prints, 8).collect():
        shards.setdefault(r["shard"], []).append(r["size"])
    pairs = {(a, b) for s in shards.values() for a in s for b in s if a < b}
    assert pairs >= {(a, b) for a in range(1, 120) for b in range(a + 1, 120) if 5 * a >= 4 * b}
    assert max(map(len, shards.values())) <= 20


def test_repeats_and_short_texts_lose_no_copy(make):
    draw = random.Random(11)
    rows = []
    for i in range(30):
        words = [f"w{draw.randrange(9000)}" for _ in range(9 if i % 2 else 404)]
        # The same shingles but for the number of times, or five of them against four.
        other = words[:8] if i % 2 else [w for _ in range(6) for w in words[:100]] + words
        other = other if i % 2 else words + other
        words = words if i % 2 else words + words
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    assert found(make(rows)) == alike(rows) == {n: n // 2 * 2 for n in range(60)}


def test_one_document_of_each_group_stays(make, edited):
    kept = op.one_per_group(make(edited)).collect()
    want = {c for _, c in copies(edited) if c is not None}
    ids = [r["doc_id"] for r in kept if r["doc_id"] is not None]
    assert sorted(ids) == sorted(want) and sum(r["doc_id"] is None for r in kept) == 2
    assert kept[0].asDict().keys() == set(make([]).columns)


def test_no_rows(empty):
    assert op.near_duplicates(empty).collect() == [] and op.one_per_group(empty).collect() == []
    assert op.near_copies(empty).collect() == []


def test_any_column_names(spark):
    names = ["n", "stays", "answer_id", "row", "lone", "copy", "_n", "_stays", "a.b"]
    rows = [(i, t, *names) for i, t in ((1, "one two"), (2, "one two"), (2, "other"), (3, "four"), (3, "four"))]
    out = op.one_per_group(spark.createDataFrame(rows, ["doc_id", "text", *names]))
    assert out.columns == ["doc_id", "text", *names]
    assert sorted(tuple(r)[:2] for r in out.collect())[0] == (1, "one two")
    assert all(tuple(r)[2:] == tuple(names) for r in out.collect())
