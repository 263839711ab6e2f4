"""SimHash near-duplicates, linked through BK-trees.

Distinct fingerprints are dealt to shards by blocks of their bits: two fingerprints that
differ in at most ``radius`` bits agree in one of ``radius + 1`` blocks, so each link is
found in some shard, and a shard holds few fingerprints. A shard with more members than
``tree_size`` is dealt out anew by the bits that are not fixed yet. Each shard has a
BK-tree: a child hangs at its Hamming distance from its parent, and a search follows only
edges within the radius. Shards report one link per fingerprint, to the cluster it joined
in the tree, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tallyloom.llm.components import components
from tallyloom.llm.text_tasks import mixed
from tallyloom.session import stored

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
TREE_SIZE = 4096
# A shard is dealt out anew at most so often; then few bits are left to differ.
LEVELS = 3
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words; fewer words are one run, none have none."""
    # In UTF-8 only letters A to Z have bytes that ``lower`` changes.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(words) - width + 1
    )


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    hashes = shingle_hashes(text, shingle)
    return majority(hashes) if len(hashes) else 0


def majority(hashes: np.ndarray) -> int:
    """Each bit that is set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    blocks = np.arange(0, len(hashes), 255)
    for shift in range(8):
        # Eight bits at a time, each in a byte of its own that 255 rows cannot overflow.
        lanes = (hashes >> np.uint64(shift)) & _LANES
        sums = np.add.reduceat(lanes, blocks).view(np.uint8).reshape(-1, 8)
        counts[shift::8] = sums.sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return sum(1 << int(bit) for bit in bits)


@F.pandas_udf(LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint as a signed long."""
    values = np.array([fingerprint(text) for text in texts], np.uint64)
    return pd.Series(values.view(np.int64))


class BKTree:
    """Integers by Hamming distance; each node also has the cluster it belongs to."""

    __slots__ = ("edges", "values")

    def __init__(self):
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        self.values.append(value)
        self.edges.append({})
        new = len(self.values) - 1
        at = 0
        while new:
            distance = (self.values[at] ^ value).bit_count()
            child = self.edges[at].setdefault(distance, new)
            if child == new:
                break
            at = child
        return new

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Nodes at most ``radius`` from ``value``."""
        open_nodes = [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                yield at
            edges = self.edges[at]
            if len(edges) <= 2 * radius + 1:
                open_nodes += [
                    child for d, child in edges.items() if -radius <= d - distance <= radius
                ]
            else:
                for d in range(max(distance - radius, 0), distance + radius + 1):
                    child = edges.get(d)
                    if child is not None:
                        open_nodes.append(child)


def tree_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what is within the radius: one per value at most, as (a, b)."""
    tree, cluster = BKTree(), []

    def root(node: int) -> int:
        while cluster[node] != node:
            cluster[node] = cluster[cluster[node]]
            node = cluster[node]
        return node

    links = []
    for value in values:
        near = list(tree.within(value, radius)) if tree.values else []
        node = tree.add(value)
        cluster.append(node)
        for other in near:
            a, b = root(other), root(node)
            if a != b:
                cluster[max(a, b)] = min(a, b)
                links.append((tree.values[other], value))
    return links


def blocks_of(bits: list[int], count: int) -> list[list[int]]:
    """Deal bit numbers to ``count`` blocks of nearly equal size."""
    return [bits[i::count] for i in range(count)]


def _take(column, bits: list[int]):
    """The named bits of a long, in order; neighbouring bits are moved together."""
    mask = sum(1 << bit for bit in bits)
    return column.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def sharded(prints: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(shard, fp): shards of two or more members that together hold every close pair.

    A shard is a path of blocks with the bits they fix; its name is a hash of the two.
    Only names of the same path and bits are equal, up to collisions of 64 bits, which
    add members to a shard and lose none.
    """
    done, level = None, [([], list(range(BITS)))]
    rows = prints.select("fp", F.lit(0).alias("path"))
    for depth in range(LEVELS):
        parts, after = None, []
        steps = []
        for number, (_, free) in enumerate(level):
            for i, block in enumerate(blocks_of(free, radius + 1)):
                after.append((i, [bit for bit in free if bit not in block]))
                steps.append((number, len(after) - 1, block))
        choice = F.array(
            *[
                F.when(
                    F.col("path") == number,
                    F.struct(F.lit(new).alias("path"), _fixed(after[new][1]).alias("bits")),
                )
                for number, new, _ in steps
            ]
        )
        parts = rows.select("fp", F.explode(F.filter(choice, lambda c: c.isNotNull())).alias("s"))
        parts = parts.select(
            "fp", "s.path", F.xxhash64(F.lit(depth), F.col("s.path"), F.col("s.bits")).alias("shard")
        )
        sizes = parts.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
        held = stored(parts.join(sizes, "shard"), "shards")
        last = depth == LEVELS - 1
        fits = held if last else held.filter(F.col("n") <= tree_size)
        fits = fits.select("shard", "fp")
        done = fits if done is None else done.unionByName(fits)
        rows = held.filter(F.col("n") > tree_size).select("fp", "path").distinct()
        level = after
        if last or rows.isEmpty():
            return done
    return done


def _fixed(free: list[int]):
    """The bits of ``fp`` that are not free any more."""
    return _take(F.col("fp"), [bit for bit in range(BITS) if bit not in set(free)])


def _shard_links(radius: int):
    def run(batches):
        open_shard, open_values = None, []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            values = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(shards)) + 1
            found: list[tuple[int, int]] = []
            for shard, part in zip(
                shards[np.concatenate([[0], cuts])].tolist() if len(shards) else [],
                np.split(values, cuts),
                strict=False,
            ):
                if shard != open_shard:
                    if open_values:
                        found += tree_links(np.concatenate(open_values).tolist(), radius)
                    open_shard, open_values = shard, []
                open_values.append(part)
            yield _links(found)
        if open_values:
            yield _links(tree_links(np.concatenate(open_values).tolist(), radius))

    return run


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def linked(prints: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all close ones."""
    shards = sharded(prints, radius, tree_size)
    dealt = shards.repartition("shard").sortWithinPartitions("shard", "fp")
    return dealt.mapInArrow(_shard_links(radius), "a long, b long")


def near_duplicates(
    documents: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE
) -> DataFrame:
    """Per row: doc_id, fp (the fingerprint as a long), component_id.

    ``component_id`` is the least doc_id whose fingerprint can be reached over links of at
    most ``radius`` bits. Null and empty texts have fingerprint 0, which links like any
    other. Null ids have components but never name one, unless all ids there are null.
    Equal fingerprints are one node, so copies cost one row each. Repeated rows get equal
    answers; extra columns are ignored; an empty table gives no rows.
    """
    rows = stored(
        documents.select("doc_id", fingerprint_of(F.col("text")).alias("fp")), "fingerprints"
    )
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    links = stored(linked(prints.select("fp"), radius, tree_size), "links")
    roots = components(links)
    named = _named(prints, roots)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _named(prints: DataFrame, roots: DataFrame) -> DataFrame:
    """(fp, component_id): the least id of each component."""
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id")


# Near copies: sets of five-word shingles that are similar to LEAST[0] / LEAST[1] or more.
# Wide fingerprints in MinHash shards name candidates; the sets themselves decide.
COPY_SHINGLE = 5
COPY_WORDS = 4
LEAST = (4, 5)
# Sets similar to 0.8 differ in 39 of 256 bits on average, and at worst, four shingles of
# five, in 48: then one pair of 1.8 million differs in more than the radius.
COPY_RADIUS = 80
# Shards of near copies: sets similar to 0.8 share one of ten pairs of minima but for one
# pair of 27,000.
BANDS = 10
# Shingles that a task compares at once; two texts may hold more.
GROUP_SHINGLES = 1 << 23
_SPREAD = 0x9E3779B97F4A7C15
SKETCH_TYPE = StructType(
    [
        StructField("fp", BinaryType()),
        StructField("bands", ArrayType(LongType())),
        StructField("key", BinaryType()),
        StructField("size", LongType()),
    ]
)
MEMBERS = ["shard", "key", "size", "fp"]


def sketch(text: str | None) -> tuple[bytes, list[int]]:
    """Wide fingerprint and pairs of MinHash minima of a text's distinct five-word shingles.

    A text of fewer words is one shingle; one without words has zeros.
    """
    return _sketch_of(shingle_set(text))


def _sketch_of(hashes: np.ndarray) -> tuple[bytes, list[int]]:
    if not len(hashes):
        return bytes(8 * COPY_WORDS), [0] * BANDS
    fp = 0
    for word in range(COPY_WORDS):
        salt = np.uint64((word + 1) * _SPREAD % (1 << 64))
        fp = fp << BITS | majority(mixed(hashes + salt))
    lows = [
        mixed(hashes ^ np.uint64((n + 101) * _SPREAD % (1 << 64))).min() for n in range(2 * BANDS)
    ]
    pairs = mixed(np.array(lows[::2]) * np.uint64(_SPREAD) ^ np.array(lows[1::2]))
    return fp.to_bytes(8 * COPY_WORDS, "big"), pairs.view(np.int64).tolist()


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct five-word shingles of a text, ascending."""
    return np.unique(shingle_hashes(text, COPY_SHINGLE))


def _sketches(texts: pd.Series) -> pd.DataFrame:
    found = []
    for text in texts:
        own = shingle_set(text)
        found.append((*_sketch_of(own), xxhash.xxh3_128_digest(own.tobytes()), len(own)))
    return pd.DataFrame(found, columns=["fp", "bands", "key", "size"])


@F.pandas_udf(BinaryType())
def _sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(text).tobytes() for text in texts], dtype=object)


def _candidates(keys: list[bytes], sizes: list[int], prints: list[bytes], radius: int):
    """Lists of keys that together hold each pair of fingerprints within the radius.

    Each list has at most GROUP_SHINGLES shingles, or two keys.
    """
    owners: dict[int, list[int]] = {}
    for i, fp in enumerate(prints):
        owners.setdefault(int.from_bytes(fp, "big"), []).append(i)
    group = {value: value for value in owners}

    def root(value: int) -> int:
        while group[value] != value:
            group[value] = value = group[group[value]]
        return value

    for a, b in tree_links(list(owners), radius):
        group[root(a)] = root(b)
    joined: dict[int, list[int]] = {}
    for value, members in owners.items():
        joined.setdefault(root(value), []).extend(members)
    for members in joined.values():
        if len(members) < 2:
            continue
        if sum(sizes[i] for i in members) <= GROUP_SHINGLES:
            yield [keys[i] for i in members]
            continue
        parts, room = [[]], GROUP_SHINGLES // 2
        for i in members:
            if parts[-1] and sizes[i] > room:
                parts.append([])
                room = GROUP_SHINGLES // 2
            parts[-1].append(keys[i])
            room -= sizes[i]
        yield from (a + b for a, b in combinations(parts, 2))
        if len(parts) == 1:
            yield parts[0]


def alike_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of sets similar to LEAST or more that connect all such pairs.

    One set after another is compared with all others, until those that are left are
    connected with each other.
    """
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    posts = owner[np.argsort(codes, kind="stable")]
    counts = np.bincount(codes)
    firsts = np.cumsum(counts) - counts
    label, left, found = np.arange(len(sets)), np.ones(len(sets), bool), []
    while True:
        held = np.bincount(label[left], minlength=len(sets))
        open_labels = np.flatnonzero(held)
        if len(open_labels) < 2:
            return found
        # Members of small clusters come first, so that a large one is seldom gone through.
        least = open_labels[held[open_labels].argmin()]
        i = int(np.flatnonzero(left & (label == least))[0])
        left[i] = False
        own = codes[ends[i] - sizes[i] : ends[i]]
        lengths = counts[own]
        steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        shared = np.bincount(posts[np.repeat(firsts[own], lengths) + steps], minlength=len(sets))
        near = (LEAST[0] + LEAST[1]) * shared >= LEAST[0] * (sizes + sizes[i])
        for j in np.flatnonzero(near & (label != label[i])).tolist():
            if label[j] != label[i]:
                found.append((i, j))
                label[label == label[j]] = label[i]


def _by_shard(batches, names: list[str]):
    """(shard, columns) of sorted batches, one shard at a time."""
    shard, held = None, []
    for batch in batches:
        rows = zip(*[batch.column(name).to_pylist() for name in ("shard", *names)], strict=True)
        for own, members in groupby(rows, key=itemgetter(0)):
            if own != shard and held:
                yield shard, list(zip(*held, strict=True))[1:]
                held = []
            shard = own
            held += members
    if held:
        yield shard, list(zip(*held, strict=True))[1:]


def _grouped(radius: int):
    def run(batches):
        for _, (keys, sizes, prints) in _by_shard(batches, MEMBERS[1:]):
            for group in _candidates(keys, sizes, prints, radius):
                # Shards with equal groups give them one name, so that each is compared once.
                name = xxhash.xxh3_64_intdigest(b"".join(sorted(group)))
                names = np.full(len(group), name, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(group, pa.binary())], ["shard", "key"]
                )

    return run


def _compared(batches):
    for _, (keys, sets) in _by_shard(batches, ["key", "shingles"]):
        found = alike_links([np.frombuffer(s, np.uint64) for s in sets])
        ends = [pa.array([keys[pair[k]] for pair in found], pa.binary()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(ends, ["a", "b"])


def _in_shards(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*names).repartition("shard").sortWithinPartitions("shard", "key")


def copy_shards(prints: DataFrame, tree_size: int = TREE_SIZE) -> DataFrame:
    """(shard, key, size, fp): shards of about ``tree_size`` members at most.

    A shard is a pair of minima. One with more members is dealt out by the sizes of the
    sets, each to its own grade and the next, as similar sets are at most a grade apart.
    What is still larger is cut into parts, and each two parts make a shard. Both hold all
    pairs of the shard that can be similar enough, so no link depends on a shard's size.
    """
    pairs = prints.select("key", "size", "fp", F.posexplode("bands").alias("band", "low"))
    fits, crowded = _by_size(pairs.withColumn("shard", F.xxhash64("band", "low")), tree_size)
    if crowded.isEmpty():
        return fits
    step = math.log(LEAST[1] / LEAST[0])
    grade = F.floor(F.log(F.greatest("size", F.lit(1))) / step)
    graded = crowded.withColumn("grade", F.explode(F.array(grade, grade + 1)))
    graded = graded.withColumn("shard", F.xxhash64("shard", "grade"))
    more, crowded = _by_size(graded, tree_size)
    fits = fits.unionByName(more)
    parts = F.ceil(F.col("n") / max(1, tree_size // 2))
    cut = crowded.select(*MEMBERS, parts.alias("parts"), F.pmod(F.xxhash64("key"), parts).alias("part"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    two = F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other"))
    # A part alone is in the shards that it makes with others, if there are any.
    cut = cut.filter("part != other OR parts = 1").withColumn("shard", two)
    return fits.unionByName(cut.select(*MEMBERS))


def _by_size(rows: DataFrame, tree_size: int) -> tuple[DataFrame, DataFrame]:
    """Members of shards of 2 to ``tree_size`` members, and those of larger ones with ``n``."""
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
    held = stored(rows.select(*MEMBERS).join(sizes, "shard"), "copy-shards")
    return held.filter(F.col("n") <= tree_size).drop("n"), held.filter(F.col("n") > tree_size)


def copy_links(
    documents: DataFrame, prints: DataFrame, radius: int = COPY_RADIUS, tree_size: int = TREE_SIZE
) -> DataFrame:
    """(a, b): links between keys of shingle sets that are similar to LEAST or more.

    ``prints`` has a row per key with its fingerprint, bands, and doc_id and hash of a text
    that has it. Texts are read a second time, for keys with candidates only.
    """
    shards = _in_shards(copy_shards(prints, tree_size), MEMBERS)
    groups = shards.mapInArrow(_grouped(radius), "shard long, key binary").distinct()
    groups = stored(groups, "copy-groups")
    wanted = prints.join(groups.select("key").distinct(), "key", "left_semi").select(
        "key", F.col("of.doc_id").alias("_id"), F.col("of.tie").alias("_tie")
    )
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    # Candidates grow with the documents, so they are never broadcast.
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    chosen = texts.join(wanted.hint("merge"), same).select("key", _sets(F.col("text")).alias("shingles"))
    chosen = chosen.groupBy("key").agg(F.first("shingles").alias("shingles"))
    members = _in_shards(groups.join(chosen.hint("merge"), "key"), ["shard", "key", "shingles"])
    return members.mapInArrow(_compared, "a binary, b binary")


def near_copies(
    documents: DataFrame, radius: int = COPY_RADIUS, tree_size: int = TREE_SIZE
) -> DataFrame:
    """Per row: doc_id and component_id, the least doc_id among its near copies.

    Near copies are connected by texts whose sets of five-word shingles are similar to 0.8
    or more. The odd cases are those of ``near_duplicates``.
    """
    sketches = F.pandas_udf(_sketches, SKETCH_TYPE)
    rows = documents.select(
        "doc_id", F.xxhash64("text").alias("tie"), sketches(F.col("text")).alias("s")
    )
    rows = stored(rows.select("doc_id", "tie", "s.*"), "sketches")
    prints = rows.groupBy("key").agg(
        F.min("doc_id").alias("first_id"),
        F.min(F.struct("doc_id", "tie")).alias("of"),
        # One value per key.
        *[F.min(name).alias(name) for name in ("size", "fp", "bands")],
    )
    prints = stored(prints, "prints")
    links = stored(copy_links(documents, prints, radius, tree_size), "copies")
    named = _named(prints.select(F.col("key").alias("fp"), "first_id"), components(links))
    named = named.withColumnRenamed("fp", "key")
    return rows.select("doc_id", "key").join(named, "key").select("doc_id", "component_id")


def one_per_group(documents: DataFrame) -> DataFrame:
    """The documents without near copies: of each group the one with the least id.

    All columns are kept, whatever their names. Of rows that repeat the id that stays, one
    stays. Rows without an id stay, as no answer can name them. Texts that are null or have
    no word are one group. An empty table gives no rows.
    """
    found = stored(near_copies(documents), "near-copies")
    ids = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("stays")
    )
    answers = stored(ids.withColumnRenamed("doc_id", "answer_id"), "stays")
    # The caller's row travels as one value, so that its columns cannot meet those made here.
    rows = documents.select(F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("row"))
    # Answers grow with the documents, so they are never broadcast.
    same = F.col("row.doc_id") == F.col("answer_id")
    rows = rows.join(answers.hint("merge"), same, "left").filter("stays IS NULL OR stays = 1")
    if not answers.filter("n > 1 AND stays = 1").isEmpty():
        copy = Window.partitionBy("row.doc_id", "lone").orderBy("row.text")
        lone = F.when(F.col("n") > 1, F.lit(-1)).otherwise(F.monotonically_increasing_id())
        rows = rows.withColumn("lone", lone).withColumn("copy", F.row_number().over(copy))
        rows = rows.filter("copy = 1")
    return rows.select(*[F.col("row").getField(n).alias(n) for n in documents.columns])
