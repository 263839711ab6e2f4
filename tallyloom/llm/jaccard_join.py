"""Jaccard join of shingle sets through signature trees.

Distinct sets are dealt to shards by prefix filter: in a common order of all shingles, two
sets that are similar enough share one of their first few. The order puts shingles that many
documents hold last, so that passages in very many documents seldom make a shard. Shards of
equal members are compared once. The members of a shard form trees whose nodes hold the
OR-combined bitmaps of the shingles below and their range of sizes; two trees are traversed
together, and a pair of nodes goes if no pair below can overlap enough. What is left are
candidates; the sets of connected candidates then meet and decide exactly.

A crowded shard is dealt out at random several times, which connects what is alike. Only
members that stay outside of its largest cluster are then held against all others, part by
part, so no link is lost and no task holds a whole shard.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.simhash import alike_links
from tallyloom.llm.text_tasks import mixed, rolling_hashes, word_codes
from tallyloom.session import stored

SHINGLE = 5
# Sets are linked if 100 * intersection >= 80 * union; fixed with ``alike_links``.
LEAST = (4, 5)
# Shingles that come last in the order, and what a task looks at to find them.
FREQUENT = 1 << 18
CHUNK_SHINGLES = 1 << 21
CHUNK_LEAST = 3
# Members of a shard that one task compares, shingles of candidates that one task compares,
# and how often a crowded shard is dealt out.
SHARD_MEMBERS = 2048
SET_SHINGLES = 1 << 21
DEALS = 3
# Bits of the map of shared shingles; with many more of those it stops to filter, no more.
FILTER_BITS = 1 << 27
# Fixed value: bits in one value of ``bitmap_construct_agg``.
_PAGE_BITS = 32_768
# Children of a tree's node, and pairs of nodes that are looked at together.
CHILDREN = 8
PAIRS = 256
_SHORT = 0xA0761D6478BD642F
SKETCH = "doc_id long, tie long, key binary, size long, prefix array<long>, signature binary"


def shingles_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct runs of ``shingle`` words as 64-bit hashes, ascending; fewer words are one run.

    Letters A to Z count as small ones. Without words there is none.
    """
    # In UTF-8 only letters A to Z have bytes that ``lower`` changes.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    codes = word_codes(words)
    if len(codes) >= shingle:
        own = np.sort(mixed(rolling_hashes(codes, shingle)))
        return own[np.concatenate([[True], own[1:] != own[:-1]])]
    # A short run never equals a run of full length.
    return mixed(rolling_hashes(codes, len(codes)) + np.uint64(_SHORT * len(codes) % (1 << 64)))


def prefix_length(size: int) -> int:
    return size - -(-LEAST[0] * size // LEAST[1]) + 1


def required(a, b):
    """Least intersection of two similar sets of these sizes."""
    return -(-LEAST[0] * (a + b) // (LEAST[0] + LEAST[1]))


def signature(shingles: np.ndarray) -> bytes:
    """Bitmap of the shingles with as many bits as the next power of two of their number."""
    width = max(64, 1 << max(0, len(shingles) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = {}, 0

    def flush():
        every = np.sort(np.concatenate([np.empty(0, np.uint64), *held.values()]))
        cuts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else []
        counts = np.diff(np.concatenate([cuts, [len(every)]]).astype(np.int64))
        many = counts >= CHUNK_LEAST
        tokens = every[np.array(cuts, np.int64)[many]] if len(every) else every
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens.view(np.int64)), pa.array(counts[many], pa.int64())], ["token", "n"]
        )

    for batch in batches:
        for text in batch["text"]:
            own = shingles_of(text.as_py())
            if held.setdefault(xxhash.xxh3_128_digest(own.tobytes()), own) is own:
                count += len(own)
            if count >= CHUNK_SHINGLES:
                yield from flush()
                held, count = {}, 0
    if count:
        yield from flush()


def frequent_shingles(documents: DataFrame, limit: int = FREQUENT) -> np.ndarray:
    """The shingles of most documents, ``limit`` at most, rarest first.

    Each task names those that several texts of a run of its documents hold; counts are
    added up. The choice only sets the order of shingles, on which no link depends.
    """
    found = documents.select("text").mapInArrow(_heavy, "token long, n long")
    totals = stored(found.groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    level = F.floor(F.log2("n") * 8)
    least, held = math.inf, 0
    # Eight levels for each doubling of the counts.
    for r in sorted(totals.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        held += r["count"]
        if held > limit:
            break
        least = r["level"]
    if least == math.inf:
        return np.empty(0, np.uint64)
    chosen = totals.filter(level >= least).toPandas()
    tokens, counts = chosen["token"].to_numpy().view(np.uint64), chosen["n"].to_numpy()
    return tokens[np.lexsort((tokens, counts))]


def _sketches(shared):
    def run(batches):
        ranked = shared.value
        order = np.argsort(ranked)
        ascending = ranked[order]

        def prefix(own: np.ndarray) -> np.ndarray:
            size = prefix_length(len(own)) if len(own) else 0
            if not len(ascending):
                return own[:size]
            at = np.minimum(np.searchsorted(ascending, own), len(ascending) - 1)
            late = ascending[at] == own
            first = own[~late][:size]
            if len(first) < size:
                first = np.concatenate([first, ranked[np.sort(order[at[late]])[: size - len(first)]]])
            return first

        for batch in batches:
            keys, sizes, starts, signs = [], [], [], []
            for text in batch["text"]:
                own = shingles_of(text.as_py())
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(len(own))
                # 48 bits of a shingle name its shard; equal names only add members.
                starts.append((prefix(own) >> np.uint64(16)).view(np.int64))
                signs.append(signature(own))
            cuts = pa.array(np.cumsum([0, *map(len, starts)]), pa.int32())
            tokens = pa.array(np.concatenate([np.empty(0, np.int64), *starts]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["tie"],
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(cuts, tokens),
                    pa.array(signs, pa.binary()),
                ],
                [part.split()[0] for part in SKETCH.split(", ")],
            )

    return run


class Clusters:
    """Union-find over numbers from zero, with the label of each as an array."""

    def __init__(self, labels: np.ndarray):
        _, self.labels = np.unique(labels, return_inverse=True)
        self._parent = list(range(int(self.labels.max()) + 1))

    def _root(self, label: int) -> int:
        parent = self._parent
        while parent[label] != label:
            parent[label] = label = parent[parent[label]]
        return label

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """The pairs of members that connect two clusters, one after another."""
        made = []
        for x, y, p, q in zip(a.tolist(), b.tolist(), self.labels[a].tolist(), self.labels[b].tolist(), strict=True):
            p, q = self._root(p), self._root(q)
            if p != q:
                self._parent[q] = p
                made.append((x, y))
        if made:
            roots = np.array([self._root(label) for label in range(len(self._parent))])
            self.labels = roots[self.labels]
        return made


class SignatureTree:
    """Members of equal bitmap width under nodes of ``CHILDREN`` each.

    A level has, per node, the OR of the bitmaps below, the least and largest size, and the
    most shingles that share a bit with another shingle of their set.
    """

    def __init__(self, members: np.ndarray, sizes: np.ndarray, bitmaps: np.ndarray):
        self.members, self.width = members, bitmaps.shape[1] * 8
        surplus = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmaps, sizes, sizes, surplus)]
        while len(self.levels[-1][1]) > 1:
            bits, least, most, more = self.levels[-1]
            cuts = np.arange(0, len(least), CHILDREN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cuts),
                    np.minimum.reduceat(least, cuts),
                    np.maximum.reduceat(most, cuts),
                    np.maximum.reduceat(more, cuts),
                )
            )

    def folded(self) -> SignatureTree:
        """The tree with bitmaps of half the width."""
        half = SignatureTree.__new__(SignatureTree)
        half.members, half.width, cut = self.members, self.width // 2, self.width // 16
        sizes = self.levels[0][1]
        half.levels = [(bits[:, :cut] | bits[:, cut:], *rest) for bits, *rest in self.levels]
        surplus = sizes - np.bitwise_count(half.levels[0][0]).sum(axis=1, dtype=np.int64)
        for n, (bits, least, most, _) in enumerate(half.levels):
            half.levels[n] = bits, least, most, surplus
            surplus = np.maximum.reduceat(surplus, np.arange(0, len(surplus), CHILDREN))
        return half

    def uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """Per level, the one cluster of all members below each node, or -1."""
        found = [labels[self.members]]
        for _ in self.levels[1:]:
            low = found[-1]
            cuts = np.arange(0, len(low), CHILDREN)
            least, most = np.minimum.reduceat(low, cuts), np.maximum.reduceat(low, cuts)
            found.append(np.where(least == most, least, -1))
        return found


def traversed(left: SignatureTree, right: SignatureTree, clusters: Clusters) -> list[tuple[int, int]]:
    """Candidate pairs of members of two trees that connect clusters, by dual traversal."""
    found: list[tuple[int, int]] = []
    same = left is right
    top = max(len(left.levels), len(right.levels)) - 1
    level = lambda tree, n: tree.levels[min(n, len(tree.levels) - 1)]
    uniform = left.uniform(clusters.labels), right.uniform(clusters.labels)
    pending = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while pending:
        n, x, y = pending.pop()
        one, two = (u[min(n, len(u) - 1)] for u in uniform)
        alive = (one[x] != two[y]) | (one[x] < 0)
        x, y = x[alive], y[alive]
        (bits_x, least_x, most_x, more_x), (bits_y, least_y, most_y, more_y) = level(left, n), level(right, n)
        fits = (LEAST[0] * least_x[x] <= LEAST[1] * most_y[y]) & (LEAST[0] * least_y[y] <= LEAST[1] * most_x[x])
        x, y = x[fits], y[fits]
        shared = np.bitwise_count(bits_x[x] & bits_y[y]).sum(axis=1, dtype=np.int64)
        # A shingle of both sets has its bit in both; others may sit on a bit with it.
        most = shared + np.minimum(more_x[x], more_y[y])
        keep = most >= required(least_x[x], least_y[y])
        x, y = x[keep], y[keep]
        if n == 0:
            if same:
                x, y = x[x < y], y[x < y]
            made = clusters.join(left.members[x], right.members[y])
            if made:
                found += made
                uniform = left.uniform(clusters.labels), right.uniform(clusters.labels)
            continue
        if not len(x):
            continue
        steps = np.arange(CHILDREN)
        # A tree that has no level below stays at its root until the other comes down to it.
        down_x = n < len(left.levels)
        down_y = n < len(right.levels)
        kids_x = (x[:, None] * CHILDREN + steps if down_x else x[:, None]).reshape(len(x), -1)
        kids_y = (y[:, None] * CHILDREN + steps if down_y else y[:, None]).reshape(len(y), -1)
        a = np.repeat(kids_x, kids_y.shape[1], axis=1).reshape(-1)
        b = np.tile(kids_y, (1, kids_x.shape[1])).reshape(-1)
        inside = (a < len(level(left, n - 1)[1])) & (b < len(level(right, n - 1)[1]))
        if same:
            inside &= a <= b
        a, b = a[inside], b[inside]
        for first in range(0, len(a), PAIRS * CHILDREN):
            part = slice(first, first + PAIRS * CHILDREN)
            pending.append((n - 1, a[part], b[part]))
    return found


def tree_candidates(sizes: list[int], signatures: list[bytes], labels: list[int]) -> list[tuple[int, int]]:
    """Pairs that connect all members whose sets may be similar enough, by number."""
    clusters = Clusters(np.array(labels))
    every, lengths = np.array(sizes, np.int64), np.array([len(s) for s in signatures])
    found, trees = [], {}
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        bitmaps = np.frombuffer(b"".join(signatures[i] for i in own.tolist()), np.uint8).reshape(len(own), -1)
        # Similar bitmaps become neighbours, of sets of nearly one size.
        grade = np.floor(np.log(every[own]) / math.log(LEAST[1] / LEAST[0])).astype(np.int64)
        head = np.ascontiguousarray(bitmaps[:, :8]).view(">u8")[:, 0]
        order = np.lexsort((head, grade))
        trees[length] = SignatureTree(own[order], every[own[order]], bitmaps[order])
    for length, tree in trees.items():
        found += traversed(tree, tree, clusters)
        if 2 * length in trees:
            found += traversed(tree, trees[2 * length].folded(), clusters)
    return found


def _by_block(batches, names: list[str]):
    """(columns) of sorted batches, one block at a time."""
    block, held = None, []
    for batch in batches:
        rows = zip(*[batch.column(name).to_pylist() for name in ("block", *names)], strict=True)
        for own, members in groupby(rows, key=itemgetter(0)):
            if own != block and held:
                yield list(zip(*held, strict=True))[1:]
                held = []
            block = own
            held += members
    if held:
        yield list(zip(*held, strict=True))[1:]


def _linker(names: list[str], compare: Callable):
    def run(batches):
        for num, *columns in _by_block(batches, ["num", *names]):
            if len(num) < 2:
                continue
            pairs = compare(*columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array([num[p[k]] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    return run


def shard_links(
    members: DataFrame, names: list[str], compare: Callable, limit: int, deals: int = DEALS
) -> DataFrame:
    """(a, b): links between members of one shard that connect all that ``compare`` connects.

    ``members`` has (shard, num, weight, ...); ``compare`` gets the columns ``names`` and
    ``label`` of some members and returns pairs. A task gets members of about ``limit`` in
    weight. A shard beyond that is dealt out ``deals`` times. Then its members outside of the
    largest cluster meet all members of other clusters, in cells of two parts.
    """
    columns = ["shard", "num", "weight", *names]
    sizes = members.groupBy("shard").agg(F.sum("weight").alias("held"), F.count("*").alias("n"))
    held = members.select(*columns).join(sizes.filter("n > 1").drop("n"), "shard")
    held = stored(held.withColumn("label", F.col("num")), "shards")
    small = held.filter(F.col("held") <= limit).withColumn("block", F.xxhash64("shard"))
    large = held.filter(F.col("held") > limit)
    parts = F.ceil(F.col("held") / limit)
    deal = F.explode(F.sequence(F.lit(1), F.lit(deals)))
    dealt = large.withColumn("deal", deal).withColumn(
        "block", F.xxhash64("shard", "deal", F.pmod(F.xxhash64("num", "deal", "shard"), parts))
    )

    def linked(rows: DataFrame) -> DataFrame:
        own = rows.select("block", "num", "label", *names).repartition("block").sortWithinPartitions("block", "num")
        return own.mapInArrow(_linker([*names, "label"], compare), "a long, b long")

    links = linked(small)
    if large.isEmpty():
        return links
    links = stored(links.unionByName(linked(dealt)), "shard-links")
    roots = components(links).withColumnRenamed("node", "num")
    named = large.drop("label").join(roots, "num", "left").withColumn("label", F.coalesce("root", "num"))
    named = stored(named.drop("root"), "shard-clusters")
    clusters = named.groupBy("shard", "label").agg(F.sum("weight").alias("held"))
    tops = clusters.groupBy("shard").agg(
        F.max(F.struct("held", "label")).alias("top"), F.sum("held").alias("all")
    ).filter("all > top.held")
    half = max(1, limit // 2)
    tops = tops.select(
        "shard",
        F.col("top.label").alias("first"),
        F.ceil(F.col("top.held") / half).alias("inner"),
        F.ceil((F.col("all") - F.col("top.held")) / half).alias("outer"),
    )
    met = named.join(tops, "shard").withColumn("hash", F.xxhash64("num"))
    most = met.filter("label = first").withColumn("part", F.expr("pmod(hash, inner)"))
    rest = met.filter("label != first").withColumn("part", F.expr("pmod(hash, outer)"))
    cells = most.withColumn("other", F.explode(F.expr("sequence(0L, outer - 1)"))).withColumn(
        "block", F.xxhash64("shard", F.lit("most"), "other", "part")
    )
    crossed = rest.withColumn("other", F.explode(F.expr("sequence(0L, inner - 1)"))).withColumn(
        "block", F.xxhash64("shard", F.lit("most"), "part", "other")
    )
    among = rest.withColumn("other", F.explode(F.expr("sequence(0L, outer - 1)"))).withColumn(
        "block", F.xxhash64("shard", F.lit("rest"), F.least("part", "other"), F.greatest("part", "other"))
    )
    cells = cells.unionByName(crossed).unionByName(among)
    return links.unionByName(linked(cells))


def _bits_of(shards: DataFrame, size: int) -> np.ndarray:
    """A bitmap of ``size`` bits with the bit of each shard's number modulo ``size``."""
    bit = F.pmod("shard", F.lit(size))
    place = F.pmod(bit, F.lit(_PAGE_BITS))
    pages = shards.groupBy(F.floor(bit / _PAGE_BITS).alias("page")).agg(F.bitmap_construct_agg(place).alias("bits"))
    out = np.zeros((-(-size // _PAGE_BITS), _PAGE_BITS // 8), np.uint8)
    # At most one page for each 32,768 bits.
    for row in pages.toLocalIterator():
        out[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _prefix_rows(shared, size: int):
    def run(batches):
        bits = shared.value
        for batch in batches:
            prefix = batch["prefix"]
            counts = np.diff(prefix.offsets.to_numpy())
            shards = prefix.flatten().to_numpy()
            bit = np.mod(shards, size)
            held = bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards[held]), pa.array(np.repeat(batch["num"].to_numpy(), counts)[held])],
                ["shard", "num"],
            )

    return run


def prefix_shards(sets: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(shard, num): sets that share a shingle of their prefixes, once per list of members.

    Few shingles are shared. A bitmap of bounded size, which all tasks get, keeps most of the
    others from being sent; it lets all shared ones through and is not relied on.
    """
    rows = sets.select("num", F.explode("prefix").alias("shard"))
    shared = stored(rows.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "shared-shingles")
    bits = sets.sparkSession.sparkContext.broadcast(_bits_of(shared, filter_bits))
    likely = sets.select("num", "prefix").mapInArrow(_prefix_rows(bits, filter_bits), "shard long, num long")
    held = stored(likely.join(shared, "shard"), "shared-shingles")
    lists = held.groupBy("shard").agg(
        F.count("*").alias("n"),
        *[F.bit_xor(F.xxhash64("num", F.lit(salt))).alias(f"sum{salt}") for salt in (1, 2)],
    )
    chosen = lists.groupBy("n", "sum1", "sum2").agg(F.min("shard").alias("shard")).select("shard")
    return held.join(stored(chosen, "shards"), "shard")


def set_links(documents: DataFrame, sets: DataFrame, members: int, shingles: int) -> DataFrame:
    """(a, b): links between similar ``sets`` (num, size, prefix, signature, of) that connect all."""
    shards = prefix_shards(sets).join(sets.select("num", "size", "signature"), "num")
    shards = shards.withColumn("weight", F.lit(1).cast("long"))
    candidates = shard_links(shards, ["size", "signature"], tree_candidates, members)
    groups = stored(components(stored(candidates, "candidates")), "candidate-groups")
    wanted = groups.join(sets, groups["node"] == sets["num"]).select(
        F.col("root").alias("shard"), "num", F.col("size").alias("weight"),
        F.col("of.doc_id").alias("_id"), F.col("of.tie").alias("_tie"),
    )
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    # Candidates grow with the documents, so they are never broadcast.
    chosen = texts.join(wanted.hint("merge"), same).select("shard", "num", "weight", "text")
    found = chosen.mapInArrow(_with_sets, "shard long, num long, weight long, shingles binary")
    # Repeated rows have the same set.
    found = found.groupBy("num").agg(*[F.first(c).alias(c) for c in ("shard", "weight", "shingles")])
    return shard_links(found, ["shingles"], _alike, shingles)


def _with_sets(batches):
    for batch in batches:
        sets = [shingles_of(text.as_py()).tobytes() for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["shard"], batch["num"], batch["weight"], pa.array(sets, pa.binary())],
            ["shard", "num", "weight", "shingles"],
        )


def _alike(sets: list[bytes], _labels) -> list[tuple[int, int]]:
    return alike_links([np.frombuffer(s, np.uint64) for s in sets])


def jaccard_components(
    documents: DataFrame,
    frequent: int = FREQUENT,
    members: int = SHARD_MEMBERS,
    shingles: int = SET_SHINGLES,
) -> DataFrame:
    """Per row: doc_id, n_shingles (size of its set), component_id (least doc_id reached).

    Documents link when the sets of their five-word shingles are similar to 0.8 or more. A
    text without words, empty or null has no shingle and no link. Texts are read whole.
    Null ids have components but name one only if all ids there are null. Repeated rows get
    equal answers; extra columns are ignored; an empty table gives no rows. Shingles are
    compared by 64-bit hashes.
    """
    spark: SparkSession = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    shared = spark.sparkContext.broadcast(frequent_shingles(documents, frequent))
    rows = stored(rows.mapInArrow(_sketches(shared), SKETCH), "sketches")
    sets = rows.filter("size > 0").groupBy("key").agg(
        F.min("doc_id").alias("first_id"),
        F.min(F.struct("doc_id", "tie")).alias("of"),
        # One value per key.
        *[F.first(name).alias(name) for name in ("size", "prefix", "signature")],
    )
    sets = stored(sets.withColumn("num", F.monotonically_increasing_id()), "sets")
    links = stored(set_links(documents, sets, members, shingles), "links")
    roots = components(links)
    rooted = sets.join(roots, sets["num"] == roots["node"], "left").select(
        "key", "first_id", F.coalesce("root", "num").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(rooted.join(names, "root").select("key", "component_id"), "named")
    found = rows.filter("size > 0").select("doc_id", "size", "key").join(named, "key").select(
        "doc_id", F.col("size").alias("n_shingles"), "component_id"
    )
    alone = rows.filter("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)
