"""Merkle manifest of a dataset: a hash tree per group, and a tree over the groups' roots.

Coordinates come from bitmaps, not from sorting the leaves. The ids of a group are set bits
in 64-bit words, of which only those with members are kept. Directories of counts above the
words (by 1,024 words, then by 65,536 of what is below) give each word the number of rows
before it, and a population count inside the word gives the rank of an id. Ranks are slots:
leaves are keyed by runs of slots, each run is one array that a task reduces by several
levels at once, and its top goes to the next round. The same arrays, from the top down,
give every leaf its siblings.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
# Slots of an array, at most.
ARRAY_SLOTS = 128
# Copies of one row that a task numbers.
RUN_COPIES = 65_536
# Bits of an id below its word, and steps from a directory to the next.
_WORD_BITS, _DIRECTORY_BITS = 6, (10, 16, 16)
# The word of rows without an id, before all others.
_NO_ID = -(1 << 57) - 1
_STEPS = "proof array<struct<place:int,others:string>>"
_ROOTS = ("subroot", "root")
_PATHS = f"grp string, slot long, digest string, id long, claim string, {_STEPS}, subroot string, root string"


def leaf_of(values: list[Column]) -> Column:
    """Hash of values, each `-` if null, else its byte count, a colon and the value."""
    texts = [value.cast("string") for value in values]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*coded), 256)


def digest_of(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def entries_of(
    documents: DataFrame, group: str, order: str, fields: tuple[str, ...], claim: Column | None
) -> DataFrame:
    """(grp, id, digest, claim, copies): rows with equal hashes are one entry.

    Group names are marked, so that a null group comes before all others.
    """
    rows = documents.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(order).cast("long").alias("id"),
        leaf_of([F.col(name) for name in fields]).alias("digest"),
        (F.lit(None) if claim is None else claim).cast("string").alias("claim"),
    )
    return rows.groupBy("grp", "id", "digest", "claim").agg(F.count("*").alias("copies"))


def _word_of(id_column: str) -> tuple[Column, Column]:
    word = F.coalesce(F.shiftright(id_column, _WORD_BITS), F.lit(_NO_ID))
    bit = F.coalesce(F.col(id_column).bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    return word, bit


def ranked(ids: DataFrame) -> DataFrame:
    """``ids`` (grp, id, rows, ...; a row per id) with ``rank``: rows of the group with lesser ids.

    A null id comes first. Directories are summed level by level, so that no window holds
    more than 65,536 entries of a group, however many ids there are.
    """
    word, bit = _word_of("id")
    ids = ids.withColumn("word", word).withColumn("bit", bit)
    one = F.expr("shiftleft(1L, bit)")
    more = F.when(F.col("rows") > 1, F.struct("bit", (F.col("rows") - 1).alias("more")))
    words = ids.groupBy("grp", F.col("word").alias("key")).agg(
        F.bit_or(one).alias("bits"), F.collect_list(more).alias("ties"), F.sum("rows").alias("rows")
    )
    words = stored(words, "manifest-words")
    levels = [words.select("grp", "key", "rows")]
    for step in _DIRECTORY_BITS:
        above = levels[-1].groupBy("grp", F.shiftright("key", step).alias("key"))
        levels.append(above.agg(F.sum("rows").alias("rows")))
    before = lambda *key: F.coalesce(
        F.sum("rows").over(
            Window.partitionBy("grp", *key).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    bases = levels[-1].select("grp", "key", before().alias("base"))
    for step, level in zip(_DIRECTORY_BITS[::-1], levels[-2::-1], strict=True):
        inner = level.withColumn("up", F.shiftright("key", step))
        inner = inner.select("grp", "key", "up", before("up").alias("inside"))
        outer = bases.select("grp", F.col("key").alias("up"), "base")
        bases = inner.join(outer, ["grp", "up"]).select(
            "grp", "key", (F.col("base") + F.col("inside")).alias("base")
        )
    directory = words.drop("rows").join(bases, ["grp", "key"]).withColumnRenamed("key", "word")
    low = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)")))
    ties = F.aggregate(
        F.filter("ties", lambda t: t["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda n, t: n + t["more"]
    )
    found = ids.join(directory, ["grp", "word"]).withColumn("rank", F.col("base") + low + ties)
    return found.drop("word", "bit", "bits", "ties", "base")


def slots_of(entries: DataFrame) -> DataFrame:
    """(grp, slot, digest, id, claim): a row per leaf, numbered within its group.

    Leaves ascend by id, nulls first; leaves of one id by their hashes, and equal leaves
    have slots in a row. An id of very many leaves is ranked by its hashes in the same way.
    """
    ids = entries.groupBy("grp", "id").agg(
        F.sum("copies").alias("rows"),
        F.count("*").alias("leaves"),
        F.min(F.struct("digest", "claim", "copies")).alias("one"),
    )
    ids = stored(ranked(ids), "manifest-ranks")
    lone = ids.filter("leaves = 1").select(
        "grp", "id", "one.digest", "one.claim", "one.copies", F.col("rank").alias("slot")
    )
    crowded = ids.filter("leaves > 1").select("grp", F.col("id").alias("of"), "rank")
    if not crowded.isEmpty():
        lone = lone.unionByName(_tied(entries, crowded))
    single = lone.filter("copies = 1").drop("copies")
    runs = lone.filter("copies > 1").withColumn(
        "first", F.explode(F.expr(f"sequence(0L, copies - 1, {RUN_COPIES}L)"))
    )
    last = F.expr(f"least(first + {RUN_COPIES}, copies) - 1")
    copies = runs.repartition("grp", "slot", "first").withColumn("at", F.explode(F.sequence("first", last)))
    copies = copies.withColumn("slot", F.col("slot") + F.col("at")).drop("copies", "first", "at")
    return single.unionByName(copies)


def _tied(entries: DataFrame, crowded: DataFrame) -> DataFrame:
    """Leaves of ids that have several, ranked by the first 60 bits of their hashes."""
    same = (entries["grp"] == crowded["grp"]) & entries["id"].eqNullSafe(crowded["of"])
    tied = entries.join(crowded, same).select(entries["*"], F.col("rank").alias("first"))
    # Marked by the id, which has no sign of this kind, so that no two pairs get one name.
    owner = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("/"), F.col("grp"))
    head = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    tied = tied.withColumn("owner", owner).withColumn("head", head)
    tied = stored(tied, "manifest-ties")
    heads = tied.groupBy(F.col("owner").alias("grp"), F.col("head").alias("id")).agg(
        F.sum("copies").alias("rows")
    )
    heads = ranked(heads).select(F.col("grp").alias("owner"), F.col("id").alias("head"), "rank")
    # Different hashes with one head are next to never seen.
    before = Window.partitionBy("owner", "head").orderBy("digest", "claim")
    inside = F.coalesce(F.sum("copies").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = tied.join(heads, ["owner", "head"]).withColumn("slot", F.col("first") + F.col("rank") + inside)
    return found.select("grp", "id", "digest", "claim", "copies", "slot")


def array_levels(fanout: int) -> int:
    """Levels that one array is reduced by."""
    return max(1, int(math.log(ARRAY_SLOTS) / math.log(fanout) + 1e-9))


def reduced(level: list[str], fanout: int, steps: int | None) -> list[list[str]]:
    """Levels of a tree above ``level``, itself first: ``steps`` of them, or up to one node."""
    levels = [level]
    while len(levels) <= steps if steps is not None else len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest_of(low[i : i + fanout]) for i in range(0, len(low), fanout)])
    return levels


def arrays_of(nodes: DataFrame, fanout: int) -> DataFrame:
    """(grp, block, whole, members): runs of slots as arrays; ``whole`` if a group has no other."""
    size = fanout ** array_levels(fanout)
    held = nodes.groupBy("grp", F.expr(f"slot div {size}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("slot", "digest", "id", "claim"))).alias("members")
    )
    held = stored(held, "manifest-arrays")
    last = held.groupBy("grp").agg(F.max("block").alias("last")).withColumn("block", F.lit(0).cast("long"))
    # Only the first array of a group asks, so that a large group's key is met once.
    flagged = held.join(last, ["grp", "block"], "left")
    return flagged.select("grp", "block", (F.coalesce("last", F.lit(1)) == 0).alias("whole"), "members")


def _tops(fanout: int):
    steps = array_levels(fanout)

    def run(batches):
        for batch in batches:
            tops = []
            for whole, members in zip(batch["whole"].to_pylist(), batch["members"], strict=True):
                level = members.values.field("digest").to_pylist()
                tops.append(reduced(level, fanout, None if whole else steps)[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch["grp"], batch["block"], batch["whole"], pa.array(tops, pa.string())],
                ["grp", "slot", "whole", "digest"],
            )

    return run


def _steps_of(levels: list[list[str]], fanout: int) -> tuple[list[int], list[str], np.ndarray]:
    """Places and siblings of all nodes below the top, and each leaf's way through them."""
    places, others, ways = [], [], []
    at = np.arange(len(levels[0]))
    for level in levels[:-1]:
        ways.append(at + len(places))
        for i in range(len(level)):
            first = i - i % fanout
            places.append(i % fanout)
            others.append("".join(level[first:i] + level[i + 1 : first + fanout]))
        at = at // fanout
    return places, others, np.array(ways, int).reshape(len(ways), len(levels[0])).T


def _ways(fanout: int):
    steps = array_levels(fanout)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch["members"][row].values
                whole = batch["whole"][row].as_py()
                levels = reduced(members.field("digest").to_pylist(), fanout, None if whole else steps)
                places, others, ways = _steps_of(levels, fanout)
                above = batch["above"][row].as_py() or []
                count, own = len(members), len(places)
                tail = np.arange(own, own + len(above))
                ways = np.hstack([ways, np.tile(tail, (count, 1))]) if len(above) else ways
                picks = pa.array(ways.reshape(-1).astype(np.int64))
                proof = pa.StructArray.from_arrays(
                    [
                        pa.array(places + [s["place"] for s in above], pa.int32()).take(picks),
                        pa.array(others + [s["others"] for s in above], pa.string()).take(picks),
                    ],
                    ["place", "others"],
                )
                cuts = pa.array(np.arange(count + 1, dtype=np.int32) * ways.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch["grp"][row].as_py()] * count, pa.string()),
                        *[members.field(name) for name in ("slot", "digest", "id", "claim")],
                        pa.ListArray.from_arrays(cuts, proof),
                        *[pa.array([batch[name][row].as_py()] * count, pa.string()) for name in _ROOTS],
                    ],
                    ["grp", "slot", "digest", "id", "claim", "proof", *_ROOTS],
                )

    return run


class Forest:
    """Trees of all groups of ``nodes`` (grp, slot, digest, id, claim)."""

    def __init__(self, nodes: DataFrame, fanout: int):
        self.fanout, self.rounds, self.tops = fanout, [], None
        while True:
            arrays = arrays_of(nodes, fanout)
            self.rounds.append(arrays)
            made = arrays.mapInArrow(_tops(fanout), "grp string, slot long, whole boolean, digest string")
            made = stored(made, "manifest-tops")
            done = made.filter("whole").select("grp", "digest")
            self.tops = done if self.tops is None else self.tops.unionByName(done)
            rest = made.filter("NOT whole")
            if rest.isEmpty():
                return
            none = F.lit(None)
            nodes = rest.select("grp", "slot", "digest", none.cast("long").alias("id"), none.cast("string").alias("claim"))

    def paths(self, roots: DataFrame) -> DataFrame:
        """(grp, slot, digest, id, claim, proof): siblings of each leaf up to the whole tree's root.

        ``roots`` has the way above each group's root: (grp, proof, subroot, root).
        """
        above = None
        way = [F.col("proof").alias("above"), *_ROOTS]
        for arrays in reversed(self.rounds):
            whole = roots.select("grp", F.lit(0).cast("long").alias("block"), *way)
            first = arrays.filter("whole").join(whole, ["grp", "block"])
            if above is not None:
                inner = above.select("grp", F.col("slot").alias("block"), *way)
                first = first.unionByName(arrays.filter("NOT whole").join(inner, ["grp", "block"]))
            above = first.mapInArrow(_ways(self.fanout), _PATHS)
            if arrays is not self.rounds[0]:
                above = stored(above, "manifest-ways")
        return above


def in_order(groups: DataFrame) -> DataFrame:
    """(grp, slot): groups numbered in the bytewise order of their names."""
    dealt = groups.select("grp").repartitionByRange("grp").sortWithinPartitions("grp")
    # A row's number within its partition is in the lower 33 bits.
    number = F.monotonically_increasing_id()
    dealt = stored(dealt.withColumn("part", F.shiftright(number, 33)).withColumn("at", number.bitwiseAND(F.lit((1 << 33) - 1))), "manifest-groups")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return dealt.join(starts, "part").select("grp", (F.col("start") + F.col("at")).alias("slot"))


def manifest(
    documents: DataFrame,
    group: str = "lang",
    order: str = "doc_id",
    fields: tuple[str, ...] = FIELDS,
    claim: Column | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """Per row: its ``order`` column, leaf, claim, slot, subroot, root and proof.

    A leaf hashes ``fields``. Leaves of a group ascend by ``order`` (an integer; nulls
    first, equal ids by leaf), and ``fanout`` nodes in a row make one above; a last run of
    fewer does too. Group roots in the order of their names (null first) make the root in
    the same way. ``proof`` has a (place, others) per level: the node's place in its run
    and the hashes of the run's other nodes. ``claim`` is any hash of the row to be held
    against the proof; see ``folded``.

    Null texts and columns are hashed as such. Very long texts are hashed whole. Repeated rows are leaves of their own; rows
    of equal hashes but different claims are numbered by claim. Extra columns are ignored;
    an empty table gives no rows.
    """
    entries = stored(entries_of(documents, group, order, fields, claim), "manifest-leaves")
    forest = Forest(slots_of(entries), fanout)
    subroots = forest.tops
    nodes = subroots.join(in_order(subroots), "grp").select(
        F.lit("").alias("grp"),
        "slot",
        "digest",
        F.lit(None).cast("long").alias("id"),
        # The group's name travels as the claim of its root.
        F.col("grp").alias("claim"),
    )
    crown = Forest(nodes, fanout)
    none = F.from_json(F.lit("[]"), _STEPS.removeprefix("proof "))
    top = crown.tops.select("grp", none.alias("proof"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    roots = crown.paths(top).select(
        F.col("claim").alias("grp"), "proof", F.col("digest").alias("subroot"), "root"
    )
    return forest.paths(stored(roots, "manifest-roots")).select(
        F.col("id").alias(order), F.col("digest").alias("leaf"), "claim", "slot", *_ROOTS, "proof"
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    width = 64

    def step(node: Column, way: Column) -> Column:
        left = F.substring(way["others"], F.lit(1), way["place"] * width)
        right = F.substring(way["others"], way["place"] * width + 1, F.length(way["others"]))
        return F.sha2(F.concat(left, node, right), 256)

    return F.aggregate(proof, leaf, step)


def siblings_of(proof: Column) -> Column:
    """Hash of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda way: way["others"]), ""), 256)
